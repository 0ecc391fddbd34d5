"""Line dedup on levelled sorted runs of line hashes.

A *run* is a table of line hashes with the number of documents that hold each and the largest of their ids, cut into
buckets by the hash and sorted in each bucket. Batches arrive from the largest document ids down. A new batch is
merged against the runs: hashes which the runs already settle (enough documents, and a larger id) drop out by an
anti-join that reads the sorted buckets without another shuffle or sort, and what is left becomes a run of level 0.
As soon as a level has ``fanout`` runs they are merged into one run of the next level and deleted.

Edge cases: null and empty texts are one empty line. A row is a document, also if another row has its id; rows with the
largest id of a line all keep it, and null ids count as smaller than all others. Only the columns that are named are
read. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm.storage import shared_folder
from changelake.llm.texts import SPACES, lines, lower_ascii
from changelake.plans.once import computed_once


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def _digests(text: Column, min_chars: int) -> Column:
    """For each line the MD5 of its key, null where the key is short."""

    def digest(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.char_length(key) >= min_chars, F.md5(key))

    return F.transform(lines(text), digest)


def _hashed(rows: DataFrame, digest: str = "digest") -> DataFrame:
    """A digest as two numbers."""
    return rows.withColumns({"h1": F.xxhash64(digest), "h2": F.xxhash64(F.lit(1), digest)}).drop(digest)


class LineRuns:
    """Runs of line hashes in a shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, min_chars: int, fanout: int = 2) -> None:
        self.spark, self.min_docs, self.min_chars, self.fanout = spark, min_docs, min_chars, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = shared_folder(spark, "line-runs")
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.folder}/{name}").format("parquet").saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _merged(self, names: list[str]) -> DataFrame:
        """Sorted runs merged two by two; hashes in both have their counts added."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).withColumnsRenamed({"n": "n2", "top": "top2"})
            n = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
            rows = rows.join(more, ["h1", "h2"], "full").select("h1", "h2", n.alias("n"), F.greatest("top", "top2").alias("top"))
        return rows

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            names = self.levels[level]
            if len(names) >= self.fanout:
                self._write(self._merged(names), level + 1)
                self.levels[level] = []
                for name in names:
                    self._delete(name)
            level += 1

    def _delete(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """Hashes of the batch, with counts, that no run settles."""
        found = F.explode(F.array_distinct(F.array_compact(_digests(F.col("text"), self.min_chars))))
        hashes = _hashed(batch.select("doc_id", found.alias("digest")))
        rest = hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top"))
        for names in self.levels:
            for name in names:
                settled = self.spark.table(name).where(F.col("n") >= self.min_docs)
                rest = rest.join(settled, ["h1", "h2"], "left_anti")
        return rest

    def add(self, batch: DataFrame) -> None:
        """Add a batch of documents whose ids are smaller than all before."""
        self._write(self.unsettled(batch), 0)
        self._compact()

    def common(self) -> DataFrame:
        """Hashes in enough documents: ``h1``, ``h2`` and the largest id ``top``."""
        names = [name for level in self.levels for name in level]
        return self._merged(names).where(F.col("n") >= self.min_docs).select("h1", "h2", "top")


def _batches(docs: DataFrame, n: int) -> list[DataFrame]:
    """``n`` spans of document ids, the largest first; null ids are in the last. A span reads its own row groups."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return [docs]
    bounds = [low + (high - low + 1) * i // n for i in range(n)]
    out = []
    for i in reversed(range(n)):
        inside = F.col("doc_id") >= bounds[i] if i else F.lit(True)
        if i + 1 < n:
            inside = inside & (F.col("doc_id") < bounds[i + 1])
            inside = inside if i else inside | F.col("doc_id").isNull()
        elif i == 0:
            inside = F.lit(True)
        out.append(docs.where(inside))
    return out


def dedup_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """All columns, with lines in at least ``min_docs`` documents dropped from ``text`` but for the largest id.

    Adds ``n_lines`` (before) and ``n_dropped``. Hashes of lines meet the common ones in a join whose hot keys adaptive
    execution can split; only positions of dropped lines go back to the documents.
    """
    runs = LineRuns(docs.sparkSession, min_docs, min_chars, fanout)
    for batch in _batches(docs.select("doc_id", "text"), batches):
        runs.add(batch)
    row = docs.withColumn("__row", F.xxhash64("text"))
    placed = row.select(F.col("doc_id").alias("__doc"), F.col("__row").alias("__text"), F.posexplode(_digests(F.col("text"), min_chars)))
    placed = _hashed(placed.where(F.col("col").isNotNull()), "col")
    common = runs.common().withColumn("h3", F.xxhash64("h1", "h2"))  # a key of its own: both sides are exchanged anew
    found = placed.withColumn("h3", F.xxhash64("h1", "h2")).join(common, ["h1", "h2", "h3"])
    found = found.where(~F.col("__doc").eqNullSafe(F.col("top")))
    drops = found.groupBy("__doc", "__text").agg(F.collect_set("pos").alias("__drop"))
    same = row["doc_id"].eqNullSafe(F.col("__doc")) & row["__row"].eqNullSafe(F.col("__text"))
    joined = computed_once(row.join(drops, same, "left"), __lines=lines(F.col("text")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    rebuilt = F.array_join(F.transform(kept, lambda i: F.get(F.col("__lines"), i)), "\n")
    return joined.select(
        *[c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")],
        F.when(F.col("__drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(rebuilt).alias("text"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
