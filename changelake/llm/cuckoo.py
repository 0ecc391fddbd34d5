"""Exact dedup with an index of cuckoo filters over the digests of live texts.

Two texts are equal when they are the same after each run of separators is replaced by one space; a text's key is the
SHA-256 of that. The index lives in a folder of Parquet tables:

- ``members``: a row for each row put in, with its key; taken as they come, so a text's copies never meet in one task.
- ``keys``: the live keys with the number of their rows and the row that stays, dealt into *shards* by key. A batch adds
  a run of its own; runs are merged after ``RUNS`` of them and when rows leave.
- ``filters``: for each shard a cuckoo filter, 16 bits for each live key, in buckets of four.

A batch is first cut down to its distinct keys. These probe the filters: a miss is a new key, and a hit is verified
against the stored keys of its shard, so only hits meet them. New keys go into the filters; a key that finds no place
after many moves overflows its filter, which is built anew, at least twice as large, from the shard's stored keys. When
shards hold more than twice the keys they are meant for, all stored keys are dealt into more of them. Taking rows out
lowers a key's number, and a key without rows leaves the filter.

Tables are written under the number of the change, and ``current`` names the last complete one, so a change that fails
half way leaves the index as it was. Changes come one at a time, and what was read before one is gone after it.

A null text is an empty one. Of equal texts the row with the smallest id stays; null ids count as larger than all
others, and of rows that agree in id any one. Other columns are dropped, and empty tables change nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changelake.llm.storage import delete, exists, shared_folder, ship, written
from changelake.llm.texts import SPACE_PATTERN
from changelake.plans.joins import lookup

SLOTS = 4
#: Places a key may push others from before its filter counts as full.
MOVES = 500
#: Keys for each shard that an index is laid out for.
SHARD_KEYS = 1 << 18
#: Runs of keys before they are merged.
RUNS = 8
LOAD = 0.84
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Full(Exception):
    """A key found no place."""


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; a key may be in two buckets, each told by the other and the fingerprint."""

    def __init__(self, buckets: int, data: bytes | None = None) -> None:
        self.buckets = buckets
        raw = np.zeros(buckets * SLOTS, "<u2") if data is None else np.frombuffer(data, "<u2").copy()
        self.slots = raw.reshape(buckets, SLOTS)  # a bucket's free slots come last

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, math.ceil(math.log2(max(1, keys) / (SLOTS * LOAD)))))

    def tobytes(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of digests, given as rows of four 64-bit numbers."""
        prints = (digests[:, 0] & np.uint64(0xFFFF)).astype(np.int64)
        prints[prints == 0] = 1
        first = (digests[:, 1] & np.uint64(self.buckets - 1)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        moved = (np.asarray(prints).astype(np.uint64) * _MIX) >> np.uint64(32)
        return bucket ^ (moved & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        """Whether each digest may be there; one that was put in always is."""
        prints, first, second = self._places(digests)
        return ((self.slots[first] == prints[:, None]) | (self.slots[second] == prints[:, None])).any(axis=1)

    def insert(self, digests: np.ndarray) -> None:
        """Put in distinct digests that aren't there yet; raises ``Full`` when one finds no place."""
        prints, first, second = self._places(digests)
        left = self._settle(prints, first)
        left = left[self._settle(prints[left], second[left])]
        for i in left.tolist():
            self._push(int(prints[i]), int(second[i]))

    def _settle(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Fill free slots of the given buckets; returns which fingerprints found none."""
        order = np.argsort(buckets, kind="stable")
        at = buckets[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        slot = (self.slots[at] != 0).sum(axis=1) + rank
        fits = slot < SLOTS
        self.slots[at[fits], slot[fits]] = prints[order][fits]
        return order[~fits]

    def _push(self, mark: int, bucket: int) -> None:
        for step in range(MOVES):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return
            slot = (step * 7 + mark) % SLOTS
            mark, self.slots[bucket, slot] = int(self.slots[bucket, slot]), mark
            bucket = int(self._other(np.int64(bucket), mark))
        raise Full

    def remove(self, digests: np.ndarray) -> None:
        """Take out digests that are there."""
        for mark, *buckets in zip(*self._places(digests), strict=True):
            for bucket in buckets:
                at = np.flatnonzero(self.slots[bucket] == mark)
                if len(at):
                    row = np.delete(self.slots[bucket], at[0])
                    self.slots[bucket] = np.append(row, 0)
                    break


def _numbers(digests: pa.ChunkedArray) -> np.ndarray:
    """Digests of 32 bytes as rows of four 64-bit numbers."""
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)


def _filter_of(table: pa.Table) -> CuckooFilter | None:
    if not table.num_rows:
        return None
    return CuckooFilter(table.column("buckets")[0].as_py(), table.column("slots")[0].as_py())


def _probe(left: pa.Table, right: pa.Table) -> pa.Table:
    """Keys of a shard with ``hit``; a shard without a filter has none."""
    known = _filter_of(right)
    if not left.num_rows:
        return pa.table({"shard": pa.array([], pa.int32()), "key": pa.array([], pa.binary()), "hit": pa.array([], pa.bool_())})
    hits = np.zeros(left.num_rows, bool) if known is None else known.contains(_numbers(left.column("key")))
    return left.select(["shard", "key"]).append_column("hit", pa.array(hits, pa.bool_()))


def _row(shard: int, filter: CuckooFilter, n: int, full: bool = False) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array([shard], pa.int32()), "n_keys": pa.array([n], pa.int64()),
            "buckets": pa.array([filter.buckets], pa.int64()), "slots": pa.array([None if full else filter.tobytes()], pa.binary()),
        }
    )


def _change(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """A shard's filter with new keys in it and dead ones out; without slots if it overflows."""
    n = right.column("n_keys")[0].as_py() if right.num_rows else 0
    gone = np.array(left.column("gone").to_pylist(), bool)
    digests = _numbers(left.column("key"))
    n += len(gone) - 2 * int(gone.sum())
    filter = _filter_of(right) or CuckooFilter.sized(n)
    try:
        filter.remove(digests[gone])
        filter.insert(digests[~gone])
    except Full:
        return _row(key[0].as_py(), filter, n, full=True)
    return _row(key[0].as_py(), filter, n)


def _rebuilt(key: tuple, table: pa.Table) -> pa.Table:
    """A filter over all stored keys of a shard, larger than the ``buckets`` of one that overflowed."""
    digests = _numbers(table.column("key"))
    filter = CuckooFilter(max(2 * table.column("buckets")[0].as_py(), CuckooFilter.sized(len(digests)).buckets))
    while True:
        try:
            filter.insert(digests)
            return _row(key[0].as_py(), filter, len(digests))
        except Full:
            filter = CuckooFilter(2 * filter.buckets)


def plain_text(text: Column) -> Column:
    """The text with each run of separators as one space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_PATTERN, " ")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` and ``row``, a number that no two rows of these share."""
    key = F.unhex(F.sha2(plain_text(F.col("text")).cast("binary"), 256))
    return docs.select("doc_id", key.alias("key"), F.monotonically_increasing_id().alias("row"))


_FILTERS = "shard int, n_keys bigint, buckets bigint, slots binary"
_STATE = "change int, base int, shards int, kind string, removed boolean"


class DedupIndex:
    """The live texts in a folder."""

    def __init__(self, spark: SparkSession, folder: str, shards: int | None = None) -> None:
        """Open the folder's index, or lay out an empty one with so many shards, by default as its batches ask."""
        ship(spark)
        self.spark, self.folder = spark, folder.rstrip("/")
        self.change, self.base, self.shards, self.kind, self.removed = -1, 0, shards, None, False
        if exists(spark, f"{self.folder}/current"):
            last = spark.read.schema(_STATE).parquet(f"{self.folder}/current/*").orderBy(F.col("change").desc()).first()
            self.change, self.base, self.shards, self.kind, self.removed = last

    def _read(self, name: str, *changes: int) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder}/{name}/{change}" for change in changes])

    def _write(self, df: DataFrame, name: str, change: int) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{name}/{change}")
        return self._read(name, change)

    def _runs(self) -> DataFrame:
        if self.change < 0:
            return self.spark.createDataFrame([], f"shard int, key binary, n bigint, owner struct<none: boolean, doc_id: {self.kind}, row: bigint>")
        return self._read("keys", *range(self.base, self.change + 1))

    def _merged(self, runs: DataFrame) -> DataFrame:
        return runs.groupBy("shard", "key").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))

    def keys(self) -> DataFrame:
        """Live keys: ``shard``, ``key``, ``n`` (rows) and ``owner``, the row that stays (``none``, ``doc_id``, ``row``)."""
        return self._merged(self._runs())

    def filters(self) -> DataFrame:
        """``shard``, ``n_keys``, ``buckets`` and ``slots`` of each filter."""
        return self._read("filters", self.change) if self.change >= 0 else self.spark.createDataFrame([], _FILTERS)

    def members(self) -> DataFrame:
        """Rows that are in: ``key``, ``none`` (no id), ``doc_id`` and ``row``."""
        rows = self._read("members", *range(self.change + 1))
        if not self.removed:
            return rows.drop("sign")
        return rows.groupBy("key", "none", "doc_id", "row").agg(F.sum("sign").alias("sign")).where("sign > 0").drop("sign")

    def _dealt(self, keys: DataFrame) -> DataFrame:
        """Shards go by the last bytes of a key; filters by its first."""
        return keys.withColumn("shard", F.pmod(F.conv(F.hex(F.substring("key", 26, 7)), 16, 10).cast("bigint"), F.lit(self.shards)).cast("int"))

    def _apply(self, changed: DataFrame, runs: DataFrame, now: int) -> None:
        """Write the filters of this change: ``changed`` has ``shard``, ``key`` and ``gone``, ``runs`` all that live."""
        parts = changed.groupBy("shard").cogroup(self.filters().groupBy("shard"))
        filters = self._write(parts.applyInArrow(_change, _FILTERS), "tried", now)
        over = filters.where(F.col("slots").isNull()).select(F.col("shard").alias("__shard"), "buckets")
        if not over.isEmpty():
            stored = lookup(runs.select("shard", "key").distinct(), over, {"shard": "__shard"}, "inner")
            rebuilt = stored.groupBy("shard").applyInArrow(_rebuilt, _FILTERS)
            filters = filters.where(F.col("slots").isNotNull()).unionByName(rebuilt)
        self._write(filters, "filters", now)

    def _redealt(self, runs: DataFrame, n: int, now: int) -> None:
        """All stored keys dealt into as many shards as they are meant for, with filters of their own."""
        self.shards = math.ceil(n / SHARD_KEYS)
        stored = self._write(self._dealt(self._merged(runs).drop("shard")).select("shard", "key", "n", "owner"), "merged", now)
        none = stored.select("shard", "key", F.lit(1).cast("bigint").alias("buckets"))
        self._write(none.groupBy("shard").applyInArrow(_rebuilt, _FILTERS), "filters", now)
        self._write(stored, "keys", now)
        self.base = now

    def _finish(self, now: int) -> None:
        state = [(now, self.base, self.shards, self.kind, self.removed)]
        self.spark.createDataFrame(state, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/current/{now}")
        self.change = now
        old = [f"filters/{now - 1}", *[f"{name}/{now}" for name in ("tried", "probed", "merged")]]
        if self.base == now:
            old += [f"keys/{i}" for i in range(max(0, now - 2 * RUNS), now)]
        for name in old:
            delete(self.spark, f"{self.folder}/{name}")

    def insert(self, docs: DataFrame) -> None:
        """Put in rows of ``doc_id`` and ``text``."""
        self.insert_keyed(keyed(docs).withColumn("row", F.xxhash64(F.lit(self.change + 1), "row")))

    def insert_keyed(self, rows: DataFrame) -> None:
        """Put in rows of ``doc_id``, ``key`` and ``row``, the latter different in all rows that are ever put in."""
        now = self.change + 1
        self.kind = self.kind or rows.schema["doc_id"].dataType.simpleString()
        members = rows.select(
            "key", F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast(self.kind).alias("doc_id"), "row", F.lit(1).alias("sign"))
        members = self._write(members, "members", now)
        if self.shards is None:
            self.shards = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(members.count() / SHARD_KEYS))
        # a row for each key; copies are added up before they move
        batch = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("none", "doc_id", "row")).alias("owner"))
        batch = self._write(self._dealt(batch).select("shard", "key", "n", "owner"), "keys", now)
        probed = batch.select("shard", "key").groupBy("shard").cogroup(self.filters().groupBy("shard"))
        probed = self._write(probed.applyInArrow(_probe, "shard int, key binary, hit boolean"), "probed", now)
        # hits are verified against the stored keys; one that isn't among them is as new as a miss
        stored = self._runs()
        hits = probed.where("hit").select("shard", "key")
        unverified = hits.join(stored.select("shard", "key"), ["shard", "key"], "left_anti")
        fresh = probed.where("NOT hit").select("shard", "key").union(unverified).withColumn("gone", F.lit(False))
        runs = stored.unionByName(batch)
        n = probed.count() + (self.filters().agg(F.sum("n_keys")).first()[0] or 0)
        if n > 2 * SHARD_KEYS * self.shards:
            self._redealt(runs, n, now)
        else:
            self._apply(fresh, runs, now)
            if now - self.base >= RUNS:
                self._write(self._write(self._merged(runs), "merged", now), "keys", now)
                self.base = now
        self._finish(now)

    def remove(self, rows: DataFrame) -> None:
        """Take out the rows with these ids (column ``doc_id``); ids that aren't in change nothing."""
        if self.change < 0:
            return
        now = self.change + 1
        inside = self.members()
        asked = rows.select(F.col("doc_id").cast(self.kind).alias("__id")).where(F.col("__id").isNotNull()).distinct()
        leaving = lookup(inside, asked, {"doc_id": "__id"}, "left_semi").withColumn("sign", F.lit(-1))
        leaving = self._write(leaving.select("key", "none", "doc_id", "row", "sign"), "members", now)
        lost = leaving.groupBy(F.col("key").alias("__key")).agg(F.count(F.lit(1)).alias("lost"))
        # of the keys that lose rows, those left say which row stays
        touched = lookup(inside, lost.select("__key"), {"key": "__key"}, "left_semi")
        left = touched.join(leaving.select("key", "row"), ["key", "row"], "left_anti")
        owners = left.groupBy(F.col("key").alias("__owned")).agg(F.min(F.struct("none", "doc_id", "row")).alias("new"))
        counted = lookup(lookup(self.keys(), lost, {"key": "__key"}), owners, {"key": "__owned"})
        owner = F.when(F.col("lost").isNull(), F.col("owner")).otherwise(F.col("new"))
        counted = counted.select("shard", "key", (F.col("n") - F.coalesce("lost", F.lit(0))).alias("n"), owner.alias("owner"))
        counted = self._write(counted, "merged", now)
        live = self._write(counted.where("n > 0"), "keys", now)
        self._apply(counted.where("n <= 0").select("shard", "key", F.lit(True).alias("gone")), live, now)
        self.base, self.removed = now, True
        self._finish(now)

    def verdicts(self) -> DataFrame:
        """Every row that is in: ``doc_id``, ``row``, ``key``, ``keep_id``, ``group_size``, ``first`` (it is the one that stays)."""
        keys = self.keys().select(F.col("key").alias("__key"), "n", "owner")
        found = lookup(self.members(), keys, {"key": "__key"}, "inner")
        return found.select(
            "doc_id", "row", "key", F.col("owner.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
            (F.col("row") == F.col("owner.row")).alias("first"),
        )


def copies(docs: DataFrame, batches: int = 4) -> DataFrame:
    """The verdicts on a table, put into a new index in so many batches."""
    spark = docs.sparkSession
    rows = written(keyed(docs.select("doc_id", "text")), "keyed")
    index = DedupIndex(spark, shared_folder(spark, "cuckoo"))
    for i in range(batches):
        index.insert_keyed(rows.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == i))
    return index.verdicts()


def without_copies(docs: DataFrame, batches: int = 4) -> DataFrame:
    """All columns of one row of each group of equal texts."""
    stay = copies(docs, batches).where("first").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    key = F.unhex(F.sha2(plain_text(docs["text"]).cast("binary"), 256))
    rows = docs.withColumn("__text", key)
    found = rows.join(stay, (F.col("__text") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    # rows that agree in id and key: one of them
    nth = F.row_number().over(W.partitionBy("__text", "doc_id").orderBy(F.xxhash64("text")))
    return found.withColumn("__nth", nth).where("__nth = 1").select(*docs.columns)
