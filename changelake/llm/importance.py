"""Importance resampling towards a target: documents whose word features are more usual in the target come first.

The tokenizers library splits a lower-cased text into words with their offsets, by a fixed pattern and without a trained
vocabulary. A feature is a run of consecutive words joined by single spaces: the window from one word's start to a later
word's end, as it stands where the words lie one character apart. CRC-32 deals features into buckets, and the buckets'
counts in the corpus and in the target make two smoothed histograms. A document's weight is the sum of its features'
log ratios; with Gumbel noise from its id, the documents of the highest scores are a sample by weight without repeats.

Each text is split once: its bucket numbers are written, and histograms and sums read these. Only the histograms, as many
numbers as there are buckets, and a count for each task of the final sort come to the driver.

Null and empty texts have no words and a weight of 0. A null id is hashed like an empty one and sorted last. Repeated
rows count each for itself. Other columns are dropped; an empty corpus gives no rows, an empty target leaves every
gain to the corpus alone.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm.storage import delete, shared_folder, ship

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: What words consist of, after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Features remembered in a worker.
REMEMBERED = 500_000
#: Characters of a text that are split at once, up to the next character that is in no word.
SPAN = 1 << 16


class _Buckets(dict):
    """The bucket of a feature."""

    def __init__(self, n: int) -> None:
        super().__init__()
        self.n = n

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[feature] = zlib.crc32(feature.encode()) % self.n
        return value


@lru_cache(maxsize=4)
def _buckets(n: int) -> _Buckets:
    return _Buckets(n)


@lru_cache(maxsize=1)
def _splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(WORD), behavior="removed", invert=True)


def _spans(text: str, span: int) -> Iterator[str]:
    """The text in parts that end where no word does."""
    at = 0
    while at < len(text):
        end = at + span
        while end < len(text) and (text[end].isalnum() or ord(text[end]) > 0x7F):
            end += 1
        yield text[at:end]
        at = end


def words_of(text: str) -> list[tuple[str, tuple[int, int]]]:
    """Words of a lower-cased text with the places where they start and end."""
    return _splitter().pre_tokenize_str(text)


def windows(text: str, words: list[tuple[str, tuple[int, int]]], size: int) -> list[str]:
    """Runs of ``size`` words: the text between two offsets, or the words joined where more than a space is between them."""
    if size == 1:
        return [word for word, _ in words]
    n, gap = len(words) - size + 1, np.zeros(len(words) + 1, np.int64)
    offsets = np.array([at for _, at in words], np.int64).reshape(-1, 2)
    apart = offsets[1:, 0] - offsets[:-1, 1]
    odd = [a != 1 or text[at] != " " for a, at in zip(apart.tolist(), offsets[:-1, 1].tolist(), strict=True)]
    gap[1 : len(odd) + 1] = np.cumsum(odd)
    starts, ends = offsets[:, 0].tolist(), offsets[:, 1].tolist()
    return [
        text[starts[i] : ends[i + size - 1]] if gap[i + size - 1] == gap[i] else " ".join([word for word, _ in words[i : i + size]])
        for i in range(max(0, n))
    ]


def _features(low: int, high: int, n_buckets: int):
    kind = np.uint16 if n_buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _buckets(n_buckets).__getitem__
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                n_words, found = [], []
                for data in part.column(2).to_pylist():
                    text = (data or b"").lower().decode("utf-8", "replace")  # of bytes: A-Z only
                    if high == 1:
                        n, numbers = 0, []
                        for span in _spans(text, SPAN):
                            words = words_of(span)
                            n += len(words)
                            numbers += [bucket(word) for word, _ in words]
                    else:
                        words = words_of(text)
                        n = len(words)
                        numbers = [bucket(f) for size in range(low, high + 1) for f in windows(text, words, size)]
                    n_words.append(n)
                    found.append(np.array(numbers, kind).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n_words, pa.int64()), pa.array(found, pa.binary())],
                    names=["doc_id", "text_hash", "n_words", "buckets"],
                )

    return run, kind


def _counted(n_buckets: int, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column(0).to_pylist()), kind)
            total += np.bincount(numbers, minlength=n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return run


def _weighed(gains: np.ndarray, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weights = [], []
            for data in batch.column(3):
                numbers = np.frombuffer(data.as_buffer(), kind)
                n.append(len(numbers))
                weights.append(int(gains[numbers].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int64()), pa.array(weights, pa.int64())],
                names=["doc_id", "text_hash", "n_words", "n_features", "weight"],
            )

    return run


def histogram(features: DataFrame, n_buckets: int, kind) -> np.ndarray:
    """How often each bucket occurs; no more rows than buckets come to the driver."""
    counted = features.select("buckets").mapInArrow(_counted(n_buckets, kind), "bucket bigint, n bigint")
    out = np.zeros(n_buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural logarithm of target share over corpus share, each bucket counted once more, rounded down."""
    n = len(corpus)
    over = (target + 1).astype(float) * float(corpus.sum() + n)
    return np.floor(1000 * np.log(over / ((corpus + 1).astype(float) * float(target.sum() + n)))).astype(np.int64)


def _noise(seed: int) -> Column:
    """Thousandths of Gumbel noise from the SHA-256 of seed and id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _ranked(rows: DataFrame, folder: str, percent: int) -> DataFrame:
    """Place in the order of scores for the share that is drawn of the ``eligible`` rows.

    The rows are sorted over all tasks and written; a row's place is its place in its file's task plus the rows of the
    tasks before, one number for each.
    """
    spark = rows.sparkSession
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed.write.option("compression", "zstd").parquet(f"{folder}/sorted")
    placed = spark.read.schema(placed.schema).parquet(f"{folder}/sorted")
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_if("eligible").alias("own")).collect()
    n = [0] * (1 + max((row["part"] for row in counts), default=0))
    for row in counts:
        n[row["part"]] = row["n"]
    drawn = percent * sum(row["own"] for row in counts) // 100
    before = F.array(*[F.lit(x).cast("bigint") for x in list(accumulate(n, initial=0))[:-1]])
    rank = F.element_at(before, (part + 1).cast("int")) + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("rank", F.when(F.col("eligible") & (rank <= drawn), rank)).drop("place", "eligible", "text_hash")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, sizes: tuple[int, int] = (1, 1),
    n_buckets: int = 10_000, seed: int = 2024,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document of ``docs``.

    ``target`` has a column ``text``. Features are all runs of ``sizes[0]`` to ``sizes[1]`` words. Of the documents with
    at least ``min_words`` words, ``percent`` of a hundred get a rank from 1; ties of scores go to the smaller id.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    low, high = sizes
    if not 1 <= low <= high:
        raise ValueError("features have one word at least")
    run, kind = _features(low, high, n_buckets)
    folder, own = shared_folder(spark, "importance"), docs.schema["doc_id"].dataType.simpleString()

    def features(rows: DataFrame, id: Column, type: str, name: str) -> DataFrame:
        source = rows.select(id.alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary"))
        out = source.mapInArrow(run, f"doc_id {type}, text_hash bigint, n_words bigint, buckets binary")
        out.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(out.schema).parquet(f"{folder}/{name}")

    corpus = features(docs, F.col("doc_id"), own, "corpus")
    wanted = features(target, F.lit(None).cast("bigint"), "bigint", "target")
    gains = bucket_gains(histogram(corpus, n_buckets, kind), histogram(wanted, n_buckets, kind))
    weighed = corpus.mapInArrow(_weighed(gains, kind), f"doc_id {own}, text_hash bigint, n_words bigint, n_features bigint, weight bigint")
    scored = weighed.withColumns({"score": F.col("weight") + _noise(seed), "eligible": F.col("n_words") >= min_words})
    out = _ranked(scored, folder, percent)
    for name in ("corpus", "target"):
        delete(spark, f"{folder}/{name}")
    return out
