"""Packing by power-of-two decomposition.

A document of ``n`` ids is cut into full sequences of the greatest length and then into the binary digits of what is
left, longest first. Every piece is a sequence of its own, so no sequence crosses documents and none needs padding,
and sequences of one length make up a bucket, from which batches of equal shape are drawn.

Null and empty texts have the end id only: one piece of length 1. Repeated rows are packed each for itself, and extra
columns are dropped. An empty table gives no sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changelake.llm.storage import ship, written
from changelake.llm.tokens import encoded
from changelake.plans.joins import lookup


def lengths(n: int, longest: int) -> list[int]:
    """Full lengths, then the binary digits of the rest from the highest down."""
    full, rest = divmod(n, longest)
    return [longest] * full + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def _cut(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = dict.fromkeys((1 << b for b in range(longest.bit_length())), 0)
        for batch in batches:
            rows, starts, sizes, nth, ids = [], [], [], [], []
            for row, (n, data) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                at = 0
                for length in lengths(n, longest):
                    rows.append(row)
                    starts.append(at)
                    sizes.append(length)
                    nth.append(seen[length])
                    ids.append(data[4 * at : 4 * (at + length)])
                    seen[length] += 1
                    at += length
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows), batch.column(2).take(rows), pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()), batch.column(3).take(rows), pa.array(nth, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["part", "doc_id", "start", "length", "doc_tokens", "nth", "ids"],
            )

    return run


def pack(docs: DataFrame, path: str, end_id: int = 1, longest: int = 2048, added_tokens: bool = False) -> DataFrame:
    """Sequences: ``sequence_id``, ``doc_id``, ``start``, ``length``, ``offset`` (0), ``doc_tokens`` and ``ids``.

    ``longest`` is a power of two. Sequence ids count from 0 through the buckets, the longest first, and inside a
    bucket in the order of the partitions, so a batch of one shape is a range of ids. The sequences are written once;
    only counts per partition and length, a few numbers for each task, are summed to number them.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the greatest length must be a power of two")
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"part int, doc_id {kind}, start bigint, length bigint, doc_tokens bigint, nth bigint, ids binary"
    pieces = written(encoded(docs, path, end_id, _cut(longest), schema, added_tokens), "packed")
    # a row for each task and length: numbered inside each length, and the lengths among themselves
    counts = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "packed-counts")
    upwards = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    own = counts.withColumn("first", F.coalesce(F.sum("n").over(upwards), F.lit(0)))
    buckets = counts.groupBy(F.col("length").alias("__length")).agg(F.sum("n").alias("__n"))  # as many rows as lengths
    buckets = buckets.withColumn("base", F.coalesce(F.sum("__n").over(W.orderBy(F.col("__length").desc()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    first = lookup(own, buckets.drop("__n"), {"length": "__length"}, "inner")
    first = written(first.select(F.col("length").alias("__of"), F.col("part").alias("__part"), (F.col("first") + F.col("base")).alias("first")), "packed-first")
    # written, so that Spark knows its size: the pieces stay where they are while it is small enough to be sent to them
    joined = lookup(pieces, first, {"length": "__of", "part": "__part"}, "inner")
    return joined.select(
        (F.col("first") + F.col("nth")).alias("sequence_id"), "doc_id", "start", "length",
        F.lit(0).cast("bigint").alias("offset"), "doc_tokens", "ids",
    )
