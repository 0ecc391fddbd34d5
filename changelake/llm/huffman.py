"""Token files: ids in a canonical Huffman code of bounded length.

``write_tokens`` makes a folder of three Parquet tables. ``codes`` holds a length for each id that occurs, from the
counts over all documents; the codes follow from the lengths. ``segments`` holds documents in ascending order of their
ids: the coded bits of some hundred thousand ids, the documents' ids and sizes, the place of the first id in the whole,
and the bit offset of every 128th id. A segment is decoded by itself, and inside it all blocks of 128 ids are decoded
side by side, each from its offset, by looking up the next bits in a table. Between the pass that encodes and counts and
the one that codes, ``ids`` holds the uncoded ids.

Null and empty texts have the end id only. Null document ids come first; rows with one id follow each other by a hash
of their text. Extra columns are dropped, and no documents make files without segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm.storage import delete, saved, ship
from changelake.llm.tokens import encoded

BLOCK = 128
SEGMENT = 1 << 18
#: Bits of the longest code; more only where there are more ids than codes of this length.
LIMIT = 16


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits for positive counts, by package-merge.

    Level by level from the longest codes up, pairs of the cheapest items are packages that compete with the
    symbols; the cheapest ``2 n - 2`` items of the last level say how often each symbol was taken.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    items, symbols = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        even = items[: len(items) // 2 * 2]
        both = np.concatenate([weights, even[0::2] + even[1::2]])
        by_cost = np.argsort(both, kind="stable")
        items = both[by_cost]
        symbols.append(by_cost < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(symbols):
        taken = int(level[:take].sum())
        lengths[:taken] += 1
        take = 2 * (take - taken)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code: shorter codes first, ids ascending among equals."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = np.asarray(ids, np.int64)[order], np.asarray(lengths, np.int64)[order]
        self.limit = int(self.lengths.max(initial=1))
        # a code is the place of its first continuation of full length, without the bits that aren't its own
        places = np.concatenate([[0], np.cumsum(1 << (self.limit - self.lengths))])
        self.codes = places[:-1] >> (self.limit - self.lengths)

    def by_id(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes and lengths to be looked up by id."""
        size = int(self.ids.max(initial=0)) + 1
        codes, lengths = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        codes[self.ids], lengths[self.ids] = self.codes, self.lengths
        return codes, lengths

    def by_bits(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length for every value of the next ``limit`` bits."""
        repeats = 1 << (self.limit - self.lengths)
        ids, lengths = np.zeros(1 << self.limit, "<u4"), np.ones(1 << self.limit, np.int64)
        ids[: repeats.sum()], lengths[: repeats.sum()] = np.repeat(self.ids, repeats), np.repeat(self.lengths, repeats)
        return ids, lengths


def packed_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """The coded bits, highest first, and the bit offset of every ``block``-th id."""
    own = lengths[ids]
    ends = np.cumsum(own)
    at = ends - own
    word, value = at >> 5, codes[ids] << (64 - (at & 31) - own).astype(np.uint64)
    out = np.zeros((int(ends[-1]) >> 5) + 2, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] |= np.bitwise_or.reduceat(value >> np.uint64(32), first)
    out[word[first] + 1] |= np.bitwise_or.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], at[::block]


def unpacked_ids(data: bytes, n: int, checkpoints: np.ndarray, ids: np.ndarray, lengths: np.ndarray, limit: int, block: int = BLOCK) -> np.ndarray:
    """``n`` ids from coded bits; all blocks take a step at a time."""
    raw = np.frombuffer(data + bytes(8 + limit * block // 8), np.uint8).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at, mask = np.array(checkpoints, np.int64), np.uint32((1 << limit) - 1)
    out, last = np.empty((len(at), block), "<u4"), len(ahead) - 1
    for step in range(block):
        bits = (ahead[np.minimum(at >> 3, last)] >> (32 - limit - (at & 7)).astype(np.uint32)) & mask
        out[:, step] = ids[bits]
        at += lengths[bits]
    return out.reshape(-1)[:n]


def _segments(code: Code, starts: dict[int, int], size: int):
    codes, lengths = code.by_id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = [], 0  # (part, idx, doc, n, ids, before) of consecutive documents

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join([r[4] for r in rows]), "<u4").astype(np.int64)
            bits, checkpoints = packed_bits(ids, codes, lengths)
            part, _, _, _, _, before = rows[0]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([starts[part] + before], pa.int64()), pa.array([len(ids)], pa.int64()),
                    pa.array([[r[2] for r in rows]], pa.list_(kind)), pa.array([[r[3] for r in rows]], pa.list_(pa.int64())),
                    pa.array([bits], pa.binary()), pa.array([checkpoints], pa.list_(pa.int64())),
                ],
                names=["part", "start", "n_ids", "doc_ids", "doc_tokens", "bits", "checkpoints"],
            )

        kind = pa.int64()
        for batch in batches:
            kind = batch.column(2).type
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if rows and (total >= size or row[0] != rows[-1][0] or row[1] != rows[-1][1] + 1):
                    yield flush()
                    rows, total = [], 0
                rows.append(row)
                total += row[3]
        if rows:
            yield flush()

    return run


def _with_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, and behind a task's last one a row of place -1 whose ``ids`` say how often each id occurs in it."""
    total, batch = np.zeros(0, np.int64), None
    for batch in batches:
        values = batch.column(4)
        ends = values.offset, values.offset + len(values)
        at = np.frombuffer(values.buffers()[1], np.int32)
        own = np.bincount(np.frombuffer(values.buffers()[2], "<u4", (int(at[ends[1]]) - int(at[ends[0]])) // 4, int(at[ends[0]])))
        if len(own) > len(total):
            total = np.concatenate([total, np.zeros(len(own) - len(total), np.int64)])
        total[: len(own)] += own
        yield batch
    if batch is not None:
        part, place, doc, n, _, before = (batch.schema.field(i) for i in range(6))
        rows = [
            batch.column(0).slice(0, 1), pa.array([-1], place.type), pa.nulls(1, doc.type), pa.array([0], n.type),
            pa.array([total.astype("<i8").tobytes()], pa.binary()), pa.array([0], before.type),
        ]
        yield pa.RecordBatch.from_arrays(rows, names=batch.schema.names)


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of all rows of a task, added up, as rows of id and number."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for data in batch.column(0):
            own = np.frombuffer(data.as_buffer(), "<i8")
            if len(own) > len(total):
                total = np.concatenate([total, np.zeros(len(own) - len(total), np.int64)])
            total[: len(own)] += own
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int = 1, segment: int = SEGMENT, added_tokens: bool = False
) -> None:
    """Encode all documents with a vocabulary file and write them to the folder."""
    spark = docs.sparkSession
    ship(spark)
    order = ["doc_id", F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.select("doc_id", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"part int, idx bigint, doc_id {kind}, n_tokens bigint, ids binary, before bigint"
    ids = saved(encoded(ranged, path, end_id, _with_counts, schema, added_tokens), f"{folder}/ids")
    # a row of counts for each task, added up in as many tasks as run at once; then at most as many rows as the vocabulary has
    counts = ids.where("idx < 0").select("ids").coalesce(spark.sparkContext.defaultParallelism)
    counted = counts.mapInArrow(_added_up, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    ids = ids.where("idx >= 0")
    counts = counted.toPandas().sort_values("id")
    limit = max(LIMIT, (len(counts) - 1).bit_length())
    lengths = code_lengths(counts["n"].to_numpy(), limit)
    code = Code(counts["id"].to_numpy(), lengths)
    table = [(int(i), int(n)) for i, n in zip(code.ids, code.lengths, strict=True)]
    spark.createDataFrame(table, "id bigint, length int").coalesce(1).write.parquet(f"{folder}/codes")
    # one row for each writing task
    sums = sorted((r["part"], r["n"]) for r in ids.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts, total = {}, 0
    for part, n in sums:
        starts[part], total = total, total + n
    schema = f"part int, start bigint, n_ids bigint, doc_ids array<{kind}>, doc_tokens array<bigint>, bits binary, checkpoints array<bigint>"
    saved(ids.mapInArrow(_segments(code, starts, segment), schema), f"{folder}/segments", "uncompressed")
    delete(spark, f"{folder}/ids")


def _decoded(code: Code):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, lengths = code.by_bits()
        for batch in batches:
            for start, n, docs, sizes, data, checkpoints in zip(*batch.columns, strict=True):
                ids = unpacked_ids(data.as_py(), n.as_py(), checkpoints.values.to_numpy(), symbols, lengths, code.limit).tobytes()
                sizes = sizes.values.to_numpy()
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.values, pa.array(start.as_py() + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array([ids[4 * (e - s) : 4 * e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: ``doc_id``, ``start`` (ids before it), ``n_tokens`` and ``ids``, end id included."""
    ship(spark)
    table = spark.read.parquet(f"{folder}/codes").toPandas()  # bounded by the vocabulary
    code = Code(table["id"].to_numpy(), table["length"].to_numpy())
    segments = spark.read.parquet(f"{folder}/segments").select("start", "n_ids", "doc_ids", "doc_tokens", "bits", "checkpoints")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    return segments.mapInArrow(_decoded(code), f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
