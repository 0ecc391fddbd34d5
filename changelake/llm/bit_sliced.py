"""Exact top-k inner products on a bit-sliced index.

The index cuts vectors into blocks and keeps, for each component, the bits of its quantised values as bitmaps over the
rows of the block, one for each binary place. For a query the bitmaps of all components are added, each shifted by the
places of the query's value, by full adders on whole words of 64 rows; the sums are bitmaps again. From the highest
bitmap down, rows with the bit set are taken while they fit among the ``k`` best, which halves the field at each place.
Sums of the rows that remain at the boundary are read from the bitmaps, so their order and ties are exact.

Blocks of the index meet blocks of queries in a grid; each cell returns its ``k`` best rows for each of its queries,
and cells are merged by a heap-like aggregate of at most ``k`` rows from each cell. Neither side goes through the
driver and no pair of rows is ever listed.

Vectors that are null or have a null or non-finite component take no part, nor do those too long for scores of 64 bits
(``LONGEST``); vectors of fewer components than others count as zero in what they lack. A row repeated with the same id
counts once for each repeat as a candidate; a query is an id, with the least of its vectors, and all rows with it are its
own. Null ids take no part. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changelake.llm.storage import ship, written

ROWS, QUERIES = 32_768, 256
#: Bound on the squared length of a scaled vector: products of shorter ones are numbers of 64 bits, whatever their dimension.
LONGEST = float(1 << 61)


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """Signed binary digits of a number, no two next to each other: ``(place, 1 or -1)``."""
    place = 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            yield place, digit
            value -= digit
        value >>= 1
        place += 1


class Slices:
    """Bitmaps of a block: for each component its lowest value and the bits of what is above it."""

    def __init__(self, values: np.ndarray) -> None:
        self.n, dims = values.shape
        self.words = -(-self.n // 64)
        self.low = values.min(axis=0)
        above = (values - self.low).astype(np.uint64)
        self.places = [int(x).bit_length() for x in above.max(axis=0)]
        padded = np.zeros((self.words * 64, dims), np.uint64)
        padded[: self.n] = above
        self.bits = [
            np.packbits(padded[:, d, None] >> np.arange(p, dtype=np.uint64)[None] & 1, axis=0, bitorder="little").T.copy().view("<u8")
            for d, p in enumerate(self.places)
        ]  # [component][place] -> words; needs a little-endian machine, as do the ids files
        self.all = np.packbits(np.arange(self.words * 64) < self.n, bitorder="little").view("<u8")

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the sums, lowest first, and the constant to be added to them.

        A digit -1 adds the complement of the component's bits, and the constant makes up for it.
        """
        columns: dict[int, list[np.ndarray]] = {}
        constant = int(query @ self.low)
        for d in np.flatnonzero(query):
            for place, digit in _digits(int(query[d])):
                if digit < 0:
                    constant -= ((1 << self.places[d]) - 1) << place
                for p, bits in enumerate(self.bits[d]):
                    columns.setdefault(place + p, []).append(bits if digit > 0 else ~bits)
        out, place = [], 0
        while columns:
            addends = columns.pop(place, [])
            carries = columns.setdefault(place + 1, []) if len(addends) > 1 else []
            while len(addends) > 2:
                a, b, c = addends.pop(), addends.pop(), addends.pop()
                either = a ^ b
                addends.insert(0, either ^ c)
                carries.append(a & b | either & c)
            if len(addends) == 2:
                a, b = addends
                carries.append(a & b)
                addends = [a ^ b]
            out.append(addends[0] if addends else np.zeros(self.words, "<u8"))
            place += 1
        return out, constant

    def top(self, query: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of rows among which the ``k`` best of the allowed ones are, ties included."""
        slices, constant = self.scores(query)
        sure, field, count = np.zeros(self.words, "<u8"), self.all & allowed, 0
        for bits in reversed(slices):
            ones = field & bits
            n = int(np.bitwise_count(ones).sum())
            if count + n > k:
                field = ones  # the k-th is among them
            else:
                sure, field, count = sure | ones, field & ~bits, count + n
                if count == k:
                    field = np.zeros_like(field)
                    break
        rows = np.flatnonzero(np.unpackbits((sure | field).view(np.uint8), bitorder="little"))
        total = np.zeros(len(rows), np.int64)
        for place, bits in enumerate(slices[:64]):  # sums of 64 bits: what overflows on the way comes back with the constant
            total += (bits[rows >> 6] >> (rows & 63).astype(np.uint64) & 1).astype(np.int64) << place
        return rows, total + np.array(constant % (1 << 64), np.uint64).astype(np.int64)


def quantised(vector: Column, scale: float) -> Column:
    """``floor(scale * x)`` of each component as double; null for vectors that take no part."""
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") * F.lit(float(scale)), F.lit(2.0)))
    return F.when(~bad & (length < LONGEST), values)


def _matrix(column: pd.Series) -> np.ndarray:
    out = np.zeros((len(column), max(map(len, column), default=0)), np.int64)
    for i, x in enumerate(column):
        out[i, : len(x)] = x
    return out


def _cell(k: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """One block of the index and one of queries: ``k`` rows for each query, more where they tie."""
        frame = rows.to_pandas()
        queries, frame = frame[frame["is_query"]], frame[~frame["is_query"]]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(queries) and len(frame):
            frame = frame.sort_values("id", kind="stable")
            ids, values, asked = frame["id"].to_numpy(), _matrix(frame["x"]), _matrix(queries["x"])
            dims = max(values.shape[1], asked.shape[1])
            values, asked = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (values, asked))
            slices = Slices(values)
            for query, own in zip(asked, queries["id"].to_numpy(), strict=True):
                allowed = np.full(slices.words, ~np.uint64(0), "<u8")
                for i in range(np.searchsorted(ids, own), np.searchsorted(ids, own, "right")):
                    allowed[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
                at, score = slices.top(query, k, allowed)
                order = np.argsort(-score, kind="stable")[:k]  # rows are in order of their ids
                out.append((np.full(len(order), own), ids[at[order]], score[order]))
        columns = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out, strict=True) if out else ((), (), ()))]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, rows: int = ROWS, queries: int = QUERIES
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` best other rows for each query.

    ``vectors`` has ``vec_id`` and ``embedding``. Rows are dealt by a hash into blocks of about ``rows``, queries into
    blocks of about ``queries``; a row is sent once for each block of queries and a query once for each block of rows.
    """
    ship(vectors.sparkSession)
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    coded = usable.select(F.col("vec_id").cast("bigint").alias("id"), quantised(F.col("embedding"), scale).alias("x"), is_query.alias("q"))
    coded = written(coded.where(F.col("x").isNotNull()), "vectors")
    n, n_queries = coded.agg(F.count(F.lit(1)), F.count_if("q")).first()
    row_blocks, query_blocks = max(1, -(-n // rows)), max(1, -(-n_queries // queries))

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("id", "x"), F.lit(blocks)).cast("int")

    index = coded.select(
        dealt(row_blocks).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("c"), "id", "x", F.lit(False).alias("is_query")
    )
    asked = coded.where("q").groupBy("id").agg(F.min("x").alias("x")).select(
        F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("r"), dealt(query_blocks).alias("c"), "id", "x", F.lit(True).alias("is_query")
    )
    cells = index.unionByName(asked).groupBy("r", "c").applyInArrow(_cell(k), "query_id bigint, vec_id bigint, score bigint")
    # at most k rows from each cell
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
