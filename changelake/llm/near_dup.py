"""MinHash near-dedup with odd sketches.

A document is the set of its word shingles. Rows with equal sets are one *node*. Each node has MinHash samples, cut
into bands; nodes that agree in a whole band share a *bucket*. The samples are also folded into a parity bitmap, the odd
sketch: bits that differ between two sketches count the samples that differ, and tell high similarities precisely. A
candidate whose estimate is more than six deviations below the threshold is dropped, all others are confirmed on their
full sets.

Only components are wanted, so pairs inside one needn't be seen:

1. In each bucket, all nodes are candidates of its least node. Every node's best one is confirmed first, then those that
   would still join two components.
2. Buckets with nodes of several components are compared in blocks, sketch against sketch. Nodes that have a close one
   there are compared again with their full sets at hand; as a link makes two components one, a cell gives fewer links
   than it has rows.

No bucket is cut or skipped: large ones are dealt into blocks that meet in a grid. With 32 bands of 4 samples a pair at
the threshold of 0.8 is overlooked with a probability of 5e-8.

Null texts and texts without words have an empty set and are linked with nothing. Null ids count as larger than all
others; a component of null ids only has a null one. Repeated rows belong together. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changelake.llm.components import components
from changelake.llm.storage import Scratch, ship
from changelake.plans.joins import lookup

BANDS, ROWS, BITS = 32, 4, 1024
BLOCK = 4096
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text; one for all words where there are fewer than ``size``."""
    words = (text or b"").lower().split()  # of bytes: A-Z and the six separators only
    if not words:
        return np.zeros(0, np.uint64)
    known = _HASHES
    hashes = np.fromiter((known[word] for word in words), np.uint64, len(words))
    n = max(1, len(hashes) - size + 1)
    out, factor = np.zeros(n, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for i in range(min(size, len(hashes))):
        out = out * factor + hashes[i : i + n]
    return np.unique(_mixed(out))


@lru_cache(maxsize=4)
def _factors(k: int) -> np.ndarray:
    return np.random.default_rng(20_240_229).integers(0, 1 << 63, k, np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(items: np.ndarray, k: int) -> np.ndarray:
    """``k`` samples of a set: the least product with each of ``k`` odd factors."""
    factors, out = _factors(k)[:, None], np.full(k, ~np.uint64(0))
    for lo in range(0, len(items), 1024):
        np.minimum(out, (factors * items[None, lo : lo + 1024]).min(axis=1), out=out)
    return out


def odd_sketch(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The parity bitmap of numbered samples, as 64-bit words."""
    at = _mixed(samples + np.arange(1, len(samples) + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) % np.uint64(bits)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").view("<u8")


def most_differing(threshold: float, k: int, bits: int = BITS, deviations: float = 6.0) -> int:
    """Differing bits at which the estimate, ``1 + bits / 4k * ln(1 - 2 z / bits)``, is surely below the threshold."""
    low = max(0.0, threshold - deviations * math.sqrt(threshold * (1 - threshold) / k) - 2 / k)
    return math.ceil((1 - math.exp((low - 1) * 4 * k / bits)) * bits / 2)


def _features(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                nodes, sizes, keys, sketches = [], [], [], []
                for text in part.column(2).to_pylist():
                    items = shingle_set(text, size)
                    sizes.append(len(items))
                    if not len(items):
                        nodes.append(None)
                        keys.append(None)
                        sketches.append(None)
                        continue
                    samples = min_hashes(items, bands * rows)
                    band = salt.copy()
                    for column in samples.reshape(bands, rows).T:
                        band = _mixed(band + column)
                    nodes.append(xxhash.xxh3_128_digest(items.tobytes()))
                    keys.append(band.view(np.int64))
                    sketches.append(odd_sketch(samples).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "node", "n_shingles", "keys", "sketch"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                sets = [shingle_set(text, size).tobytes() for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "items"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose full sets are similar enough."""
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(_similar(np.frombuffer(left.as_buffer(), "<u8"), np.frombuffer(right.as_buffer(), "<u8"), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


class _Cell:
    """The rows of a bucket or of two of its blocks, and for each row those it may be linked with in this band."""

    def __init__(self, key: tuple, table: pa.Table, most: int, percent: int) -> None:
        self.nodes, self.sides = table.column("node").to_pylist(), np.array(table.column("side").to_pylist(), np.int64)
        self.root = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)[1]
        self.sizes = np.array(table.column("n_shingles").to_pylist(), np.int64)
        words, self.bands = (np.stack([x.values.to_numpy() for x in table.column(name)]) for name in ("sketch", "keys"))
        self.words, self.band, self.most, self.percent = words.view(np.uint64), key[0].as_py(), most, percent
        self.first, self.second = np.flatnonzero(self.sides != 1), np.flatnonzero(self.sides != 0)

    def close(self, i: int) -> np.ndarray:
        """Rows of other components whose sketches are close to that of row ``i``, each pair in the first band it shares."""
        js, sizes, bands = self.second, self.sizes, self.bands
        js = js[(self.root[js] != self.root[i]) & ((self.sides[js] == 1) | (js > i))]
        js = js[100 * np.minimum(sizes[js], sizes[i]) >= self.percent * np.maximum(sizes[js], sizes[i])]
        js = js[np.bitwise_count(self.words[js] ^ self.words[i]).sum(axis=1) < self.most]
        return js[bands[i][(bands[js] == bands[i]).argmax(axis=1)] == self.band]


def _suspects(most: int, percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """The rows that have a close one: no more than there are."""
        cell = _Cell(key, table.combine_chunks(), most, percent)
        found = np.zeros(len(cell.nodes), bool)
        for i in cell.first:
            js = cell.close(i)
            found[js] = True
            found[i] |= len(js) > 0
        at = np.flatnonzero(found)
        return pa.table({"key": pa.array([cell.band] * len(at), pa.int64()), "node": pa.array([cell.nodes[i] for i in at], pa.binary())})

    return run


def _cells(most: int, percent: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Links that join components: close rows compared on their full sets.

        A link makes its components one, so there are fewer links than rows.
        """
        table = table.combine_chunks()
        cell = _Cell(key, table, most, percent)
        nodes, root = cell.nodes, cell.root
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table.column("items")]
        left, right = [], []
        for i in cell.first:
            for j in cell.close(i):
                if root[j] != root[i] and _similar(sets[i], sets[j], percent):
                    root[root == root[j]] = root[i]
                    left.append(nodes[i])
                    right.append(nodes[j])
        return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary())})

    return run


def _in_blocks(members: DataFrame, block: int, run, schema: str) -> DataFrame:
    """What ``run`` makes of the rows of each ``key``, in cells of two blocks at most."""
    counts = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = lookup(members, counts, {"key": "key"}, "inner")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # a cell is a pair of blocks; on its diagonal a block meets itself
    side = F.when(F.col("own") < F.col("other"), 0).when(F.col("own") > F.col("other"), 1).otherwise(2)
    cell = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), *[c for c in members.columns if c != "key"])
    return cell.groupBy("key", "i", "j").applyInArrow(run, schema)


def _with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    for end in ("a", "b"):
        named = roots.select(F.col("node").alias("__n"), F.col("root").alias(f"root_{end}"))
        pairs = lookup(pairs, named, {end: "__n"})
        pairs = pairs.withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return pairs.where(F.col("root_a") != F.col("root_b")).select("a", "b")


def clusters(
    docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """A row for each document: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``first``.

    ``component_id`` is the least document id of those linked, directly or through others, by a similarity of at least
    ``percent`` of a hundred. ``first`` marks the rows of the least id and hash in the component.
    """
    ship(docs.sparkSession)
    tables = Scratch(docs.sparkSession, "near-dup")
    k = bands * rows
    most = most_differing(percent / 100, k)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, node binary, n_shingles bigint, keys array<bigint>, sketch array<bigint>"
    source = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    features = tables.written(source.mapInArrow(_features(shingle, bands, rows), schema), "features")
    ids = tables.written(features.select("doc_id", "text_hash", "node", "n_shingles"), "ids")
    filled = features.where(F.col("node").isNotNull())
    nodes = filled.groupBy("node").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"),
        F.first("sketch").alias("sketch"),
    )
    nodes = tables.written(nodes, "nodes")
    tables.drop("features")

    # buckets of several nodes
    banded = nodes.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy(F.col("key").alias("__key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__key")
    members = tables.written(lookup(banded, shared, {"key": "__key"}, "left_semi"), "buckets")
    centers = members.groupBy(F.col("key").alias("__key")).agg(F.min("node").alias("center"))
    stars = lookup(members, centers, {"key": "__key"}, "inner").where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    sketches = nodes.select("node", "n_shingles", "sketch")

    def named(end: str) -> DataFrame:
        return sketches.select(F.col("node").alias("__n"), F.col("n_shingles").alias(f"n_{end}"), F.col("sketch").alias(f"s_{end}"))

    stars = lookup(lookup(stars, named("a"), {"a": "__n"}, "inner"), named("b"), {"b": "__n"}, "inner")
    differing = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    stars = stars.where(near).select("a", "b", differing.alias("z")).where(F.col("z") < most)
    stars = tables.written(stars, "stars")

    # full sets of the nodes that are in such a bucket, from one document of each
    wanted = lookup(nodes.select("node", "row.*"), members.select(F.col("node").alias("__n")).distinct(), {"node": "__n"}, "left_semi")
    texts = source.withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    wanted = wanted.select("node", F.col("text_hash").alias("__hash"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__doc"))
    found = texts.join(wanted, (F.col("text_hash") == F.col("__hash")) & (F.col("__id") == F.col("__doc")))
    found = found.groupBy("text_hash", "__id").agg(F.first("node").alias("node"), F.first("text").alias("text")).select("node", "text")
    sets = tables.written(found.mapInArrow(_sets(shingle), "node binary, items binary"), "sets", "uncompressed")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        for end in ("a", "b"):
            items = sets.select(F.col("node").alias("__n"), F.col("items").alias(f"items_{end}"))
            pairs = lookup(pairs, items, {end: "__n"}, "inner")
        checked = pairs.select("a", "b", "items_a", "items_b").mapInArrow(_confirmed(percent), "a binary, b binary")
        return tables.written(checked, name)

    best = stars.groupBy("a").agg(F.min_by("b", F.struct("z", "b")).alias("b"))
    links = confirmed(best, "best")
    roots = components(links)
    links = links.union(confirmed(_with_roots(stars.select("a", "b"), roots), "rest"))
    roots = components(links)
    tables.drop("stars")

    # buckets that hold several components
    rooted = lookup(members.select("key", "node"), roots.select(F.col("node").alias("__n"), "root"), {"node": "__n"})
    rooted = tables.written(rooted.select("key", "node", F.coalesce("root", "node").alias("root")), "rooted")
    tables.drop("buckets")
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    open_rows = lookup(rooted, several.select(F.col("key").alias("__key")), {"key": "__key"}, "left_semi")
    described = nodes.select(F.col("node").alias("__n"), "n_shingles", "sketch", "keys")
    # sketches alone tell which rows of a bucket have others close to them; full sets move for these only
    sketched = lookup(open_rows, described, {"node": "__n"}, "inner")
    close = _in_blocks(sketched, block, _suspects(most, percent), "key bigint, node binary").distinct()
    close = tables.written(close, "close").withColumnsRenamed({"key": "__key", "node": "__n"})
    narrow = lookup(lookup(rooted, close, {"key": "__key", "node": "__n"}, "left_semi"), described, {"node": "__n"}, "inner")
    full = lookup(narrow, sets.select(F.col("node").alias("__n"), "items"), {"node": "__n"}, "inner")
    links = links.union(tables.written(_in_blocks(full, block, _cells(most, percent), "a binary, b binary"), "last"))
    tables.drop("sets", "nodes", "rooted", "close")
    roots = components(links)

    rooted = lookup(ids, roots.select(F.col("node").alias("__n"), "root"), {"node": "__n"})
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    lows = rooted.where(F.col("root").isNotNull()).groupBy(F.col("root").alias("__r")).agg(F.min(least).alias("low"))
    out = lookup(rooted, lows, {"root": "__r"})
    low: Column = F.when(F.col("root").isNull(), least).otherwise(F.col("low"))
    return out.select("doc_id", "text_hash", "n_shingles", low["doc_id"].alias("component_id"), least.eqNullSafe(low).alias("first"))


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """All columns of one document of each group; documents without words stay.

    Rows that stay as they are, the most, aren't moved: only ids and hashes of rows that go, and of rows that are there
    more than once, meet the documents.
    """
    rows = clusters(docs, **settings).where(F.col("n_shingles") > 0).groupBy("doc_id", "text_hash")
    rows = rows.agg(F.first("first").alias("__first"), F.count(F.lit(1)).alias("n")).where("NOT __first OR n > 1")
    marked = Scratch(docs.sparkSession, "near-marked").written(
        rows.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "__first"), "rows")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__row") == F.col("__hash"))
    joined = docs.withColumn("__row", F.xxhash64("text")).join(marked, same, "left")
    repeated = docs.withColumn("__row", F.xxhash64("text")).join(marked.where("__first"), same)
    once = repeated.withColumn("__nth", F.row_number().over(W.partitionBy("doc_id", "__row").orderBy(F.lit(0)))).where("__nth = 1")
    return joined.where(F.col("__first").isNull()).select(*docs.columns).unionByName(once.select(*docs.columns))
