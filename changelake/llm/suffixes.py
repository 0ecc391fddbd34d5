"""Repeated passages by a sparse suffix array.

Only suffixes at *minimisers* are kept: in every stretch of ``SPREAD`` positions, the one whose next ``GRAM`` words have
the least hash. A passage of ``length`` words that stands in two documents has such a position among its first
``SPREAD`` in both, with at least ``length - SPREAD + 1`` words of the passage behind it. The kept suffixes are sorted by
the hash of that many words, then by document; neighbours that agree and are of different documents are matches, and
their documents are read again to extend them: around each match, all windows of ``length`` words that may hold it, left
and right, are sorted and compared with their neighbours in the same way, with hashes of 128 bits. Windows found in
several documents are joined into spans. So a word is in a span exactly if ``length`` words around it stand, in a row, in
another document.

Both sorts are by range over hash, document and place, so a passage that any number of documents share is spread over as
many tasks as it fills; runs that cross a border are settled by two rows for each task. Documents that are copies of each
other take part once and are spans as a whole.

Words are runs without ``[\\x20\\x09-\\x0D]``, A to Z in lower case. Null and short texts have no spans. Rows with one id,
or without one, are one document; repeats inside a document don't count. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.near_dup import _HASHES, _mixed
from changelake.llm.storage import ship, written
from changelake.plans.joins import lookup

LENGTH, SPREAD, GRAM = 50, 21, 8
_NONE = -(1 << 63)
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=64)
def _power(factor: int, n: int) -> np.uint64:
    return np.uint64(pow(factor, n, 1 << 64))


def word_hashes(text: bytes | None) -> np.ndarray:
    words = (text or b"").lower().split()
    known = _HASHES
    return np.fromiter((known[word] for word in words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, n: int, factor: int) -> np.ndarray:
    """A hash of the ``n`` words from each position on, from those of 1, 2, 4, ... words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out, at, power, size = None, 0, words, 1
    while n >> at:
        if n >> at & 1:
            if out is None:
                out, done = power, size
            else:
                m = len(words) - done - size + 1
                out, done = out[:m] * _power(factor, size) + power[done : done + m], done + size
        at += 1
        if n >> at:
            m = len(power) - size
            power = power[:m] * _power(factor, size) + power[size : size + m]
            size *= 2
    return _mixed(out)


def minimisers(words: np.ndarray, spread: int, gram: int) -> np.ndarray:
    """Positions that have the least hash in some stretch, the first among equals."""
    hashes = gram_hashes(words, gram, _FACTORS[0])
    if len(hashes) <= spread:
        return np.unique(hashes.argmin(keepdims=True)) if len(hashes) else np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, spread)
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))


def _kept(length: int, spread: int, gram: int):
    ahead = length - spread + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                hashes, docs, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = word_hashes(text)
                    if len(words) < length:
                        continue
                    at = minimisers(words, spread, gram)
                    at = at[at <= len(words) - ahead]
                    hashes.append(gram_hashes(words, ahead, _FACTORS[1])[at])
                    docs.append(np.full(len(at), doc, np.int64))
                    places.append(at.astype(np.int32))
                columns = [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(places))]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "doc", "at"])

    return run


def _windows(length: int, spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All windows that hold a matched suffix near their beginning."""
        for batch in batches:
            for doc, text, places in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                words = word_hashes(text)
                last = len(words) - length
                if last < 0:
                    continue
                reach = np.zeros(last + 2, np.int32)  # +1 where a stretch of starts begins, -1 behind its end
                at = np.array(places, np.int64)
                at = at[at - spread + 1 <= last]
                np.add.at(reach, np.maximum(at - spread + 1, 0), 1)
                np.add.at(reach, np.minimum(at, last) + 1, -1)
                starts = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
                columns = [gram_hashes(words, length, f)[starts].view(np.int64) for f in _FACTORS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), pa.array(columns[1]), pa.array(np.full(len(starts), doc, np.int64)), pa.array(starts.astype(np.int32))],
                    names=["h", "g", "doc", "at"],
                )

    return run


_SORTED = "h bigint, g bigint, doc bigint, at int, kind int"
_MATCH, _PENDING, _BORDER = 0, 1, 2


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of a sorted partition of ``h``, ``g``, ``doc``, ``at``.

    Rows of runs with several documents are matches. The first and last run of the partition may go on in another one:
    their documents are told as border rows, and their rows wait if they are of one document.
    """

    def out(rows: np.ndarray, kind: int) -> pa.RecordBatch:
        columns = [pa.array(rows[:, i]) for i in range(3)] + [pa.array(rows[:, 3].astype(np.int32)), pa.array(np.full(len(rows), kind, np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["h", "g", "doc", "at", "kind"])

    held: list[np.ndarray] = []  # the last run so far, only its ends once it is known to match
    matches, first = False, True

    def close() -> Iterator[pa.RecordBatch]:
        """The held run ends here."""
        if not held:
            return
        rows = np.concatenate(held)
        if matches or rows[0, 2] != rows[-1, 2]:
            if not matches:
                yield out(rows, _MATCH)
            if first:
                yield out(rows[[0, -1]], _BORDER)
        elif first:
            yield out(rows, _PENDING)
            yield out(rows[[0, -1]], _BORDER)

    for batch in batches:
        rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
        if not len(rows):
            continue
        cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        begins = np.concatenate([[0], cuts])
        ends = np.concatenate([cuts, [len(rows)]])
        lo = 0
        if held and (held[-1][-1, :2] == rows[0, :2]).all():
            more = rows[: ends[0]]
            if matches:
                yield out(more, _MATCH)
                held = [held[0][:1], more[-1:]]
            else:
                held.append(more)
                whole = np.concatenate(held)
                if whole[0, 2] != whole[-1, 2]:
                    yield out(whole, _MATCH)
                    held, matches = [whole[:1], whole[-1:]], True
            lo = 1
            if len(ends) == 1:
                continue
        yield from close()
        first = first and not held
        if len(ends) - lo > 1:
            # all runs but the last end inside the batch
            b, e = begins[lo:-1], ends[lo:-1]
            several = rows[b, 2] != rows[e - 1, 2]
            if first:
                held, matches = [rows[b[0] : e[0]]], False
                yield from close()
                several[0] = False
            mask = np.repeat(several, e - b)
            yield out(rows[b[0] : e[-1]][mask], _MATCH)
            first = False
        held, matches = [rows[begins[-1] :]], False
        if held[0][0, 2] != held[0][-1, 2]:
            yield out(held[0], _MATCH)
            held, matches = [held[0][:1], held[0][-1:]], True
    if held:
        first = True  # the last run is a border as well
        yield from close()


def _matched(rows: DataFrame, name: str) -> DataFrame:
    """``doc`` and ``at`` of rows whose hash stands in several documents."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["h", "g", "doc", "at"]
    found = rows.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_compared, _SORTED)
    found = written(found, name)
    borders = found.where(F.col("kind") == _BORDER).groupBy(F.col("h").alias("bh"), F.col("g").alias("bg"))
    several = borders.agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("bh", "bg")
    pending = lookup(found.where(F.col("kind") == _PENDING), several, {"h": "bh", "g": "bg"}, "left_semi")
    return found.where(F.col("kind") == _MATCH).union(pending).select("doc", "at")


def _spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, begins, ends = [], [], []
            for doc, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = np.unique(np.array(places, np.int64))
                first = np.concatenate([[True], at[1:] > at[:-1] + length])
                last = np.concatenate([first[1:], [True]])
                docs += [doc] * int(first.sum())
                begins += at[first].tolist()
                ends += (at[last] + length).tolist()
            columns = [pa.array(x, pa.int64()) for x in (docs, begins, ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "start_word", "end_word"])

    return run


def _doc(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(_NONE)).cast("bigint")


def repeated_spans(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``start_word`` and ``end_word`` (behind the last) of passages that other documents have as well."""
    if not 0 < spread <= length - gram + 1:
        raise ValueError("a stretch and its grams must fit into a passage")
    ship(docs.sparkSession)
    rows = docs.select(_doc("doc_id").alias("doc"), F.col("text").cast("binary").alias("text"))
    # copies: equal texts under several ids
    texts = docs.select(_doc("doc_id").alias("doc"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    groups = texts.groupBy("t1", "t2").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    groups = written(groups.where("low < high"), "suffix-copies")

    kept = written(rows.mapInArrow(_kept(length, spread, gram), "h bigint, doc bigint, at int"), "suffixes")
    matched = _matched(kept.withColumn("g", F.lit(0).cast("bigint")), "suffix-matches")
    places = matched.groupBy(F.col("doc").alias("of")).agg(F.collect_list("at").alias("places"))
    keyed = docs.select(
        _doc("doc_id").alias("doc"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), F.col("text").cast("binary").alias("text")
    )
    found = keyed.join(places, F.col("doc") == F.col("of"))
    named = groups.withColumnsRenamed({"t1": "g1", "t2": "g2"})
    other = lookup(texts, named, {"t1": "g1", "t2": "g2"}, "inner").where(F.col("doc") != F.col("low"))
    other = other.select(F.col("doc").alias("o"), F.col("t1").alias("o1"), F.col("t2").alias("o2")).distinct()
    found = found.join(other, (F.col("doc") == F.col("o")) & (F.col("t1") == F.col("o1")) & (F.col("t2") == F.col("o2")), "left_anti")
    windows = found.select("doc", "text", "places").mapInArrow(_windows(length, spread), "h bigint, g bigint, doc bigint, at int")
    extended = _matched(written(windows, "suffix-windows"), "suffix-spans")
    # all windows of a copied text are repeated
    size = F.size(F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), "[\\x20\\x09-\\x0D]+"))
    sized = docs.select(_doc("doc_id").alias("doc"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), size.alias("n"))
    copies = lookup(sized, named, {"t1": "g1", "t2": "g2"}, "inner").where(F.col("n") >= length)
    whole = copies.select("doc", F.lit(0).cast("bigint").alias("start_word"), F.col("n").cast("bigint").alias("end_word")).distinct()
    starts = extended.groupBy("doc").agg(F.collect_list("at").alias("places"))
    spans = starts.mapInArrow(_spans(length), "doc bigint, start_word bigint, end_word bigint")
    inside = whole.select(F.col("doc").alias("w"), F.col("end_word").alias("w_end"))
    spans = spans.join(inside, (F.col("doc") == F.col("w")) & (F.col("end_word") <= F.col("w_end")), "left_anti").union(whole)
    return spans.select(F.nullif("doc", F.lit(_NONE)).alias("doc_id"), "start_word", "end_word")
