"""Cuckoo filters by themselves, and the index against plain Python through inserts, removals and overflow."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from changelake.llm import cuckoo
from changelake.llm.cuckoo import CuckooFilter, DedupIndex, Full, copies, without_copies
from changelake.llm.queries import QUERIES
from changelake.llm.storage import shared_folder


def digests(n, seed=1):
    return np.random.default_rng(seed).integers(0, 1 << 63, (n, 4), np.uint64)


def key(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


def plainly(rows):
    """id and key → (id that stays, size of the group) for rows of id and text."""
    groups: dict = {}
    for doc, text in rows:
        groups.setdefault(key(text), []).append(doc)
    none = float("inf")
    out = []
    for k, ids in groups.items():
        least = min(ids, key=lambda i: none if i is None else i)
        out += [(i, k, least, len(ids)) for i in ids]
    return sorted(out, key=repr)


def found(rows):
    return sorted([(r.doc_id, r.key.hex(), r.keep_id, r.group_size) for r in rows.collect()], key=repr)


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 30_000])
def test_filter_holds_what_was_put_in(n):
    filter, items = CuckooFilter.sized(n), digests(n)
    filter.insert(items[: n // 2])
    filter.insert(items[n // 2 :])
    assert filter.contains(items).all() and (filter.slots != 0).sum() == n
    again = CuckooFilter(filter.buckets, filter.tobytes())
    assert again.contains(items).all()
    assert again.contains(digests(20_000, 2)).mean() < 0.001
    again.remove(items[::2])
    assert again.contains(items[1::2]).all() and (again.slots != 0).sum() == n // 2
    assert again.contains(items[::2]).mean() < 0.02 if n >= 1000 else True
    free = again.slots == 0
    assert (np.diff(free.astype(int), axis=1) >= 0).all()  # free slots come last
    again.insert(items[::2])
    assert again.contains(items).all()


def test_filter_overflows():
    filter = CuckooFilter(4)
    with pytest.raises(Full):
        filter.insert(digests(17))
    same = np.repeat(digests(1), 9, axis=0)
    with pytest.raises(Full):
        CuckooFilter(64).insert(same)


def test_zero_fingerprints():
    items = digests(100)
    items[:, 0] &= ~np.uint64(0xFFFF)
    filter = CuckooFilter(256)
    filter.insert(items)
    assert filter.contains(items).all()


ROWS = [
    (5, "a b"), (3, "a  b"), (9, "a\t\n b"), (4, " a b"), (1, None), (2, ""), (None, "a b"), (None, "x"), (None, "x"), (7, "A b"),
    (8, "\x0b"), (6, " "), (10, "\xa0"), (11, "long word " * 20_000), (12, "long\nword " * 20_000), (13, "x y"),
]


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "k", 1, True) for d, t in rows], "doc_id bigint, text string, key string, row int, first boolean")


def test_odd_rows(spark):
    rows = copies(docs_of(spark, ROWS * 2).repartition(5))
    assert found(rows) == plainly(ROWS * 2)
    firsts = [r for r in rows.collect() if r.first]
    assert len(firsts) == len({r.key for r in firsts}) == len({key(t) for _, t in ROWS})
    kept = without_copies(docs_of(spark, ROWS * 2))
    assert kept.columns == ["doc_id", "text", "key", "row", "first"]
    assert sorted(key(r.text) for r in kept.collect()) == sorted({key(t) for _, t in ROWS})


def test_no_rows(spark):
    none = docs_of(spark, ROWS).limit(0)
    assert copies(none).collect() == [] and without_copies(none).collect() == []


def live_keys_are_in_the_filters(index):
    stored: dict = {}
    for r in index.keys().collect():
        stored.setdefault(r.shard, []).append(np.frombuffer(bytes(r.key), "<u8"))
    filters = {r.shard: r for r in index.filters().collect()}
    for shard, keys in stored.items():
        row = filters[shard]
        filter = CuckooFilter(row.buckets, row.slots)
        assert filter.contains(np.stack(keys)).all() and (filter.slots != 0).sum() == row.n_keys == len(keys)


def test_inserts_and_removals(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "RUNS", 2)
    rng = np.random.default_rng(7)
    index, inside = DedupIndex(spark, shared_folder(spark, "index"), shards=2), []
    for step in range(6):
        if step in (2, 4):
            gone = {d for d, _ in inside if d % 3 == step % 3} | {99_999}
            index.remove(spark.createDataFrame([(d,) for d in gone], "doc_id int"))
            inside = [(d, t) for d, t in inside if d not in gone]
        else:
            new = [(int(i) + 1000 * step, f"text {rng.integers(150)}" + "  " * (i % 2)) for i in range(200)]
            index.insert(docs_of(spark, new))
            inside += new
        assert found(index.verdicts()) == plainly(inside)
        live_keys_are_in_the_filters(index)
        index = DedupIndex(spark, index.folder)  # opened again
    firsts = [r for r in index.verdicts().collect() if r.first]
    assert sorted(r.doc_id for r in firsts) == sorted({keep for _, _, keep, _ in plainly(inside)})
    index.remove(spark.createDataFrame([(d,) for d, _ in inside], "doc_id bigint"))
    assert index.verdicts().collect() == [] and index.keys().collect() == []


def test_overflow_and_more_shards(spark, monkeypatch):
    index, inside = DedupIndex(spark, shared_folder(spark, "index"), shards=1), []
    sizes = []
    for step, n in enumerate((10, 300, 700)):
        new = [(i + 10_000 * step, f"{step} {i // 2}") for i in range(n)]
        index.insert(docs_of(spark, new))
        inside += new
        live_keys_are_in_the_filters(index)
        sizes.append(max(r.buckets for r in index.filters().collect()))
    assert sizes[0] < sizes[1] < sizes[2] and index.shards == 1
    monkeypatch.setattr(cuckoo, "SHARD_KEYS", 100)
    index.insert(docs_of(spark, [(77_777, "0 1"), (77_778, "new")]))
    inside += [(77_777, "0 1"), (77_778, "new")]
    assert index.shards > 4
    live_keys_are_in_the_filters(index)
    index.insert(docs_of(spark, [(5, "new")]))
    assert found(index.verdicts()) == plainly([*inside, (5, "new")])


def test_failed_change_leaves_the_index(spark):
    index = DedupIndex(spark, shared_folder(spark, "index"), shards=2)
    index.insert(docs_of(spark, ROWS[:3]))
    bad = docs_of(spark, ROWS).selectExpr("doc_id", "raise_error('lost') AS text")
    with pytest.raises(Exception, match="lost"):
        index.insert(bad)
    again = DedupIndex(spark, index.folder)
    assert found(again.verdicts()) == plainly(ROWS[:3])
    again.insert(docs_of(spark, ROWS[3:]))
    assert found(again.verdicts()) == plainly(ROWS)


def test_query_reads_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = QUERIES["op12_exact_dedup"](spark, "/root/testdata/sf0.001").collect()
    got = sorted([(r.doc_id, r.text_sha256, r.keep_id, r.group_size) for r in rows], key=repr)
    assert got == plainly([(r.doc_id, r.text) for r in docs])
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
