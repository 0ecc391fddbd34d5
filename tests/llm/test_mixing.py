"""Mixing: targets, rounding and expectations."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from changelake.llm.mixing import mixed, mixture, per_row, source_targets
from changelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Excess dealt again by weight until no source is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full, target = share * sum(sizes.values()), set(), {}
    while True:
        rest = [s for s in names if s not in full]
        total = sum(weight[s] for s in rest)
        target |= {s: left * weight[s] / total for s in rest}
        above = [s for s in rest if target[s] > most * sizes[s]]
        if not above:
            return target
        for s in above:
            target[s] = most * sizes[s]
            full.add(s)
            left -= target[s]


def check(rows, docs):
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(WORD.findall(text or ""))
        largest[source] = max(largest[source], len(WORD.findall(text or "")))
    want, taken = brute_targets(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r.size
        assert r.size == 0 or r.taken % r.size == 0
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source]
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((d, s, len(WORD.findall(t or ""))) for d, s, t in docs)


ODD = [
    (1, "b", "one two three"), (2, "a", ""), (3, None, "w " * 50), (4, "", "x\ty\x0bz"), (5, "é", "u " * 40), (5, "é", "u " * 40),
    (None, "b", "four five"), (None, "b", "four five"), (6, "a", None), (7, "z", "lone"), (8, "Z", "lone two"),
    *[(100 + i, "b", "w " * (i % 17)) for i in range(700)], *[(9, "hot", "same words here")] * 300,
]


@pytest.mark.parametrize("chunk", [4, 256])
def test_odd_rows(spark, chunk):
    docs = spark.createDataFrame([(d, s, t, 1.0) for d, s, t in ODD], "doc_id bigint, source string, text string, p double")
    mix = mixed(docs.repartition(5), chunk=chunk)
    rows = per_row(mix).collect()
    check(rows, ODD)
    again = per_row(mixed(docs.repartition(2), chunk=chunk)).collect()
    assert Counter(rows) == Counter(again)


def test_copies_of_the_mixture(spark):
    docs = spark.createDataFrame([(d, s, t, i) for i, (d, s, t) in enumerate(ODD)], "doc_id bigint, source string, text string, size int")
    out = mixture(docs.repartition(3))
    assert out.columns == docs.columns
    rows = Counter((r.doc_id, r.source, r.text) for r in out.collect())
    want = Counter()
    for r in per_row(mixed(docs)).collect():
        want[(r.doc_id, r.source, r.size)] += r.copies
    assert Counter({k: v for k, v in want.items() if v}) == sum(
        (Counter({(d, s, len(WORD.findall(t or ""))): n}) for (d, s, t), n in rows.items()), Counter())


def test_expected_copies(spark):
    """Over seeds and documents of like size the copies have their expectation, for short and long ones alike."""
    docs = spark.createDataFrame([(i, s, "w " * (1 + i * i % 23)) for i in range(30) for s in "ab"], "doc_id bigint, source string, text string")
    total, p, seeds = Counter(), {}, 12
    for seed in range(seeds):
        for r in per_row(mixed(docs, seed=100 * seed, chunk=8)).collect():
            total[(r.source, r.doc_id)] += r.copies
            p[(r.source, r.doc_id)] = r.target / r.source_size
    for source in "ab":
        for half in (range(15), range(15, 30)):
            n, mean = sum(total[(source, i)] for i in half), p[(source, 0)]
            assert abs(n / seeds / 15 - mean) <= 4.5 * (0.25 / seeds / 15) ** 0.5


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, "d": 0}, {"a": 1}, {"a": 0, None: 0}, {chr(65 + i): (i * 37) % 101 for i in range(40)}):
        rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size bigint"), (3, 1, 2), 1.5, 2.0).collect()
        assert {r.source: r.target for r in rows} == pytest.approx(brute_targets(sizes))


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    check(QUERIES["op10_mixing"](spark, SF).collect(), [tuple(r) for r in docs.collect()])


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert per_row(mixed(docs)).collect() == [] and mixture(docs).select(F.count("*")).first()[0] == 0
