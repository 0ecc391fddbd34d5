"""Near-dedup against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from changelake.llm.components import components
from changelake.llm.near_dup import clusters, min_hashes, most_differing, odd_sketch, one_of_each
from changelake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent=80):
    """``(doc_id, n_shingles, component_id)`` of rows of (doc_id, text), from all pairs that share a shingle."""
    sets = [shingles(text, k) for _, text in rows]
    holders: dict = {}
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, own in enumerate(sets):
        shared: dict = {}
        for s in own:
            for j in holders.setdefault(s, []):
                shared[j] = shared.get(j, 0) + 1
            holders[s].append(i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    low: dict = {}
    for i, (doc, _) in enumerate(rows):
        key = (doc is None, doc or 0)
        low[find(i)] = min(low.get(find(i), (True, 1 << 62)), key)
    return sorted(((doc, len(sets[i]), None if low[find(i)][0] else low[find(i)][1]) for i, (doc, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioubcdfg") for _ in range(4))
    rows = []
    for _ in range(n):
        base = [word() for _ in range(rng.choice([3, 12, 60, 200]))]
        rows += [edited(rng, base, s) for s in (0, 0, 0.01, 0.03, 0.05, 0.08, 0.1)]
    common = " ".join(word() for _ in range(60))  # half of many documents
    rows += [f"{common} " + " ".join(word() for _ in range(60)) for _ in range(150)]
    rows += [f"{common} " + " ".join(word() for _ in range(4)) for _ in range(40)]
    rng.shuffle(rows)
    return [(i * 7 - 50, t) for i, t in enumerate(rows)]


ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\x0bTwo "), (8, "É a b c"), (9, "é a b c"),
    (None, "alone here now"), (None, "alone here now"), (None, "w x y z"), (10, "w x y z"), (10, "w x y z"), (10, "other text"), (11, "w x y z"),
    (12, "long " * 30_000), (13, "long " * 29_000), (0, " ".join(map(str, range(20_000)))), (-1, " ".join(map(str, range(19_000)))),
]


@pytest.mark.parametrize(("seed", "shingle", "block"), [(1, 2, 1024), (2, 5, 16)])
def test_components_are_those_of_all_pairs(spark, seed, shingle, block):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id bigint, text string, node string").repartition(4)
    assert result(clusters(docs, shingle=shingle, block=block)) == brute(rows, shingle)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t in ODD], "doc_id bigint, text string, key string").repartition(3)
    assert result(clusters(docs, shingle=2)) == brute(ODD, 2)
    kept = one_of_each(docs, shingle=2)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:8]) for r in kept.collect())
    assert ids == sorted([(False, 1, ""), (False, 2, ""), (False, 3, " \n\t"), (False, 4, "one"), (False, 6, "one two"), (False, 8, "É a b c"),
        (False, 9, "é a b c"), (True, 0, "alone he"), (False, 10, "w x y z"), (False, 10, "other te"), (False, 11, "w x y z"),
        (False, 12, "long lon"), (False, -1, "0 1 2 3 ")])


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert clusters(docs).collect() == [] and one_of_each(docs).collect() == []


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(25)] + [(200, 200 + i) for i in range(1, 50)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(parent[a], parent[b])
            changed |= (parent[a], parent[b]) != (low, low)
            parent[a] = parent[b] = low
    assert roots == {k: v for k, v in parent.items() if any(k in link and link[0] != link[1] for link in links)}


def test_sketches_estimate_similarity():
    rng, errors = np.random.default_rng(1), []
    limit = most_differing(0.8, 128)
    for _ in range(200):
        items = rng.integers(0, 1 << 63, 1125, np.uint64)
        a, b = min_hashes(items[:1000], 128), min_hashes(items[111:1111], 128)  # 889 of 1111 shared
        z = int(np.bitwise_count(odd_sketch(a) ^ odd_sketch(b)).sum())
        assert z < limit
        errors.append(1 + 1024 / 512 * np.log(1 - 2 * z / 1024) - 889 / 1111)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op4_near_dup"](spark, sf).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == brute(docs, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and any(not r.kept for r in rows)
