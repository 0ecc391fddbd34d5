"""Repeated passages against all windows of all documents."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from changelake.llm.queries import QUERIES
from changelake.llm.suffixes import gram_hashes, minimisers, repeated_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length):
    texts = [(doc, WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for doc, text in rows]
    holders = defaultdict(set)
    for doc, w in texts:
        for i in range(len(w) - length + 1):
            holders[tuple(w[i : i + length])].add(doc)
    covered = defaultdict(set)
    for doc, w in texts:
        for i in range(len(w) - length + 1):
            if len(holders[tuple(w[i : i + length])]) > 1:
                covered[doc] |= set(range(i, i + length))
    return {doc: words for doc, words in covered.items() if words}


def covered(rows):
    out = defaultdict(set)
    for r in rows:
        assert r.end_word > r.start_word
        out[r.doc_id] |= set(range(r.start_word, r.end_word))
    return dict(out)


def corpus(seed, length):
    rng = random.Random(seed)
    words = lambda n: [rng.choice("abcdefghij") + rng.choice("uvwxyz") for _ in range(n)]
    passages = [words(n) for n in (length - 1, length, length + 1, 2 * length, 5 * length)]
    rows = []
    for doc in range(120):
        text = words(rng.randrange(3 * length))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = p[rng.randrange(3) : len(p) - rng.randrange(3)]
            at = rng.randrange(len(text) + 1)
            text = text[:at] + cut + text[at:]
        rows.append((doc, " ".join(text)))
    common = " ".join(words(length + 7))  # in many documents, again and again
    rows += [(1000 + i, f"{' '.join(words(5))} {common} {' '.join(words(i % 4))} {common}") for i in range(300)]
    rows += [(2000 + i, rows[i % 7][1].upper()) for i in range(20)] + [(3000 + i, rows[3][1]) for i in range(20)]
    rows += [(None, None), (5000, ""), (5001, "few words"), (None, rows[5][1]), (0, rows[0][1]), (0, rows[1][1]), (6000, "same " * 9000), (6001, "same " * 200)]
    return rows


def test_hashes():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 5, 400).astype(np.uint64)
    for n in (1, 2, 3, 8, 30, 50):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        hashes = gram_hashes(words, n, 0x9E3779B97F4A7C15)
        assert len(hashes) == len(grams) and len(set(hashes.tolist())) == len(set(grams)) == len(set(zip(hashes.tolist(), grams, strict=True)))
    at = minimisers(rng.integers(0, 1 << 60, 1000).astype(np.uint64), 21, 8)
    assert np.diff(at).max() <= 21 and at[0] < 21


@pytest.mark.parametrize(("seed", "length", "spread", "gram"), [(1, 50, 21, 8), (2, 12, 5, 4)])
def test_spans_are_those_of_all_windows(spark, seed, length, spread, gram):
    rows = corpus(seed, length)
    docs = spark.createDataFrame([(d, t, "h", 1) for d, t in rows], "doc_id bigint, text string, h string, at int").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)  # runs cross batches
    try:
        assert covered(repeated_spans(docs, length, spread, gram).collect()) == brute(rows, length)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_rows(spark):
    assert repeated_spans(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(docs, 50)
    assert covered(QUERIES["op3_suffix_dedup"](spark, sf).collect()) == want and want
