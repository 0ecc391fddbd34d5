"""Importance resampling against plain Python: words by a regular expression, counts in dictionaries, one sort."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changelake.llm import importance
from changelake.llm.importance import resampled, windows, words_of
from changelake.llm.queries import QUERIES

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plainly(docs, target, percent=10, min_words=20, sizes=(1, 1), n_buckets=10_000, seed=2024):
    """Rows of id, words, features, weight, score and rank."""

    def features(text):
        words = plain_words(text)
        runs = (words[i : i + k] for k in range(sizes[0], sizes[1] + 1) for i in range(len(words) - k + 1))
        return [zlib.crc32(" ".join(run).encode()) % n_buckets for run in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    n_s, n_t = s.total() + n_buckets, t.total() + n_buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in range(n_buckets)]
    rows = []
    for doc, text in docs:
        own = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(plain_words(text)), len(own), weight, score, None])
    drawn = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(drawn[: percent * len(drawn) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=repr)


def found(rows):
    names = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    return sorted((tuple(r[n] for n in names) for r in rows.collect()), key=repr)


ALPHABET = st.sampled_from("aB9 \n\t.-_'éÉß日🎉\x7f\x80\x00İ")


@given(st.text(ALPHABET, max_size=60), st.integers(1, 4))
@settings(max_examples=400, deadline=None)
def test_windows(text, size):
    text = text.encode().lower().decode()
    words = words_of(text)
    assert [w for w, _ in words] == plain_words(text)
    assert all(text[a:b] == w for w, (a, b) in words)
    plain = [w for w, _ in words]
    assert windows(text, words, size) == [" ".join(plain[i : i + size]) for i in range(len(plain) - size + 1)]


@given(st.text(ALPHABET, max_size=60), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_spans_cut_no_word(text, span):
    text = text.encode().lower().decode()
    parts = list(importance._spans(text, span))
    assert "".join(parts) == text
    assert [w for part in parts for w, _ in words_of(part)] == plain_words(text)


TEXTS = [
    "", None, " . ", "Some plain words, again some WORDS " * 5, "É é İ ß 日本語 " * 8, "a" * 100_000, "one\ttwo  three\n" * 9000,
    "x-y_z 9'9 " * 20, "only nineteen " * 9 + "x", "target words here " * 10,
]


def tables(spark, rows, target):
    docs = spark.createDataFrame([(d, t, 1, "w") for d, t in rows], "doc_id bigint, text string, rank int, weight string")
    return docs.repartition(4), spark.createDataFrame([(t, 5) for t in target], "text string, doc_id int")


@pytest.mark.parametrize("sizes", [(1, 1), (1, 2), (2, 3)])
def test_odd_rows(spark, sizes):
    rows = [(i - 4, t) for i, t in enumerate(TEXTS * 4)] + [(None, "no id " * 30), (None, None), (7, "twice " * 25), (7, "twice " * 25)]
    target = ["target words here", None, "", "some target"]
    for percent in (0, 30, 100):
        got = resampled(*tables(spark, rows, target), percent=percent, sizes=sizes, n_buckets=500)
        assert found(got) == plainly(rows, target, percent, sizes=sizes, n_buckets=500)


def test_no_rows(spark):
    docs, target = tables(spark, [(1, "a b " * 20), (2, None)], ["a"])
    assert resampled(docs.limit(0), target).collect() == []
    assert found(resampled(docs, target.limit(0), percent=50)) == plainly([(1, "a b " * 20), (2, None)], [], 50)


def test_wide_buckets_and_forgetting(spark, monkeypatch):
    monkeypatch.setattr(importance, "REMEMBERED", 3)
    rows = [(i, f"word{i % 9} other{i} third " * 8) for i in range(60)]
    docs, target = tables(spark, rows, ["word3 third"])
    assert found(resampled(docs, target, n_buckets=70_000, min_words=3)) == plainly(rows, ["word3 third"], n_buckets=70_000, min_words=3)


def test_query_reads_the_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = QUERIES["op11_resampling"](spark, sf).collect()
    want = [(d, n, w, s, k) for d, _, n, w, s, k in plainly(docs, target)]
    assert sorted((tuple(r[n] for n in ("doc_id", "n_features", "weight", "score", "rank")) for r in rows), key=repr) == sorted(want, key=repr)
