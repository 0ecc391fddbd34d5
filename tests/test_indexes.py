"""Search by postings against a scan, and tables of name patterns against ``fnmatch``."""

from __future__ import annotations

import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as S

from changelake.functions.patterns import glob_columns, glob_regex
from changelake.operators.indexes import match_patterns, search_postings, text_postings, write_postings
from changelake.operators.query import search_condition

RECORDS = [
    (1, "Alpha-Beta", "ALPHABET"), (2, "beta", None), (3, None, None), (4, "", "x"), (5, "ab", "Ünïcode ÄÖ"), (6, "aab", "baa"), (7, "bet", "alp"),
    (8, "a" * 5000 + "beta", "tail"), (9, "日本語 テキスト", "🎉🎉x"), (None, "beta", "no id"), (9, "repeated id", "beta"), (10, "al", "pha"),
]


@pytest.mark.parametrize("needle", ["beta", "BETA", "alp", "a", "AB", "äö", "本語", "🎉x", "nothing", "", "alpha-beta", "aaaab", "%", "_"])
def test_search_by_postings(spark, tmp_path, needle):
    df = spark.createDataFrame(RECORDS, "id int, name string, note string")
    write_postings(text_postings(df), str(tmp_path / "p"), 3)
    postings = spark.read.parquet(str(tmp_path / "p"))
    want = df.where("id IS NOT NULL").where(search_condition(df, needle)) if needle else df.where(search_condition(df, needle))
    assert sorted(map(repr, search_postings(df, postings, needle).collect())) == sorted(map(repr, want.collect()))


def test_postings_of_some_columns_and_their_scan(spark, tmp_path):
    df = spark.createDataFrame(RECORDS, "id int, name string, note string")
    postings = text_postings(df, ["note"])
    write_postings(postings, str(tmp_path / "p"), 2)
    postings = spark.read.parquet(str(tmp_path / "p"))
    found = search_postings(df, postings, "baa", ["note"])
    assert [r["id"] for r in found.collect()] == [6]
    plan = search_postings(df, postings, "beta")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(gram, [bet,eta])" in plan  # only the needle's own grams are read
    assert text_postings(df.limit(0)).collect() == [] and text_postings(df.select("id")).collect() == []


def globs(rng, n):
    parts = ["a", "b", "-", "x1", ".", "*", "?", "[ab]", "[!a]", "[a-c]", "[]x]", "[!]]", "[", "]", "[-a]", "[a-]", "(", "+", "é", "\\", "^", "[^a]", "rel-", "&&", "[&a]", "$", "{"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 5))) for _ in range(n)]


def test_globs_as_columns(spark):
    texts = sorted({*globs(random.Random(3), 1500), "", "*", "**", "a*b*cc*dd"})
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    for r in df.select("p", glob_columns(S.col("p")).alias("g")).collect():
        assert r["g"]["regex"] == glob_regex(r["p"]), r
        assert (r["g"]["length"] is None) == ("*" in re.sub(r"\[!?[\s\S][^\]]*\]", "", r["p"])), r
        assert r["g"]["piece"] in r["p"]


@pytest.mark.parametrize("seed", [1, 2])
def test_many_patterns_and_names(spark, seed):
    rng = random.Random(seed)
    patterns = [*globs(rng, 250), "*", "??", "", "release-*", "*long enough piece*", "long enough p?ece and more"]
    names = ["".join(rng.choice(["a", "b", "-", "x1", ".", "c", "(", "]", "é", "rel-", "&"]) for _ in range(rng.randrange(0, 6))) for _ in range(200)]
    names += ["release-1", "a long enough piece here", "long enough piece and more", "", "line\nbreak"]
    left = spark.createDataFrame([*[(i, n, "z") for i, n in enumerate(names)], (None, None, "z")], "id int, name string, length string")
    right = spark.createDataFrame([*[(i, p, 0) for i, p in enumerate(patterns)], (None, None, 0)], "pid int, pattern string, piece int")
    got = sorted((r["id"], r["pid"]) for r in match_patterns(left.repartition(3), right).collect())
    assert got == sorted((i, j) for i, n in enumerate(names) for j, p in enumerate(patterns) if fnmatch.fnmatchcase(n, p))
    plan = match_patterns(left, right)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert match_patterns(left, right.limit(0)).collect() == [] and match_patterns(left.limit(0), right).collect() == []


def test_rows_are_dealt_before_their_grams(spark, tmp_path):
    df = spark.createDataFrame([(1, "abcabc", "bca"), (2, "abc", None), (2, "xabc", "abc"), (3, "".join(chr(200 + i) for i in range(90)), None)], "id int, name string, note string")
    postings = text_postings(df)
    assert sorted((r["id"], r["gram"]) for r in postings.where("id < 3").collect()) == [(1, "abc"), (1, "bca"), (1, "cab"), (2, "abc"), (2, "xab")]
    assert "hashpartitioning(id" in postings._jdf.queryExecution().toString()  # not by one task for each file
    write_postings(postings, str(tmp_path / "p"), 2)
    stored = spark.read.parquet(str(tmp_path / "p"))
    text = "".join(chr(200 + i) for i in range(5, 85))  # more than 63 grams
    assert [r["id"] for r in search_postings(df, stored, text).collect()] == [3]
    assert search_postings(df, stored, text + "!").collect() == []
