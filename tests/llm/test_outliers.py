"""Quality rules: counts by hand, estimates against numpy, labelled documents."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm.outliers import FLOORS, chi2_below, chi2_quantile, good_documents, judged, mcd, text_counts
from changelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def failed(text):
    n, _, _, _, repeats = counts(text)
    return n < 50 or 100 * repeats > 50 * n


ODD = [
    None, "", " ", "\n\n\t", "a", "a b", "a b c", "a b c a b c", "a a a a", "a b c d\na b c d\nb c d", "x\x0by\x0cz x y\tz", "É É É É",
    "line\nline\n line\n\n\nline", "# * $ % & | < > ##", "w " * 60, "a b c " + " ".join(map(str, range(5000))) + " a b c",
    "\n".join(["same line again"] * 3000), " ".join(map(str, range(60))), "a b c a b c",
]


def test_counts(spark):
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(ODD)], "doc_id bigint, text string, n_words string")
    for r in text_counts(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(ODD[r.doc_id]), ODD[r.doc_id]


def test_chi2():
    assert chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-3) and chi2_below(6.6257, 5) == pytest.approx(0.75, abs=1e-4)


def plain_mcd(x, share=0.75, steps=3, inside=0.975, bins=256.0):
    """The same estimates with whole arrays."""
    d = x.shape[1]

    def quantile(v, p):
        b = np.sort(np.floor(v * bins), axis=0)
        return (b[int(np.ceil(p * len(v))) - 1] + 1) / bins

    def estimate(rows, factor):
        c = np.atleast_2d(np.cov(rows.T, bias=True)) * factor
        return rows.mean(axis=0), c + np.diag(np.square(FLOORS))

    def distance(m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    mean = quantile(x, 0.5)
    cov = np.diag((quantile(np.abs(x - mean), 0.5) * 1.4826) ** 2 + np.square(FLOORS))
    for _ in range(steps):
        place = np.log1p(distance(mean, cov))
        mean, cov = estimate(x[place < quantile(place, share)], share / chi2_below(chi2_quantile(share, d), d + 2))
    limit = chi2_quantile(inside, d)
    return estimate(x[distance(mean, cov) <= limit], inside / chi2_below(limit, d + 2))


def test_estimates(spark):
    rng = np.random.default_rng(5)
    cells = {}
    for cell, n in (("hot", 3000), ("small", 70), ("one", 1)):
        mix = rng.normal(0, 1, (5, 5))
        x = rng.normal(0, 1, (n, 5)) @ mix + rng.normal(0, 3, 5)
        x[: n // 6] += 25  # outliers in a cloud of their own
        cells[cell] = x
    rows = spark.createDataFrame([(c, row.tolist()) for c, x in cells.items() for row in x], "cell string, x array<double>").repartition(4)
    for r in mcd(rows).collect():
        mean, cov = plain_mcd(cells[r["cell"]])
        assert r["mean"] == pytest.approx(mean.tolist(), rel=1e-6, abs=1e-6)
        w = np.array(r.whiten).reshape(5, 5)
        assert np.allclose(w.T @ w, np.linalg.inv(cov), rtol=1e-5, atol=1e-6)
        if r["cell"] == "hot":
            assert np.abs(np.array(r["mean"]) - cells["hot"][500:].mean(axis=0)).max() < 0.5  # the outliers don't pull


def test_query_over_the_whole_table(spark):
    con = duckdb.connect()
    docs = dict(con.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    labels = dict(con.execute(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = QUERIES["op6_quality_rules"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(docs[r.doc_id])
        assert r.base_failed == failed(docs[r.doc_id]) and not (r.base_failed and r.kept)
    judged_rows = [r for r in rows if r.doc_id in labels and not r.base_failed]
    assert np.mean([r.kept for r in judged_rows if labels[r.doc_id] == 1]) > 0.99
    assert np.mean([r.kept for r in judged_rows if labels[r.doc_id] == 0]) < 0.1


def test_odd_cells(spark):
    prose = " ".join(f"w{i}" for i in range(80))
    rows = [(i, t, None if i % 2 else "en", "s", 1) for i, t in enumerate([*ODD, prose, prose])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, cell int")
    out = {r.doc_id: r for r in judged(docs).collect()}
    assert len(out) == len(rows) and all(r.base_failed == failed(rows[i][1]) for i, r in out.items())
    assert out[len(ODD)].kept and out[len(ODD) + 1].kept
    good = good_documents(docs)
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {i for i, r in out.items() if r.kept}
    assert good_documents(docs.limit(0)).select(F.count("*")).first()[0] == 0


def worded(n, seed, length=5, symbols=0):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefghij"), max(1, int(rng.normal(length, 1))))) + str(i) for i in range(n)]
    return " ".join(words + ["#$%"] * symbols)


def test_small_cells_beside_a_null_source(spark):
    good = [(i, worded(60 + i * 3 % 90, i), "en", None) for i in range(60)]
    alone = {r.doc_id: r.kept for r in judged(spark.createDataFrame(good, "doc_id int, text string, lang string, source string")).collect()}
    assert sum(alone.values()) >= 59
    odd = [(1000 + i, worded(3000 + i * 100, i, 14, 900), "en", f"s{i // 4}") for i in range(40)]
    odd += [(2000, worded(70, 3), None, None), (2001, worded(70, 4), "null", "null"), (2002, worded(80, 5), "all", None)]
    both = judged(spark.createDataFrame(good + odd, "doc_id int, text string, lang string, source string"))
    after = {r.doc_id: r.kept for r in both.collect()}
    assert {i: after[i] for i in alone} == alone
    assert after[2000] and after[2001] and after[2002]


def test_the_start_of_least_determinant_counts(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (800, 5)), rng.normal(9, 0.6, (150, 5))])
    cells = {"a:b": x, "c": rng.normal(0, 2, (400, 5))}
    rows = spark.createDataFrame([(c, row.tolist()) for c, v in cells.items() for row in v], "cell string, x array<double>")
    found = {starts: {r["cell"]: r for r in mcd(rows, starts=starts).collect()} for starts in (("medians",), ("means",), ("medians", "means"))}
    for cell in cells:
        both, single = found["medians", "means"][cell], [found[(s,)][cell] for s in ("medians", "means")]
        assert any(np.allclose(both["mean"], r["mean"]) and np.allclose(both["cov"], r["cov"]) for r in single)
    assert np.abs(np.array(found["medians", "means"]["a:b"]["mean"])).max() < 0.3
