"""The bit-sliced index against plain inner products."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm.bit_sliced import Slices, _digits, top_k
from changelake.llm.queries import ORACLES, QUERIES


def brute(rows, k, scale=64.0):
    coded = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            coded.append((i, [math.floor(scale * x) for x in v]))
    out = []
    for q in {i for i, _ in coded if i % 20 == 0}:
        x = next(v for i, v in coded if i == q)
        best = sorted((-sum(a * b for a, b in zip(x, v, strict=False)), i) for i, v in coded if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_digits():
    for n in range(-300, 300):
        assert sum(d << p for p, d in _digits(n)) == n


@pytest.mark.parametrize("seed", range(4))
def test_sums_of_slices(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(-70, 60, (193, 9)) * rng.integers(0, 2, 9)
    slices = Slices(values)
    for query in (*rng.integers(-100, 100, (4, 9)), np.zeros(9, np.int64)):
        allowed = np.full(slices.words, ~np.uint64(0), "<u8")
        rows, scores = slices.top(query, 193, allowed)
        assert (rows == np.arange(193)).all() and (scores == values @ query).all()
        rows, scores = slices.top(query, 10, allowed)
        assert sorted(scores)[-10:] == sorted(values @ query)[-10:]


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 5)]) for i in range(150)]
    rows += [(200 + i, [0.1, 0.2, -0.3, 0.4, 0.0]) for i in range(60)]  # one vector many times
    rows += [(300, None), (301, [0.1, None, 0.2, 0.1, 0.1]), (302, [float("nan")] * 5), (320, [float("inf")] * 5), (None, [0.1] * 5)]
    rows += [(340, [1.0, -0.5]), (341, []), (360, [0.0] * 5), (380, [1e6, -1e6, 3e5, 0.5, 0.25]), (7, [0.5] * 5)]
    docs = spark.createDataFrame([(i, v, 1, "q") for i, v in rows], "vec_id bigint, embedding array<double>, score int, id string")
    for blocks in ({}, {"rows": 50, "queries": 3}):
        got = sorted(tuple(r) for r in top_k(docs.repartition(3), F.col("vec_id") % 20 == 0, k=7, **blocks).collect())
        assert got == brute(rows, 7)


def test_few_and_no_rows(spark):
    docs = spark.createDataFrame([(20, [0.5]), (21, [0.25])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in top_k(docs, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21, 512)]
    assert top_k(docs.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert top_k(docs.where("vec_id = 21"), F.col("vec_id") % 20 == 0).collect() == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(con.execute(ORACLES["op2_top_k"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op2_top_k"](spark, sf).collect()) == want


def test_wild_vectors_and_repeated_queries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1, 6) * 10.0 ** (i % 8)).tolist()) for i in range(200)]
    rows += [(500, [1e9] * 6), (501, [-1.5e7, 1e7, 1e6, 0.0, 0.0, 1.0]), (502, [1e300] * 6), (503, [2.3e7, 0.0, 0.0, 0.0, 0.0, 0.0])]
    rows += [(0, [5.0] * 6), (0, [-5.0] * 6), (20, [0.5] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    scaled = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if sum((64 * x) * (64 * x) for x in v) < 2**61]
    assert {i for i, _ in scaled} >= {501, 503} and not {500, 502} & {i for i, _ in scaled}
    asked: dict = {}
    for i, v in scaled:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    want = {}
    for i, q in asked.items():
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in scaled if j != i)[:20]
        want |= {(i, rank): (j, -score) for rank, (score, j) in enumerate(best, 1)}
    for small in ({}, {"rows": 40, "queries": 3}):
        got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k(df.repartition(3), F.col("vec_id") % 20 == 0, **small).collect()}
        assert got == want
