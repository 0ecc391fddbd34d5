"""Line dedup against its SQL and a plain count."""

from __future__ import annotations

from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from changelake.llm.line_dedup import LineRuns, dedup_lines
from changelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"


def brute(rows, min_docs=3, min_chars=20):
    """``(doc_id, n_lines, n_dropped, text)`` of rows of (doc_id, text)."""

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    holders = defaultdict(set)
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    rank = [(-1 if d is None else 0, d or 0) for d, _ in rows]
    out = []
    for i, (doc, text) in enumerate(rows):
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(key(line), ())
            if len(held) < min_docs or rank[i] == max(rank[j] for j in held):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=repr)


LONG, OTHER = "A line of more than twenty points", "another line that is long enough"
ODD = [
    (1, f"{LONG}\nshort\n\nx"), (2, f"  {LONG.upper()}\t\n{OTHER}"), (3, f"{LONG}\n{LONG}\n{OTHER}"), (4, LONG), (5, None), (6, ""),
    (7, f"É{LONG}\n{OTHER}"), (8, f"é{LONG}"), (9, f"É{LONG}\r"), (10, "\n\n"), (11, "É" + LONG.upper()), (12, "x" * 20 + "\n" + "x" * 19),
    (13, "x" * 20), (14, "X" * 20 + "\x0b"), (15, "x" * 20 + " "), (None, f"{LONG}\nmine"), (None, LONG), (2, f"own {LONG}"),
    (4, f"{LONG}\n{LONG}"), (16, "\n".join(f"line number {i} of a very long text" for i in range(3000))),
    (17, "\n".join(f"line number {i} of a very long text" for i in range(0, 3000, 2))), (18, "line number 4 of a very long text"),
]


@pytest.mark.parametrize(("batches", "fanout"), [(1, 4), (4, 4), (5, 2)])
def test_odd_rows(spark, batches, fanout):
    docs = spark.createDataFrame([(d, t, 1, "h") for d, t in ODD], "doc_id bigint, text string, n_lines int, h1 string").repartition(3)
    out = dedup_lines(docs, batches=batches, fanout=fanout)
    assert out.columns == ["doc_id", "h1", "text", "n_lines", "n_dropped"]
    assert result(out) == brute(ODD)


def test_levels_are_compacted(spark):
    runs = LineRuns(spark, min_docs=2, min_chars=1, fanout=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(10 - i, f"common\nline {i}")], "doc_id bigint, text string"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    rows = {(r.n, r.top) for level in runs.levels for name in level for r in spark.table(name).collect()}
    # the common line was settled by the first two batches and not added again
    assert rows == {(2, 10), (1, 10), (1, 9), (1, 8), (1, 7), (1, 6)}
    assert [r.top for r in runs.common().collect()] == [10]


def test_no_rows(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_merge_of_a_run_needs_no_other_exchange(spark):
    runs = LineRuns(spark, min_docs=2, min_chars=1)
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("line "), F.col("id") % 7).alias("text"))
    runs.add(docs)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rest = runs.unsettled(docs)
        assert rest.count() == 0
        plan = rest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.split("Initial Plan")[-1].count("Exchange") == 1


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({ORACLES['op1_line_dedup']})").fetchall()
    got = [tuple(r) for r in QUERIES["op1_line_dedup"](spark, sf).collect()]
    assert sorted(got) == sorted(want) and sum(r[2] for r in got) > 0
