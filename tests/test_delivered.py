"""Delivered ids as intervals, and transitions settled batch by batch, against plain Python and the whole log."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as S

from changelake.operators import changes as C
from changelake.operators.delivered import add_delivered, no_intervals, undelivered
from changelake.plans.segments import lead_once, lead_value
from changelake.sources.readers import read_log_stream
from changelake.sources.schemas import BRANCH
from changelake.streaming import streams
from tests.rows import catalog_of, line, row


def islands(ids, span):
    out = []
    for i in sorted(ids):
        if out and out[-1][1] == i - 1 and i // span == out[-1][0] // span:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("span", [5, 64, 1_000_000])
def test_intervals_of_batches(spark, span):
    rng = random.Random(span)
    known, seen = no_intervals(spark), set()
    for step in range(4):
        ids = [rng.randrange(-50, 150) for _ in range(60)] + [7] * 30 + [None] * (step % 2)
        events = spark.createDataFrame([(i, f"{step}", 1) for i in ids], "id int, name string, first_id int")
        new = undelivered(events, known, span)
        assert new.columns == events.columns
        assert sorted(r["id"] for r in new.collect()) == sorted({i for i in ids if i is not None} - seen)
        known = spark.createDataFrame(add_delivered(known, events, span).collect(), "segment bigint, first_id bigint, last_id bigint")
        seen |= {i for i in ids if i is not None}
        assert sorted((r["first_id"], r["last_id"]) for r in known.collect()) == islands(seen, span)
    dense = add_delivered(no_intervals(spark), spark.range(1, 100_000), 1_000_000)
    assert [(r["first_id"], r["last_id"]) for r in dense.collect()] == [(1, 99_999)]
    assert undelivered(events.limit(0), known, span).collect() == []


def test_stream_delivers_once_after_any_delay(spark, tmp_path):
    log = spark.range(300).withColumn("what", S.col("id") % 7)
    for part in ("id < 100", "id % 2 = 0", "id < 100", "id >= 50", "id >= 0"):
        log.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream, out, checkpoint = lambda: read_log_stream(spark, str(tmp_path / "log"), schema=log.schema, max_files=1), str(tmp_path / "out"), str(tmp_path / "cp")
    plain = streams.parquet_sink(out)

    def failing(events, batch_id):
        plain(events, batch_id)
        if batch_id == 2:
            raise RuntimeError("lost before the commit")

    with pytest.raises(Exception, match="lost before"):
        streams.deliver_once(stream(), failing, checkpoint, span=64).awaitTermination()
    streams.deliver_once(stream(), plain, checkpoint, span=64).awaitTermination()
    got = spark.read.parquet(f"{out}/batch=*")
    assert sorted(map(tuple, got.select("id", "what").collect())) == sorted(map(tuple, log.collect()))


@pytest.mark.parametrize("span", [3, 40, 1_000_000])
def test_lead_once_is_lead_value(spark, span):
    rng = random.Random(4)
    rows = [(i, rng.choice("abc"), rng.choice([None, 1, 2])) for i in rng.sample(range(500), 120)]
    df = spark.createDataFrame(rows, "id long, k string, v int").repartition(3)
    got = lead_once(df, ["k"], "id", "v", "n", span)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, lead_value(df, ["k"], "id", "v", "n", span).collect()))


@pytest.mark.parametrize("span", [7, 1_000_000])
def test_settled_batches_are_the_whole_log(spark, span):
    rng = random.Random(9)
    log = []
    for i in range(1, 200):
        data = {"_status_code": rng.choice([-1, 0, 1, None])} if rng.random() < 0.6 else {"name": "x"}
        log.append(line(i, rng.choice(["UPDATE", "UPDATE", "INSERT"]), "t_branch", rng.choice([1, 2, 3, 9, None]), data))
    cat = catalog_of(spark, log, branch=[row(BRANCH, id=i, name=f"b{i}", _status_code=i) for i in (1, 2, 3)])
    for skip in (False, True):
        whole = C.field_transitions(cat.log(), cat.load("branch"), skip_null=skip)
        pending, settled = None, []
        for low, high in ((0, 50), (50, 51), (51, 51), (51, 140), (140, 999)):
            batch = cat.log().where(f"id > {low} AND id <= {high}")
            rows = spark.createDataFrame(C.settle_transitions(batch, pending, skip_null=skip, span=span).collect(), C.settle_transitions(batch, pending, skip_null=skip).schema)
            settled += rows.where("NOT is_open").collect()
            pending = rows.where("is_open").drop("new_value", "is_open")
            assert pending.groupBy("sqlrecord_id").count().where("count > 1").count() == 0
        settled += C.close_transitions(pending, cat.load("branch")).collect()
        want = [(r["id"], r["previous_value"], r["new_value"]) for r in whole.collect()]
        key = lambda r: (r[0], str(r))
        assert sorted(((r["id"], r["previous_value"], r["new_value"]) for r in settled), key=key) == sorted(want, key=key)


def test_a_batch_is_read_once(spark, tmp_path):
    spark.createDataFrame([(i, "UPDATE", i % 5, '{"_status_code": 1}') for i in range(50)], "id long, event_type string, sqlrecord_id long, data string").write.parquet(str(tmp_path / "b"))
    rows = C.settle_transitions(spark.read.parquet(str(tmp_path / "b")))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1, plan
