"""Expansion by groups of rows against a plain join."""

from __future__ import annotations

import random

from pyspark.sql import functions as S

from changelake.operators import subscriptions as U
from changelake.operators.indexes import match_patterns
from changelake.plans.groups import expanded, group_counts
from tests.test_plans import NO_BROADCAST, settings


def test_expanded_is_the_join(spark):
    rng = random.Random(8)
    right = [(rng.choice("abc"), rng.choice([None, 1, 2, i]), {"m": i}) for i in range(300)] + [("a", 7, None)] * 50 + [("z", 0, None)]
    df = spark.createDataFrame(right, "k string, v int, m map<string,int>")
    left = spark.createDataFrame([(i, rng.choice("abcd")) for i in range(60)], "id int, on string")
    want = sorted(map(repr, left.join(df, S.col("on") == S.col("k")).select("id", "v", "m").collect()))
    for size in (1, 7, 10_000):
        counts = group_counts(df, ["k"], size)
        matches = left.join(counts, S.col("on") == S.col("k")).drop("k")
        got = expanded(matches, ["on"], df, ["k"], counts)
        assert sorted(map(repr, got.collect())) == want
    assert expanded(matches.limit(0), ["on"], df, ["k"], counts).collect() == []


def test_repeated_patterns_are_looked_up_once(spark):
    names = spark.createDataFrame([(i, f"src{i}/x.csv") for i in range(40)], "id int, name string")
    rows = [(i, "src?/*.csv") for i in range(3000)] + [(i, "src1*") for i in range(3000, 3003)]
    found = match_patterns(names, spark.createDataFrame(rows, "pid int, pattern string"))
    assert found.columns == ["id", "name", "pid", "pattern"]
    assert {tuple(r) for r in found.groupBy("id").count().collect()} == {(i, 3000 * (i < 10) + 3 * (str(i)[0] == "1")) for i in range(40) if i < 20}
    assert found.count() == 30_000 + 33
    assert "RoundRobinPartitioning" in found._jdf.queryExecution().toString()  # the product is dealt to all tasks


def test_subscribers_of_a_start_are_joined_in_groups(spark):
    matches = spark.createDataFrame([("c", i, "created") for i in range(20)], "criterion string, id long, event string").coalesce(1)
    members = [(i, "c", None) for i in range(2500)] + [(9000 + i, "c", 10 + i % 2) for i in range(50)] + [(1, "d", None), (1, "c", None)]
    got = U.delivered(matches, spark.createDataFrame(members, "sub_id long, criterion string, start_id long"))
    assert got.columns == ["sub_id", "id", "event"] and got.count() == 20 * 2501 + 25 * 9 + 25 * 8
    assert got.distinct().count() == 20 * 2500 + 25 * 9 + 25 * 8
    assert "RoundRobinPartitioning" in got._jdf.queryExecution().toString()


def test_expanded_by_one_column_keeps_its_nulls(spark):
    df = spark.createDataFrame([("a", i if i % 3 else None) for i in range(100)] + [("b", None)] * 20 + [("c", 1)], "k string, v int")
    left = spark.createDataFrame([(i, "abcd"[i % 4]) for i in range(40)], "id int, on string")
    want = sorted(map(repr, left.join(df, S.col("on") == S.col("k")).select("id", "v").collect()))
    for size in (1, 30, 10_000):
        counts = group_counts(df, ["k"], size)
        got = expanded(left.join(counts, S.col("on") == S.col("k")).drop("k"), ["on"], df, ["k"], counts)
        assert got.columns == ["id", "v"] and sorted(map(repr, got.collect())) == want


def test_a_product_is_written_in_few_bytes_a_row(spark, tmp_path):
    names = spark.createDataFrame([(i, f"src{i}/x.csv") for i in range(400)], "id long, name string")
    patterns = spark.range(20_000).select((S.col("id") * 60 + 7).alias("pid"), S.when(S.col("id") % 2 == 0, "src*").otherwise("*csv").alias("pattern"))
    match_patterns(names, patterns).select("pid", "id").write.parquet(str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == written.distinct().count() == 400 * 20_000
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 400 * 20_000  # less than a byte for two longs


def test_a_product_is_dealt_to_all_tasks_without_a_broadcast(spark):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    matches = spark.range(4000).select(S.lit("c").alias("criterion"), "id", S.lit("created").alias("event")).coalesce(1)
    # starts are constant where subscriptions have none
    members = spark.range(500).select(S.col("id").alias("sub_id"), S.concat(S.lit("c"), S.lit("")).alias("criterion"), S.lit(None).cast("bigint").alias("start_id"))
    with settings(spark, **NO_BROADCAST):
        got = U.delivered(matches, members)
        rows = [r["count"] for r in got.groupBy(S.spark_partition_id()).count().collect()]
        plan = got._jdf.queryExecution().toString()
    assert sum(rows) == 4000 * 500 and len(rows) > tasks // 2 and max(rows) < sum(rows) // 2
    assert "hashpartitioning(cast(" not in plan and plan.count("REPARTITION_BY_NUM") >= 2
