"""Plans: hot keys are split, filters reach the scan, nothing gathers a key or a table in one task."""

from __future__ import annotations

import contextlib
import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as S

import __spark_entry__ as entry_module
from changelake import queries as named_queries
from changelake.operators import changes as C
from changelake.operators import events as E
from changelake.operators import gates as G
from changelake.operators import lineage as L
from changelake.plans.joins import lookup
from changelake.plans.once import computed_once
from changelake.plans.segments import hashed_segment, lead_value, numbered, span_of
from changelake.sources.catalog import Catalog, Registry


@contextlib.contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
TINY_SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.mark.parametrize("span", [1, 7, 100, 10**6])
def test_segmented_computations_equal_plain_windows(spark, span):
    df = spark.range(500).select(
        (S.col("id") * 3 + 1).alias("id"), S.when(S.col("id") % 3 == 0, 0).otherwise(S.col("id") % 11).alias("k"),
        (S.col("id") % 5).alias("v"),
    )
    by_key = W.partitionBy("k").orderBy("id")
    plain = df.select("id", S.lead("v").over(by_key).alias("next"), S.row_number().over(by_key).cast("bigint").alias("n"))
    rows = numbered(lead_value(df, ["k"], "id", "v", "next", span), ["k"], ["id"], "n", span_of(S.col("id"), span))
    assert rows.select("id", S.col("next.value").alias("next"), "n").exceptAll(plain).count() == 0
    assert rows.count() == 500
    whole = numbered(df, [], ["id"], "n", span_of(S.col("id"), span))
    expected = df.select("id", S.row_number().over(W.orderBy("id")).cast("bigint").alias("n"))
    assert whole.select("id", "n").exceptAll(expected).count() == 0
    hashed = numbered(df.withColumn("u", S.md5(S.col("id").cast("string"))), [], ["u"], "n", hashed_segment("u", 1))
    assert sorted(r["n"] for r in hashed.select("n").collect()) == list(range(1, 501))


def test_spans_are_exact_for_large_ids(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big,)], "id long")
    assert df.select(span_of(S.col("id"), 10)).first()[0] == big - big % 10


@pytest.fixture(scope="module")
def hot_log(spark, tmp_path_factory):
    """A log in several files, a third of whose rows are about one record."""
    path = str(tmp_path_factory.mktemp("hot") / "log")
    record = S.when(S.col("n") % 3 == 0, 5).otherwise(S.col("n") % 900)
    kind = S.when(S.col("n") % 4 == 0, "INSERT").otherwise("UPDATE")
    data = S.when(kind == "UPDATE", S.when(S.col("n") % 2 == 0, '{"_status_code": 1}').otherwise('{"_aux": "{\\"so\\": 1}"}'))
    log = spark.range(1, 60_001, numPartitions=8).withColumnRenamed("id", "n").select(
        S.col("n").alias("id"), S.concat(S.lit("w"), S.sha2(S.col("n").cast("string"), 256)).alias("uid"),
        kind.alias("event_type"), S.lit("t").alias("table_name"), record.cast("bigint").alias("sqlrecord_id"),
        S.lit(None).cast("timestamp_ntz").alias("created_at"), (S.col("n") % 50).alias("created_by_id"),
        S.lit(1).cast("bigint").alias("branch_id"), S.lit(1).cast("bigint").alias("space_id"),
        S.lit(None).cast("bigint").alias("run_id"), data.alias("data"),
    )
    log.write.parquet(path)
    return path


@pytest.fixture(scope="module")
def hot_catalog(spark, hot_log):
    def records():
        return spark.range(900).select(
            "id", S.lit("a.csv").alias("key"), S.lit(".csv").alias("suffix"), S.lit(None).cast("string").alias("kind"),
            S.lit(1).cast("bigint").alias("branch_id"), S.lit(None).cast("string").alias("_aux"),
            S.lit("branch").alias("name"), S.lit(0).alias("_status_code"),
        )

    return Catalog(
        [Registry("core.artifact", "t", records), Registry("core.branch", "t", records)],
        lambda: spark.read.parquet(hot_log),
    )


def _hot(spark):
    """A key with a third of the rows, in enough partitions to be split."""
    rows = spark.range(0, 60_000, numPartitions=16)
    key = S.when(S.col("id") % 3 == 0, S.lit(1)).otherwise(S.col("id") % 997)
    return rows.select("id", key.cast("bigint").alias("k"), S.sha2(S.col("id").cast("string"), 256).alias("payload"))


def test_lookup_of_an_aggregate_splits_a_hot_key(spark):
    with settings(spark, **NO_BROADCAST, **TINY_SKEW):
        rows = _hot(spark)
        table = rows.groupBy("k").agg(S.max("id").alias("top")).withColumnRenamed("k", "kk")
        joined = lookup(rows, table, {"k": "kk"})
        text = run_plan(joined)
        assert "SortMergeJoin(skew=true)" in text
        assert joined.count() == 60_000
        # the same join without the hash can't be split: this is what it is for
        assert "SortMergeJoin(skew=true)" not in run_plan(rows.join(table, rows["k"] == table["kk"], "left"))


def test_lookup_matches_keys_of_different_widths_and_drops_helpers(spark):
    rows = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    table = spark.createDataFrame([(1, "a"), (2, "b")], "kk long, v string")
    joined = lookup(rows, table, {"k": "kk"})
    assert joined.columns == ["k", "v"]
    assert sorted(map(tuple, joined.collect()), key=str) == [(1, "a"), (3, None), (None, None)]
    assert [r["k"] for r in lookup(rows.where("k > 0"), table, {"k": "kk"}, "left_anti").collect()] == [3]


@pytest.mark.parametrize(
    "make",
    [
        lambda c: E.record_events(c, "artifact", events=["created", "updated"]),
        lambda c: E.artifact_events(c, events=["created", "updated"]),
    ],
    ids=["record", "artifact"],
)
def test_events_of_a_hot_record_are_split(spark, hot_catalog, make):
    with settings(spark, **NO_BROADCAST, **TINY_SKEW):
        assert "SortMergeJoin(skew=true)" in run_plan(make(hot_catalog))


def test_transitions_of_a_hot_record_are_cut_into_segments(spark, hot_catalog):
    rows = C.field_transitions(hot_catalog.log(), hot_catalog.load("branch"), span=5000)
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan(rows))
    assert len(windows) == 2 and sum("__segment" in keys for keys in windows) == 1
    plain = C._changes(hot_catalog.log(), "_status_code", False).select(
        "id", S.coalesce(S.lead("previous_value").over(W.partitionBy("sqlrecord_id").orderBy("id")), S.lit(0)).alias("new_value")
    )
    assert rows.select("id", "new_value").exceptAll(plain).count() == 0


def test_gates_limit_rows_before_the_shuffle(spark, hot_catalog):
    gates = spark.createDataFrame([(1, None, "a", 1), (2, "k", None, 1), (3, None, None, 1)], "gate_id int, key string, key_prefix string, min_count int")
    for n in (5, 1500):
        text = plan(G.gate_opened_at(hot_catalog.log(), ["sqlrecord_id"], n))
        assert text.index("Exchange") < text.index("WindowGroupLimit", text.index("Exchange"))
        table = plan(G.evaluate_gates(hot_catalog.load("artifact"), gates, limit=n))
        assert "WindowGroupLimit" in table and "BroadcastNestedLoopJoin" not in table and "CartesianProduct" not in table


def test_latest_run_is_a_partial_aggregate(spark):
    runs = spark.range(10).selectExpr("id", "'r' as reference", "1L as branch_id", "id as created_at")
    text = plan(L.latest_flow_run(runs))
    assert "Window" not in text and "partial_max_by" in text


def test_log_filters_and_columns_reach_the_scan(spark, hot_catalog):
    with settings(spark, spark__sql__maxMetadataStringLength="2000"):
        _check_scans(hot_catalog)


def _check_scans(hot_catalog):
    text = E.record_events(hot_catalog, "artifact", events="created").select("id")._jdf.queryExecution().toString()
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "event_type" in line)
    assert "EqualTo(table_name,t)" in scan and "EqualTo(branch_id,1)" in scan and "In(event_type, [INSERT,UPDATE])" in scan
    assert "uid" not in scan.split("ReadSchema")[1]
    completions = C.upload_completions(hot_catalog.log(), "t")._jdf.queryExecution().toString()
    assert "StringContains(data,_aux)" in completions


def test_json_is_parsed_once_per_row(spark, hot_catalog):
    text = plan(E.record_events(hot_catalog, "artifact", events=["created", "updated", "deleted"]))
    assert text.count("parseJson(data") == 1


def test_computed_once_stays_below_filters(spark):
    df = computed_once(spark.range(3), a=S.sha2(S.col("id").cast("string"), 256)).where(S.col("a").startswith("0"))
    assert plan(df).count("sha2") == 1


STREAMS = ("s02", "s11", "s14", "s15")
BOUNDED = {
    # windows without keys, over a bounded number of rows: those of a limit, or one row per segment
    "g01_record_gate", "g04_artifact_gate", "s03_insert_records", "s06_emit_log", "s06_emit_accepted", "c24_block_events", "c30_all_events",
}


@pytest.mark.parametrize("name", sorted(n for n in named_queries.QUERIES if not n.startswith(STREAMS)))
def test_no_query_uses_a_cross_join_or_a_table_wide_window(spark, name):
    text = plan(entry_module.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in BOUNDED:
        assert "Exchange SinglePartition" not in re.sub(r"(Hash|Sort|Object)\w*Aggregate\(keys=\[\][^\n]*\n[^\n]*Exchange SinglePartition", "", text)


@pytest.mark.parametrize("name", ["c15_record_events", "c20_artifact_events", "c33_subscriptions", "q16_to_one_path", "l09_apply_attempts", "g06_gate_table", "l19_exclude_masked"])
def test_results_do_not_depend_on_the_join_strategy(spark, name):
    query = entry_module.queries()[name]

    def rows():
        df = query(spark, "/root/testdata/sf0.001")
        return sorted(map(repr, df.collect()))

    expected = rows()
    with settings(spark, **NO_BROADCAST, **TINY_SKEW):
        assert rows() == expected
