"""Gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as S

from changelake.operators import gates as G
from changelake.plans.filters import F
from changelake.queries import named
from changelake.sources.fixtures import catalog, view

_UPLOADING = "coalesce(_aux IN ('{\"so\": 1}', '{\"so\": true}'), false)"
_VISIBLE = "(kind IS NULL OR kind NOT IN ('__internal_run__', '__internal_config__'))"


@named(
    "g01_record_gate", ("artifact",),
    f"""WITH newest AS (SELECT * FROM artifact WHERE suffix = '.csv' AND branch_id = 1 ORDER BY id DESC LIMIT 60),
       ready AS (SELECT * FROM newest WHERE NOT {_UPLOADING})
       SELECT id, key FROM ready WHERE (SELECT count(*) FROM ready) >= 5""",
)
def g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.record_gate(catalog(spark, sf_dir), "artifact", F("suffix") == ".csv", min_count=5, limit=60).select("id", "key")


@named(
    "g04_artifact_gate", ("artifact",),
    f"""WITH newest AS (SELECT * FROM artifact WHERE starts_with(key, 'src1') AND {_VISIBLE} AND branch_id = 1
         ORDER BY id DESC LIMIT 100), ready AS (SELECT * FROM newest WHERE NOT {_UPLOADING})
       SELECT id, key, kind FROM ready WHERE (SELECT count(*) FROM ready) >= 3""",
)
def g04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.artifact_gate(catalog(spark, sf_dir), key_prefix="src1", min_count=3, limit=100).select("id", "key", "kind")


@named(
    "g04_artifact_gate_all", ("artifact",),
    f"""WITH ready AS (SELECT * FROM artifact WHERE starts_with(key, 'src1') AND {_VISIBLE} AND branch_id = 1
         AND NOT {_UPLOADING})
       SELECT id, key, kind FROM ready WHERE (SELECT count(*) FROM ready) >= 3""",
)
def g04_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.artifact_gate(catalog(spark, sf_dir), key_prefix="src1", min_count=3).select("id", "key", "kind")


@named(
    "g05_branch_gate", ("branch", "gate"),
    """SELECT g.gate_id, CASE WHEN b.id IS NULL THEN 'pending' WHEN b._status_code = -1 THEN 'success'
         WHEN b._status_code = -2 THEN 'failure' ELSE 'pending' END AS verdict
       FROM gate g LEFT JOIN branch b ON b.id = g.branch_id_ref""",
)
def g05(spark: SparkSession, sf_dir: str) -> DataFrame:
    gates = view(spark, sf_dir, "gate").withColumnRenamed("branch_id_ref", "branch_id")
    return G.branch_gate(view(spark, sf_dir, "branch"), gates).select("gate_id", "verdict")


@named(
    "g06_gate_table", ("artifact", "gate"),
    f"""WITH matches AS (SELECT g.gate_id, a.id, {_UPLOADING} AS uploading,
         row_number() OVER (PARTITION BY g.gate_id ORDER BY a.id DESC) AS n
         FROM gate g JOIN artifact a ON a.suffix = g.suffix AND starts_with(a.key, g.key_prefix)
         WHERE a.branch_id = 1 AND {_VISIBLE}),
       counts AS (SELECT gate_id, count(*) FILTER (WHERE NOT uploading) AS n FROM matches WHERE n <= 20 GROUP BY gate_id)
       SELECT g.gate_id, coalesce(c.n, 0) AS n_ready, g.min_count,
         CASE WHEN coalesce(c.n, 0) >= g.min_count THEN 'success' ELSE 'pending' END AS verdict
       FROM gate g LEFT JOIN counts c ON c.gate_id = g.gate_id""",
)
def g06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.evaluate_gates(view(spark, sf_dir, "artifact"), view(spark, sf_dir, "gate"), limit=20)


@named(
    "g06_gate_criteria", ("artifact", "gate_criteria"),
    f"""WITH matches AS (SELECT g.gate_id, a.id, {_UPLOADING} AS uploading,
         row_number() OVER (PARTITION BY g.gate_id ORDER BY a.id DESC) AS n
         FROM gate_criteria g JOIN artifact a ON a.branch_id = coalesce(g.branch_id, 1) AND (g.key IS NULL OR a.key = g.key)
           AND (g.key_prefix IS NULL OR starts_with(a.key, g.key_prefix)) AND (g.suffix IS NULL OR list_contains(g.suffix, a.suffix))
           AND CASE WHEN g.kind IS NULL THEN (a.kind IS NULL OR a.kind NOT IN ('__internal_run__', '__internal_config__'))
             ELSE coalesce(list_contains(g.kind, a.kind), false) END),
       counts AS (SELECT gate_id, count(*) FILTER (WHERE NOT uploading) AS n FROM matches WHERE n <= 20 GROUP BY gate_id)
       SELECT g.gate_id, coalesce(c.n, 0) AS n_ready, g.min_count, CASE WHEN g.min_count NOT BETWEEN 1 AND 20 THEN 'invalid'
         WHEN coalesce(c.n, 0) >= g.min_count THEN 'success' ELSE 'pending' END AS verdict
       FROM gate_criteria g LEFT JOIN counts c ON c.gate_id = g.gate_id""",
)
def g06_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.evaluate_gates(view(spark, sf_dir, "artifact"), view(spark, sf_dir, "gate_criteria"), limit=20)


@named(
    "g07_gate_opened_at", ("write_log",),
    """SELECT sqlrecord_id, table_name, id AS opened_at FROM (SELECT *, row_number() OVER
         (PARTITION BY sqlrecord_id, table_name ORDER BY id) AS n FROM write_log WHERE event_type = 'INSERT') WHERE n = 3""",
)
def g07(spark: SparkSession, sf_dir: str) -> DataFrame:
    inserts = view(spark, sf_dir, "write_log").where(S.col("event_type") == "INSERT")
    return G.gate_opened_at(inserts, ["sqlrecord_id", "table_name"], 3)
