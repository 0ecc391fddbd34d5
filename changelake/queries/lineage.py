"""Lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as S

from changelake.functions import references as R
from changelake.functions.codes import run_status
from changelake.functions.jsoncols import object_keys
from changelake.operators import lineage as L
from changelake.operators import params as P
from changelake.queries import named
from changelake.sources.fixtures import table, view


def _bounded(reference: str) -> str:
    return f"CASE WHEN length({reference}) <= 255 THEN {reference} ELSE substr({reference}, 1, 222) || '~' || substr(sha256({reference}), 1, 32) END"


def _expr(df: DataFrame, **columns: str) -> DataFrame:
    """Derived columns written in SQL both engines read."""
    return df.select("*", *[S.expr(text).alias(name) for name, text in columns.items()])


def _derived(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


_L01 = {
    "dag": "concat('dag', CAST(transform_id AS STRING))",
    "scope": "CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN 'enrich' END",
}


@named(
    "l01_flow_reference", ("run",),
    f"""WITH named AS (SELECT *, {_derived(_L01)} FROM run), joined AS (SELECT id, concat(dag, '/', reference,
         CASE WHEN scope IS NULL OR scope = '' THEN '' ELSE '/' || scope END) AS whole FROM named)
       SELECT id, {_bounded('whole')} AS reference FROM joined""",
)
def l01(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _expr(view(spark, sf_dir, "run"), **_L01)
    return runs.select("id", R.flow_reference(S.col("dag"), S.col("reference"), S.col("scope")).alias("reference"))


_L02 = {
    "url": "CASE run_id % 5 WHEN 0 THEN NULL WHEN 1 THEN repeat('u', 256) WHEN 2 THEN '' ELSE concat('http://host/', CAST(run_id AS STRING)) END",
    "dag": "concat('d', CAST(run_id % 50 AS STRING))",
    "run": "concat('r', CAST(run_id AS STRING), CASE WHEN run_id % 13 = 0 THEN repeat('x', 300) ELSE '' END)",
    "task": "CASE WHEN run_id % 17 = 0 THEN NULL ELSE task_id END",
    "try_number": "CASE WHEN run_id % 3 = 0 THEN NULL ELSE run_id % 3 END",
    "mapped": "CASE WHEN run_id % 2 = 0 THEN NULL ELSE map_index END",
}


@named(
    "l02_task_reference", ("task_state",),
    f"""WITH named AS (SELECT *, {_derived(_L02)} FROM task_state), whole AS (SELECT *, dag || '/' || run || '/' || task || '/'
         || coalesce(CAST(mapped AS STRING), '-1') || '/' || coalesce(CAST(try_number AS STRING), '0') AS parts FROM named)
       SELECT run_id, task_id, CAST(map_index AS BIGINT) AS map_index,
         CASE WHEN length(url) BETWEEN 1 AND 255 THEN url ELSE {_bounded('parts')} END AS reference FROM whole""",
)
def l02(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = _expr(view(spark, sf_dir, "task_state"), **_L02)
    columns = [S.col(name) for name in ("url", "dag", "run", "task", "mapped", "try_number")]
    return tasks.select(
        "run_id", "task_id", S.col("map_index").cast("bigint").alias("map_index"), R.task_reference(*columns).alias("reference")
    )


_L03 = {
    "scope": "CASE p_partkey % 4 WHEN 0 THEN replace(p_brand, '#', '-') WHEN 1 THEN p_brand WHEN 2 THEN repeat('a', p_size * 2) ELSE '' END",
    "dag": "repeat('d', p_size * 3)",
}


@named(
    "l03_valid_scope", (),
    f"""SELECT p_partkey AS id, regexp_full_match(scope, '[A-Za-z0-9_-]{{1,64}}') AND length(dag) + length(scope) + 102 <= 255 AS valid
       FROM (SELECT *, {_derived(_L03)} FROM part)""",
)
def l03(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _expr(table(spark, sf_dir, "part"), **_L03)
    return parts.select(S.col("p_partkey").alias("id"), R.valid_scope(S.col("scope"), S.col("dag")).alias("valid"))


_LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY reference ORDER BY created_at DESC, id DESC) AS newest
    FROM run WHERE branch_id >= 1) WHERE newest = 1)"""


@named("l04_latest_flow_run", ("run",), f"WITH {_LATEST} SELECT reference, id, _status_code FROM latest")
def l04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.latest_flow_run(view(spark, sf_dir, "run")).select("reference", "id", "_status_code")


def _steps_and_flows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    runs = view(spark, sf_dir, "run")
    return runs.select("id", S.col("reference").alias("flow_reference")), L.latest_flow_run(runs)


@named(
    "l05_attach_parents", ("run",),
    f"WITH {_LATEST} SELECT r.id, l.id AS flow_run_id FROM run r LEFT JOIN latest l ON l.reference = r.reference",
)
def l05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.attach_parents(*_steps_and_flows(spark, sf_dir)).select("id", "flow_run_id")


@named(
    "l06_orphan_steps", ("run",),
    f"WITH {_LATEST} SELECT id, reference AS flow_reference FROM run WHERE reference NOT IN (SELECT reference FROM latest)",
)
def l06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.orphan_steps(*_steps_and_flows(spark, sf_dir))


@named(
    "l07_flow_outcome", ("task_state", "scope_member"),
    """SELECT m.run_id, m.scope, CASE WHEN bool_or(coalesce(t.state IN ('failed', 'upstream_failed'), false)) THEN 'errored'
         ELSE 'completed' END AS outcome FROM scope_member m
       LEFT JOIN task_state t ON t.run_id = m.run_id AND t.task_id = m.task_id GROUP BY m.run_id, m.scope""",
)
def l07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.flow_outcome(view(spark, sf_dir, "task_state"), view(spark, sf_dir, "scope_member"))


@named(
    "l07_outcome_of_other_tasks", ("task_state",),
    """SELECT run_id, CASE WHEN bool_or(task_id <> 't1' AND state IN ('failed', 'upstream_failed')) THEN 'errored'
         ELSE 'completed' END AS outcome FROM task_state GROUP BY run_id""",
)
def l07_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.flow_outcome(view(spark, sf_dir, "task_state"), own_task="t1")


@named(
    "l07_reported_scopes", ("task_state", "scope_member", "run"),
    """WITH asked AS (SELECT DISTINCT run_id, scope FROM scope_member UNION SELECT id, 'report' FROM run WHERE id % 3 = 0 UNION SELECT id, '' FROM run),
       failed AS (SELECT DISTINCT m.run_id, m.scope FROM scope_member m JOIN task_state t ON t.run_id = m.run_id AND t.task_id = m.task_id
         WHERE t.state IN ('failed', 'upstream_failed'))
       SELECT a.run_id, a.scope, CASE WHEN f.run_id IS NULL THEN 'completed' ELSE 'errored' END AS outcome
       FROM asked a LEFT JOIN failed f ON f.run_id = a.run_id AND f.scope = a.scope""",
)
def l07_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = view(spark, sf_dir, "run")
    scopes = runs.where("id % 3 = 0").select(S.col("id").alias("run_id"), S.lit("report").alias("scope"))
    scopes = scopes.unionByName(runs.select(S.col("id").alias("run_id"), S.lit("").alias("scope")))
    return L.flow_outcome(view(spark, sf_dir, "task_state"), view(spark, sf_dir, "scope_member"), scopes=scopes)


@named(
    "l08_close_runs", ("run", "task_state"),
    """WITH ends AS (SELECT run_id, CASE WHEN bool_or(state IN ('failed', 'upstream_failed')) THEN 1 ELSE 0 END AS code
         FROM task_state GROUP BY run_id), closed AS (SELECT r.id, coalesce(e.code, r._status_code) AS code,
         e.run_id IS NOT NULL AS finished FROM run r LEFT JOIN ends e ON e.run_id = r.id)
       SELECT id, CASE code WHEN -1 THEN 'started' WHEN 0 THEN 'completed' WHEN 1 THEN 'errored' END AS status, finished FROM closed""",
)
def l08(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = L.flow_outcome(view(spark, sf_dir, "task_state"))
    closed = L.close_runs(view(spark, sf_dir, "run"), outcomes)
    return closed.select(
        "id", run_status(S.col("_status_code")).alias("status"), S.col("finished_at").isNotNull().alias("finished")
    )


# starts of flow runs: every second newest run's reference again, or a new one next to it
_STARTS = """starts AS (SELECT id + 1000000000 AS id, CASE WHEN id % 4 = 0 THEN reference ELSE concat(reference, '#new') END AS reference,
  created_at + INTERVAL 1 DAY AS started_at, CASE WHEN id % 5 = 0 THEN CAST(3 AS BIGINT) END AS space_id,
  CASE WHEN id % 16 = 0 THEN CAST(77 AS BIGINT) WHEN id % 8 = 0 THEN branch_id END AS branch_id FROM {latest} WHERE id % 2 = 0)"""


def _starts(spark: SparkSession, runs: DataFrame) -> DataFrame:
    body = _STARTS[len("starts AS (") : -1].format(latest="{latest}")
    return spark.sql(body, latest=L.latest_flow_run(runs))


_MATCHED = f"""{_LATEST}, {_STARTS.format(latest='latest')},
  matched AS (SELECT s.*, l.id AS run_id, s.space_id IS NOT NULL AND s.space_id IS DISTINCT FROM l.space_id AS space_conflict,
    s.branch_id IS NOT NULL AND s.branch_id IS DISTINCT FROM l.branch_id AS branch_conflict
    FROM starts s LEFT JOIN latest l ON l.reference = s.reference)"""


@named(
    "l09_apply_attempts", ("run",),
    f"""WITH {_MATCHED}, again AS (SELECT * FROM matched WHERE run_id IS NOT NULL AND NOT space_conflict AND NOT branch_conflict)
       SELECT r.id, r.reference, CASE WHEN a.id IS NULL THEN r._status_code ELSE -2 END AS _status_code, a.id IS NOT NULL AS started
       FROM run r LEFT JOIN again a ON a.run_id = r.id
       UNION ALL SELECT id, reference, -1, true FROM matched WHERE run_id IS NULL""",
)
def l09(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = view(spark, sf_dir, "run")
    after = L.apply_attempts(runs, _starts(spark, runs))
    return after.select("id", "reference", "_status_code", S.col("started_at").isNotNull().alias("started"))


@named(
    "l10_restart_conflicts", ("run",),
    f"""WITH {_MATCHED} SELECT reference, run_id, space_conflict, branch_conflict FROM matched
       WHERE run_id IS NOT NULL AND (space_conflict OR branch_conflict)""",
)
def l10(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = view(spark, sf_dir, "run")
    return L.restart_conflicts(runs, _starts(spark, runs))


@named(
    "l11_inherit_scope", ("run",),
    """SELECT r.id, coalesce(r.space_id, CASE WHEN f.space_id <> 1 THEN f.space_id END) AS effective_space_id,
         coalesce(CASE WHEN r.id % 4 <> 1 THEN r.branch_id END, CASE WHEN f.branch_id <> 1 THEN f.branch_id END) AS effective_branch_id
       FROM run r LEFT JOIN run f ON f.id = r.initiated_by_run_id""",
)
def l11(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = view(spark, sf_dir, "run")
    steps = runs.withColumn("branch_id", S.when(S.col("id") % 4 != 1, S.col("branch_id")))
    return L.inherit_scope(steps, runs).select("id", "effective_space_id", "effective_branch_id")


@named("l12_invalid_branch_runs", ("run",), "SELECT id, branch_id FROM run WHERE branch_id < 1")
def l12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.invalid_branch_runs(view(spark, sf_dir, "run")).select("id", "branch_id")


@named(
    "l13_version_transforms", ("source_obs",),
    """WITH firsts AS (SELECT source, min(obs) AS seen, arg_min(key, obs) AS transform_key FROM source_obs GROUP BY source),
       versions AS (SELECT *, row_number() OVER (PARTITION BY transform_key ORDER BY seen) AS version,
         seen = max(seen) OVER (PARTITION BY transform_key) AS is_latest FROM firsts)
       SELECT o.obs, v.transform_key, v.version, v.is_latest FROM source_obs o JOIN versions v ON v.source = o.source""",
)
def l13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.version_transforms(view(spark, sf_dir, "source_obs"))


_L14 = {
    "path": "concat('/data/', key)",
    "root": "CASE id % 4 WHEN 0 THEN '/data' WHEN 1 THEN '/data/' WHEN 2 THEN '/dat' ELSE NULL END",
}


@named(
    "l14_transform_key", ("artifact",),
    f"""SELECT id, CASE WHEN root IN ('/data', '/data/') THEN substr(path, 7) ELSE regexp_extract(path, '[^/]*$') END AS transform_key
       FROM (SELECT *, {_derived(_L14)} FROM artifact)""",
)
def l14(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _expr(view(spark, sf_dir, "artifact"), **_L14)
    return files.select("id", R.transform_key(S.col("path"), S.col("root")).alias("transform_key"))


@named(
    "l15_scope_boundary", ("scope_member", "task_edge"),
    """SELECT m.run_id, m.scope, m.task_id,
         NOT EXISTS (SELECT 1 FROM task_edge e JOIN scope_member u ON u.run_id = e.run_id AND u.task_id = e.upstream
           WHERE e.run_id = m.run_id AND e.downstream = m.task_id AND u.scope = m.scope) AS is_root,
         NOT EXISTS (SELECT 1 FROM task_edge e JOIN scope_member d ON d.run_id = e.run_id AND d.task_id = e.downstream
           WHERE e.run_id = m.run_id AND e.upstream = m.task_id AND d.scope = m.scope) AS is_leaf
       FROM scope_member m""",
)
def l15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.scope_boundary(view(spark, sf_dir, "scope_member"), view(spark, sf_dir, "task_edge"))


_SCOPES = "SELECT concat('dag', CAST(o_custkey AS STRING)) AS dag_id, o_orderpriority AS scope FROM {orders}"


@named(
    "l16_scope_conflicts", (),
    f"""WITH scopes AS ({_SCOPES.format(orders='orders')}), used AS (SELECT DISTINCT * FROM ({_SCOPES.format(orders='orders')} WHERE o_orderkey % 7 <> 0))
       SELECT dag_id, scope, 'duplicate' AS problem FROM scopes GROUP BY dag_id, scope HAVING count(*) > 1
       UNION ALL SELECT DISTINCT s.dag_id, s.scope, 'empty' FROM scopes s
         WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.dag_id = s.dag_id AND u.scope = s.scope)""",
)
def l16(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    scopes = spark.sql(_SCOPES, orders=orders)
    return L.scope_conflicts(scopes, spark.sql(_SCOPES + " WHERE o_orderkey % 7 <> 0", orders=orders))


def _member(name: str) -> Column:
    return S.get_json_object("params", f"$.{name}").alias(name)


@named(
    "l17_exclude_params", ("run",),
    "SELECT id, json_extract_string(params, '$.sample') AS sample, CAST(NULL AS STRING) AS token, json_extract_string(params, '$.price') AS price FROM run",
)
def l17(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = P.exclude_params(view(spark, sf_dir, "run"), ["token", "other"])
    return kept.select("id", _member("sample"), _member("token"), _member("price"))


@named(
    "l18_exclude_templated", ("run",),
    """SELECT id, CASE WHEN contains(params, '{{ var') THEN 'price,sample' ELSE 'price,sample,token' END AS without_secrets,
         CASE WHEN contains(params, '{{') THEN 'price,sample' ELSE 'price,sample,token' END AS without_any FROM run""",
)
def l18(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = view(spark, sf_dir, "run").select("id", "params", S.col("params").alias("again"))
    kept = P.exclude_templated(P.exclude_templated(runs, "secrets"), "all", "again")
    return kept.select(
        "id",
        S.array_join(object_keys(S.col("params")), ",").alias("without_secrets"),
        S.array_join(object_keys(S.col("again")), ",").alias("without_any"),
    )


_SECRETS = """SELECT DISTINCT CASE WHEN s_suppkey % 2 = 0 THEN concat('S', CAST(s_suppkey % 7 AS STRING))
  ELSE CAST(s_suppkey * 37 + 1000 AS STRING) END AS secret FROM {supplier}"""


@named(
    "l19_exclude_masked", ("run",),
    f"""WITH secrets AS ({_SECRETS.format(supplier='supplier')}), parts AS (SELECT id, unnest(['sample', 'token', 'price']) AS name, params FROM run),
       kept AS (SELECT id, name FROM parts p WHERE NOT EXISTS (SELECT 1 FROM secrets s
         WHERE contains(json_extract_string(p.params, '$.' || p.name), s.secret)))
       SELECT r.id, coalesce(string_agg(k.name, ',' ORDER BY k.name), '') AS names FROM run r LEFT JOIN kept k ON k.id = r.id GROUP BY r.id""",
)
def l19(spark: SparkSession, sf_dir: str) -> DataFrame:
    secrets = spark.sql(_SECRETS, supplier=table(spark, sf_dir, "supplier"))
    kept = P.exclude_masked(view(spark, sf_dir, "run"), secrets)
    return kept.select("id", S.array_join(object_keys(S.col("params")), ",").alias("names"))


@named(
    "l18_template_syntax", ("template_run",),
    """SELECT id, CASE WHEN id % 16 < 6 THEN 'n' ELSE 'a,n' END AS without_secrets, CASE WHEN id % 16 < 10 THEN 'n' ELSE 'a,n' END AS without_any
       FROM template_run""",
)
def l18_syntax(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = view(spark, sf_dir, "template_run").select("id", "params", S.col("params").alias("again"))
    kept = P.exclude_templated(P.exclude_templated(runs, "secrets"), "all", "again")
    return kept.select(
        "id",
        S.array_join(object_keys(S.col("params")), ",").alias("without_secrets"),
        S.array_join(object_keys(S.col("again")), ",").alias("without_any"),
    )


_NESTED_SECRETS = """SELECT DISTINCT CASE s_suppkey % 4 WHEN 0 THEN concat('tok-', CAST(s_suppkey % 500 AS STRING), '-z')
  WHEN 1 THEN concat('"', CAST(s_suppkey % 40 AS STRING), '"') WHEN 2 THEN '1-URGENT' ELSE CAST(s_suppkey % 90 + 100 AS STRING) END AS secret FROM {supplier}"""


@named(
    "l19_nested_secrets", ("secret_run",),
    f"""WITH secrets AS ({_NESTED_SECRETS.format(supplier='supplier')}), texts AS (SELECT id, CAST(json_extract(params, '$.a') AS VARCHAR) AS a FROM secret_run),
       hit AS (SELECT DISTINCT id FROM texts t WHERE EXISTS (SELECT 1 FROM secrets s
         WHERE contains(t.a, s.secret) OR contains(t.a, replace(s.secret, '"', '\\"'))))
       SELECT t.id, CASE WHEN h.id IS NULL THEN 'a,b' ELSE 'b' END AS names FROM texts t LEFT JOIN hit h ON h.id = t.id""",
)
def l19_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    secrets = spark.sql(_NESTED_SECRETS, supplier=table(spark, sf_dir, "supplier"))
    kept = P.exclude_masked(view(spark, sf_dir, "secret_run"), secrets)
    return kept.select("id", S.array_join(object_keys(S.col("params")), ",").alias("names"))


_L20 = {
    "dag_id": "concat('dag', CAST(transform_id AS STRING))",
    "run_id": "uid",
    "run_type": "CASE WHEN id % 3 = 0 THEN NULL ELSE 'manual' END",
    "conf": "CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN '{}' ELSE params END",
}


@named(
    "l20_flow_params", ("run",),
    f"""SELECT id, 'conf' AS last_key, dag_id, run_type, CASE WHEN conf <> '{{}}' THEN json_extract_string(conf, '$.sample') END AS sample,
         2 + CASE WHEN run_type IS NULL THEN 0 ELSE 1 END + CASE WHEN conf IS NULL OR conf = '{{}}' THEN 0 ELSE 1 END AS n_fields
       FROM (SELECT id, params, {_derived(_L20)} FROM run)""",
)
def l20(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _expr(view(spark, sf_dir, "run").select("id", "uid", "params", "transform_id"), **_L20)
    recorded = P.flow_params(runs, "recorded")
    return recorded.select(
        "id", S.lit("conf").alias("last_key"),
        S.get_json_object("recorded", "$.dag_id").alias("dag_id"), S.get_json_object("recorded", "$.run_type").alias("run_type"),
        S.get_json_object("recorded", "$.conf.sample").alias("sample"), S.size(object_keys(S.col("recorded"))).alias("n_fields"),
    )


_L21 = {"instance": "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'lab/other' ELSE 'lab/main' END"}


@named(
    "l21_instance_mismatches", ("run",),
    f"""WITH placed AS (SELECT *, {_derived(_L21)} FROM run) SELECT s.id, s.instance, f.instance AS flow_instance
       FROM placed s JOIN placed f ON f.id = s.initiated_by_run_id WHERE s.instance <> f.instance""",
)
def l21(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _expr(view(spark, sf_dir, "run"), **_L21)
    return L.instance_mismatches(runs, runs).select("id", "instance", "flow_instance")


_L22 = {
    "version": "CASE id % 9 WHEN 7 THEN 'unknown' WHEN 8 THEN '' ELSE concat(CAST(id % 4 AS STRING), '.', CAST(id % 13 AS STRING), CASE id % 3 WHEN 0 THEN concat('.', CAST(id % 5 AS STRING)) WHEN 1 THEN '' ELSE '.1a3' END) END"
}


@named(
    "l22_version_at_least", ("run",),
    rf"""SELECT id, coalesce(regexp_matches(version, '^\d+\.\d+') AND
         (CAST(major AS BIGINT), CAST(minor AS BIGINT), CAST(coalesce(nullif(patch, ''), '0') AS BIGINT)) >= (2, 8, 1), false) AS supported
       FROM (SELECT *, nullif(regexp_extract(version, '^(\d+)\.(\d+)', 1), '') AS major, nullif(regexp_extract(version, '^(\d+)\.(\d+)', 2), '') AS minor,
         regexp_extract(version, '^\d+\.\d+\.(\d+)', 1) AS patch FROM (SELECT *, {_derived(_L22)} FROM run))""",
)
def l22(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _expr(view(spark, sf_dir, "run"), **_L22)
    return runs.select("id", R.version_at_least(S.col("version"), "2.8.1").alias("supported"))


@named(
    "l23_flow_report", ("run",),
    """SELECT f.id AS flow_run_id, f.reference, CASE f._status_code WHEN -1 THEN 'started' WHEN 0 THEN 'completed' WHEN 1 THEN 'errored' END AS status,
         count(s.id) AS n_steps, count(*) FILTER (WHERE s._status_code = 0) AS n_completed,
         count(*) FILTER (WHERE s._status_code = 1) AS n_errored, count(*) FILTER (WHERE s._status_code < 0) AS n_open
       FROM run f LEFT JOIN run s ON s.initiated_by_run_id = f.id WHERE f.initiated_by_run_id IS NULL
       GROUP BY f.id, f.reference, f._status_code""",
)
def l23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.flow_report(view(spark, sf_dir, "run"))
