"""The test tables shaped into the engine's inputs: write log, registries, runs and task states.

``VIEWS`` holds one SELECT per input over the tables of ``TESTDATA.md``, in SQL that Spark and DuckDB share
(``duckdb_sql`` spells the one string escape that differs).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.plans.segments import numbered, span_of
from changelake.sources.catalog import Catalog, Registry, Relation
from changelake.sources.readers import table_reader

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "write_log": r"""
SELECT event_id+1 AS id, concat('w',CAST(event_id+1 AS STRING)) AS uid,
  CASE WHEN event_type IN ('signup','click') THEN 'INSERT' WHEN event_type IN ('view','purchase') THEN 'UPDATE' ELSE 'DELETE' END AS event_type,
  CASE event_id%3 WHEN 0 THEN 'reg_artifact' WHEN 1 THEN 'reg_branch' ELSE 'reg_branchblock' END AS table_name,
  CASE WHEN event_id%3=1 THEN user_id%20 ELSE user_id END AS sqlrecord_id, ts AS created_at,
  CASE WHEN event_id%11=0 THEN NULL ELSE user_id END AS created_by_id,
  CASE event_id%7 WHEN 0 THEN CAST(-1 AS BIGINT) WHEN 1 THEN CAST(42 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS branch_id,
  CAST(1 AS BIGINT) AS space_id, CAST(NULL AS BIGINT) AS run_id,
  CASE WHEN event_type IN ('signup','click') THEN NULL
    WHEN event_type='error' THEN concat('{"id": ',CAST(user_id AS STRING),', "key": "src',CAST(user_id%20 AS STRING),'/x.csv", "kind": "dataset", "branch_id": ',CASE WHEN event_id%2=0 THEN '1' ELSE '-1' END,'}')
    WHEN event_id%5=0 THEN '{"branch_id": 42}' WHEN event_id%5=1 THEN '{"branch_id": 1}'
    WHEN event_id%5=2 THEN '{"key": "old", "size": 1}' WHEN event_id%5=3 THEN '{"_aux": "{\\"so\\": 1}"}'
    ELSE concat('{"_status_code": ',CAST((event_id*7+user_id)%5-2 AS STRING),'}') END AS data
FROM events""",
    "artifact": """
SELECT doc_id AS id, concat('a',CAST(doc_id AS STRING)) AS uid, concat(source,'/',CAST(doc_id AS STRING),CASE doc_id%3 WHEN 0 THEN '.csv' WHEN 1 THEN '.parquet' ELSE '.txt' END) AS key,
  CASE doc_id%3 WHEN 0 THEN '.csv' WHEN 1 THEN '.parquet' ELSE '.txt' END AS suffix,
  CASE doc_id%5 WHEN 0 THEN NULL WHEN 1 THEN '__internal_run__' WHEN 2 THEN 'model' ELSE 'dataset' END AS kind, lang AS description, n_chars AS size,
  CASE doc_id%7 WHEN 0 THEN CAST(-1 AS BIGINT) WHEN 1 THEN CAST(42 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS branch_id, doc_id%100 AS created_by_id, doc_id%500 AS run_id,
  CASE doc_id%8 WHEN 0 THEN '{"so": 1}' WHEN 1 THEN '{"so": true}' WHEN 2 THEN '{"so": "1"}' WHEN 3 THEN 'not json' ELSE NULL END AS _aux
FROM documents""",
    "branch": """
SELECT CAST(s_suppkey AS BIGINT) AS id, concat('b',CAST(s_suppkey AS STRING)) AS uid, CASE s_suppkey%3 WHEN 0 THEN concat('release-',CAST(s_suppkey AS STRING)) WHEN 1 THEN concat('fix-',CAST(s_suppkey AS STRING)) ELSE s_name END AS name,
  CAST(NULL AS STRING) AS description, CAST(s_suppkey%5-2 AS INT) AS _status_code, CAST(s_nationkey AS BIGINT) AS created_by_id
FROM supplier WHERE s_suppkey%10<>9""",
    "branchblock": """
SELECT CAST(row_number() OVER (ORDER BY conv_id,turn)-1 AS BIGINT) AS id, conv_id%20 AS branch_id, CASE WHEN role='system' THEN 'readme' ELSE 'comment' END AS kind, text AS content FROM conversations""",
    "app_user": """
SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS handle, c_mktsegment AS name FROM customer WHERE c_custkey%10<>3""",
    "run": """
SELECT o_orderkey AS id, concat('r',CAST(o_orderkey AS STRING)) AS uid, o_custkey AS created_by_id, o_orderkey%50 AS transform_id,
  CASE WHEN o_orderkey%4=0 THEN NULL ELSE o_orderkey-o_orderkey%4 END AS initiated_by_run_id,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS _status_code, o_orderdate AS created_at,
  concat('dag',CAST(o_orderkey%50 AS STRING),'/',o_orderpriority,CASE WHEN o_orderkey%13=0 THEN repeat('x',300) ELSE '' END) AS reference,
  CASE o_orderkey%6 WHEN 0 THEN CAST(-1 AS BIGINT) WHEN 1 THEN CAST(42 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS branch_id, CASE o_orderkey%3 WHEN 0 THEN CAST(1 AS BIGINT) WHEN 1 THEN CAST(2 AS BIGINT) ELSE NULL END AS space_id,
  concat('{"sample": "S',CAST(o_orderkey%9 AS STRING),'", "token": "',CASE WHEN o_orderkey%4=1 THEN '{{ var.value.t }}' WHEN o_orderkey%4=2 THEN '{{ ds }}' ELSE 'plain' END,'", "price": ',CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING),'}') AS params
FROM orders""",
    "run_input": """
SELECT DISTINCT l_orderkey AS run_id, l_partkey AS artifact_id FROM lineitem""",
    "task_state": """
SELECT l_orderkey AS run_id, concat('t',CAST(l_linenumber AS STRING)) AS task_id, row_number() OVER (PARTITION BY l_orderkey,l_linenumber ORDER BY l_partkey,l_suppkey,l_quantity,l_extendedprice,l_shipdate)-1 AS map_index,
  CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN 'failed' WHEN l_returnflag='R' THEN 'upstream_failed' WHEN l_returnflag='A' THEN 'skipped' ELSE 'success' END AS state
FROM lineitem""",
    "scope_member": """
SELECT DISTINCT l_orderkey AS run_id, CASE WHEN l_linenumber<=3 THEN '' ELSE 'enrich' END AS scope, concat('t',CAST(l_linenumber AS STRING)) AS task_id FROM lineitem WHERE l_linenumber<>7""",
    "task_edge": """
SELECT DISTINCT a.l_orderkey AS run_id, concat('t',CAST(a.l_linenumber AS STRING)) AS upstream, concat('t',CAST(b.l_linenumber AS STRING)) AS downstream FROM lineitem a JOIN lineitem b ON a.l_orderkey=b.l_orderkey AND b.l_linenumber=a.l_linenumber+1""",
    "source_obs": """
SELECT conv_id*1000+turn AS obs, concat('dags/',CAST(conv_id%40 AS STRING),'.py') AS key, concat('# v',CAST((conv_id*turn)%150 AS STRING)) AS source FROM conversations""",
    "gate": """
SELECT CAST(p_partkey AS BIGINT) AS gate_id, CAST(p_partkey%100 AS BIGINT) AS branch_id_ref, concat('src',CAST(p_partkey%25 AS STRING),'/') AS key_prefix, CASE p_partkey%3 WHEN 0 THEN '.csv' WHEN 1 THEN '.parquet' ELSE '.txt' END AS suffix, CAST(p_size%5+1 AS INT) AS min_count FROM part""",
    "gate_criteria": """
SELECT CAST(p_partkey AS BIGINT) AS gate_id, CASE WHEN p_partkey%4=0 THEN concat(source,'/',CAST(doc_id AS STRING),CASE doc_id%3 WHEN 0 THEN '.csv' WHEN 1 THEN '.parquet' ELSE '.txt' END) END AS key,
  CASE WHEN p_partkey%3<>0 THEN concat('src',CAST(p_partkey%20 AS STRING)) END AS key_prefix,
  CASE p_partkey%3 WHEN 0 THEN array('.txt','.csv') WHEN 1 THEN array('.parquet') END AS suffix,
  CASE p_partkey%5 WHEN 0 THEN array('model','dataset','model') WHEN 1 THEN array('__internal_run__') END AS kind,
  CASE p_partkey%6 WHEN 0 THEN CAST(42 AS BIGINT) WHEN 1 THEN CAST(-1 AS BIGINT) END AS branch_id, CAST(p_partkey%30 AS INT) AS min_count
FROM part LEFT JOIN documents ON doc_id=p_partkey%200""",
    "subscription": """
SELECT CAST(p_partkey AS BIGINT) AS sub_id, CASE p_partkey%3 WHEN 0 THEN 'reg_artifact' WHEN 1 THEN 'reg_branch' ELSE 'reg_branchblock' END AS table_name, CASE WHEN p_partkey%4=0 THEN 'created' WHEN p_partkey%4=1 THEN 'updated' ELSE 'deleted' END AS event, CASE WHEN p_partkey%5=0 THEN NULL WHEN p_partkey%5=1 THEN CAST(42 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS branch_id FROM part""",
    "watcher": """
SELECT CAST(p_partkey AS BIGINT) AS sub_id, CASE p_partkey%3 WHEN 0 THEN 'reg_artifact' WHEN 1 THEN 'reg_branch' ELSE 'reg_branchblock' END AS table_name,
  CASE p_partkey%4 WHEN 0 THEN array('created') WHEN 1 THEN array('created','updated') WHEN 2 THEN array('deleted','updated') ELSE array('updated','deleted','created') END AS events,
  CASE p_partkey%5 WHEN 0 THEN NULL WHEN 1 THEN CAST(42 AS BIGINT) WHEN 2 THEN CAST(-1 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS branch_id,
  CASE p_partkey%7 WHEN 0 THEN array('key','size') WHEN 1 THEN array('_aux','key') WHEN 2 THEN array('branch_id') ELSE NULL END AS changed_fields,
  CASE WHEN p_partkey%2=0 THEN CAST(p_partkey%11*83 AS BIGINT) ELSE NULL END AS start_id FROM part""",
    "template_run": r"""
SELECT o_orderkey AS id, concat('{"a": ', CASE o_orderkey%16
  WHEN 0 THEN '"{{ {''a'': {''b'': 1}} and var.value.t }}"' WHEN 1 THEN '"{{ ''}}'' ~ var.value.t }}"' WHEN 2 THEN '"{% if ''%}'' and conn.x %}y{% endif %}"'
  WHEN 3 THEN '"{{ \\"a}}\\" ~ conn.y }}"' WHEN 4 THEN '{"deep": ["x", {"k": "{{ f(1, var) }}"}]}' WHEN 5 THEN '["{# note #}{{ conn }}"]'
  WHEN 6 THEN '"{{ ''var'' }}"' WHEN 7 THEN '"{{ x.var ~ y|conn }}"' WHEN 8 THEN '"{{ f(var=1) }}"' WHEN 9 THEN '["{{ ds }} var", "conn"]'
  WHEN 10 THEN '"{# {{ var }} #}"' WHEN 11 THEN '"{% raw %}{{ var }}{% endraw %}"' WHEN 12 THEN '"{{ var"' WHEN 13 THEN '"{{ {''k'': var }}"'
  WHEN 14 THEN '{"{{ var }}": "key"}' ELSE concat('"', o_orderpriority, '"') END, ', "n": ', CAST(o_orderkey AS STRING), '}') AS params
FROM orders""",
    "secret_run": r"""
SELECT o_orderkey AS id, concat('{"a": ', CASE o_orderkey%6 WHEN 0 THEN concat('{"k": ["x", "<tok-', CAST(o_orderkey%500 AS STRING), '-z>"]}')
  WHEN 1 THEN concat('"q\\"', CAST(o_orderkey%40 AS STRING), '\\"q"') WHEN 2 THEN concat('[[["', o_orderpriority, '"]], {"tok-', CAST(o_orderkey%500 AS STRING), '-z": 1}]')
  WHEN 3 THEN CAST(o_custkey AS STRING) WHEN 4 THEN 'null' ELSE concat('"', repeat('padding ', 200), 'tok-', CAST(o_orderkey%50 AS STRING), '-z"') END,
  ', "b": "', o_orderstatus, '"}') AS params, o_custkey
FROM orders""",
}

_SOURCE = {
    "write_log": ["events"], "artifact": ["documents"], "branch": ["supplier"], "branchblock": ["conversations"],
    "app_user": ["customer"], "run": ["orders"], "run_input": ["lineitem"], "task_state": ["lineitem"],
    "scope_member": ["lineitem"], "task_edge": ["lineitem"], "source_obs": ["conversations"], "gate": ["part"],
    "subscription": ["part"], "watcher": ["part"], "template_run": ["orders"], "gate_criteria": ["part", "documents"], "secret_run": ["orders"],
}

_RELATIONS = {
    "artifact": {
        "created_by": Relation("core.user", "created_by_id"),
        "run": Relation("core.run", "run_id"),
        "branch": Relation("core.branch", "branch_id"),
    },
    "branch": {"created_by": Relation("core.user", "created_by_id")},
    "branchblock": {"branch": Relation("core.branch", "branch_id")},
    "run": {
        "created_by": Relation("core.user", "created_by_id"),
        "initiated_by_run": Relation("core.run", "initiated_by_run_id"),
        "input_artifacts": Relation("core.artifact", "run_id", link="run_input", target_column="artifact_id"),
        "artifacts": Relation("core.artifact", "run_id", many=True),
    },
    "user": {"created_runs": Relation("core.run", "created_by_id", many=True)},
}
_VIEW_OF = {"artifact": "artifact", "branch": "branch", "branchblock": "branchblock", "user": "app_user", "run": "run"}
_JSON_FIELDS = {"artifact": frozenset(), "run": frozenset()}


def duckdb_sql(view: str) -> str:
    """The SELECT of a view in DuckDB's spelling."""
    return VIEWS[view].strip().replace('\\\\"', '\\"').replace("array(", "list_value(")


def with_views(*views: str) -> str:
    """A ``WITH`` clause that defines the views for a query in DuckDB."""
    return "WITH " + ",\n".join(f"{view} AS (\n{duckdb_sql(view)}\n)" for view in views) + "\n"


@cache
def _reader(spark: SparkSession, path: str) -> Callable[[], DataFrame]:
    return table_reader(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return _reader(spark, f"{sf_dir}/{name}.parquet")()


_PREPARED: dict[tuple[str, str], str] = {}


def prepare(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write all inputs of a folder of test tables once; from then on they are read from there."""
    for name in VIEWS:
        view(spark, sf_dir, name).write.mode("overwrite").parquet(f"{folder}/{name}")
        _PREPARED[sf_dir, name] = f"{folder}/{name}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input as a DataFrame."""
    if (sf_dir, name) in _PREPARED:
        return _reader(spark, _PREPARED[sf_dir, name])()
    if name == "branchblock":  # the same numbers as the view's, without sorting the whole table in one task
        talk = table(spark, sf_dir, "conversations")
        rows = numbered(talk, [], ["conv_id", "turn"], "__n", span_of(F.col("conv_id"), 10_000))
        kind = F.when(F.col("role") == "system", "readme").otherwise("comment")
        return rows.select(
            (F.col("__n") - 1).alias("id"), (F.col("conv_id") % 20).alias("branch_id"), kind.alias("kind"),
            F.col("text").alias("content"),
        )
    return view_over(spark, name, {source: table(spark, sf_dir, source) for source in _SOURCE[name]})


def view_over(spark: SparkSession, name: str, sources: dict[str, DataFrame]) -> DataFrame:
    """A view over given tables, which may be streams."""
    sql = VIEWS[name].replace("{", "{{").replace("}", "}}")  # braces of JSON texts are no parameters
    for source in sources:
        sql = sql.replace(f"FROM {source}", f"FROM {{{source}}}").replace(f"JOIN {source}", f"JOIN {{{source}}}")
    return spark.sql(sql, **sources)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The test catalog: five registries, the link table of run inputs, and the write log."""

    def loader(name: str):
        return lambda: view(spark, sf_dir, name)

    return Catalog(
        [
            Registry(
                f"core.{model}", f"reg_{model}", loader(name), _RELATIONS[model], _JSON_FIELDS.get(model, frozenset())
            )
            for model, name in _VIEW_OF.items()
        ],
        loader("write_log"),
        {"run_input": loader("run_input")},
    )
