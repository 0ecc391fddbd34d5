"""Table updates, validation, emitted log rows and cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as S

from changelake.operators import apply as A
from changelake.operators import cursors as U
from changelake.operators.query import query
from changelake.plans.filters import F
from changelake.queries import named
from changelake.sources.catalog import Catalog
from changelake.sources.fixtures import table, view
from changelake.sources.schemas import ARTIFACT


def _sql(spark: SparkSession, sf_dir: str, body: str, *tables: str) -> DataFrame:
    """A SELECT over test tables in SQL that both engines read; braces of JSON are doubled in it."""
    return spark.sql(body, **{name: table(spark, sf_dir, name) for name in tables})


def _duck(body: str, *tables: str) -> str:
    return body.format(**{name: name for name in tables})


@named(
    "s01_catalog_from_parquet", (),
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000",
)
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalog.from_parquet(spark, sf_dir, {"core.customer": "customer.parquet"}, log=None)
    found = query(cat, "customer", (F("c_mktsegment") == "BUILDING") & (F("c_acctbal") > 1000), limit=None)
    return found.select("c_custkey", "c_mktsegment")


_NEW = "SELECT concat('n', CAST(s_suppkey AS STRING)) AS uid, s_name AS handle FROM {supplier}"


@named(
    "s03_insert_records", ("app_user",),
    f"""WITH fresh AS ({_duck(_NEW, 'supplier')}) SELECT (SELECT max(id) FROM app_user)
       + row_number() OVER (ORDER BY substr(md5(uid), 1, 4), uid) AS id, uid, handle FROM fresh""",
)
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.insert_records(view(spark, sf_dir, "app_user"), _sql(spark, sf_dir, _NEW, "supplier"))


_PATCHES = """SELECT CASE WHEN doc_id % 10 = 3 THEN concat('zz', CAST(doc_id AS STRING)) ELSE concat('a', CAST(doc_id AS STRING)) END AS uid,
  CASE doc_id % 10 WHEN 0 THEN '{{"kind": null}}' WHEN 1 THEN '{{"size": 7, "description": "x"}}' WHEN 2 THEN '{{"size": "big"}}'
    WHEN 4 THEN '{{"colour": 1}}' WHEN 5 THEN 'broken' ELSE '{{"branch_id": 42}}' END AS patch
  FROM {documents} WHERE doc_id % 10 < 7"""


@named(
    "s04_update_records", ("artifact",),
    """SELECT id, uid, CASE id % 10 WHEN 0 THEN NULL ELSE kind END AS kind, CASE id % 10 WHEN 1 THEN 7 ELSE size END AS size,
         CASE id % 10 WHEN 1 THEN 'x' ELSE description END AS description, CASE id % 10 WHEN 6 THEN 42 ELSE branch_id END AS branch_id
       FROM artifact""",
)
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated, _ = A.update_records(view(spark, sf_dir, "artifact"), _sql(spark, sf_dir, _PATCHES, "documents"))
    return updated.select("id", "uid", "kind", "size", "description", "branch_id")


@named(
    "s04_rejected_updates", (),
    """SELECT CASE WHEN doc_id % 10 = 3 THEN concat('zz', CAST(doc_id AS STRING)) ELSE concat('a', CAST(doc_id AS STRING)) END AS uid,
         CASE doc_id % 10 WHEN 3 THEN 'unknown uid' WHEN 5 THEN 'malformed' ELSE 'field' END AS reason
       FROM documents WHERE doc_id % 10 BETWEEN 2 AND 5""",
)
def s04_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = A.update_records(view(spark, sf_dir, "artifact"), _sql(spark, sf_dir, _PATCHES, "documents"))
    return rejected.select("uid", "reason")


_RAW = """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN concat('{{"id": ', CAST(doc_id AS STRING), ', "key": "', source, '", "n": 1}}')
    WHEN 1 THEN concat('{{"id": "', CAST(doc_id AS STRING), '", "kind": 5}}') WHEN 2 THEN 'not json' WHEN 3 THEN '[1]'
    ELSE concat('{{"id": ', CAST(doc_id AS STRING), ', "key": null}}') END AS value FROM {documents}"""


@named(
    "s05_valid_rows", (),
    f"""SELECT doc_id AS id, CASE doc_id % 6 WHEN 0 THEN source END AS key, CASE doc_id % 6 WHEN 0 THEN 1 ELSE 0 END AS n_extra
       FROM ({_duck(_RAW, 'documents')}) JOIN documents USING (doc_id) WHERE doc_id % 6 IN (0, 4, 5)""",
)
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = A.validate(_sql(spark, sf_dir, _RAW, "documents"), ARTIFACT)
    return good.select("id", "key", S.size("extra").alias("n_extra"))


@named(
    "s05_bad_rows", (),
    f"""SELECT doc_id, value, CASE doc_id % 6 WHEN 1 THEN 'id,kind' ELSE '$' END AS errors FROM ({_duck(_RAW, 'documents')})
       WHERE doc_id % 6 IN (1, 2, 3)""",
)
def s05_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = A.validate(_sql(spark, sf_dir, _RAW, "documents"), ARTIFACT)
    return bad.select("doc_id", "value", S.array_join("errors", ",").alias("errors"))


_CHANGES = """SELECT CASE doc_id % 4 WHEN 0 THEN 'UPDATE' WHEN 1 THEN 'DELETE' ELSE 'INSERT' END AS op,
  CASE WHEN doc_id % 4 < 2 THEN concat('a', CAST(doc_id AS STRING)) ELSE concat('new', CAST(doc_id AS STRING)) END AS uid,
  CASE WHEN doc_id % 4 = 2 THEN 5000000 + doc_id END AS sqlrecord_id,
  CASE doc_id % 4 WHEN 0 THEN '{{"branch_id": 9, "kind": "plan"}}' WHEN 2 THEN '{{"branch_id": 1}}' END AS patch
  FROM {documents} WHERE doc_id % 4 < 3"""


@named(
    "s06_emit_log", ("artifact",),
    f"""WITH changes AS ({_duck(_CHANGES, 'documents')}),
       numbered AS (SELECT *, 10000 + row_number() OVER (ORDER BY substr(md5(uid), 1, 4), uid) AS log_id FROM changes)
       SELECT n.log_id AS id, n.op AS event_type, coalesce(a.id, n.sqlrecord_id) AS sqlrecord_id,
         CASE n.op WHEN 'UPDATE' THEN 9 WHEN 'INSERT' THEN 1 ELSE a.branch_id END AS branch_id,
         CASE n.op WHEN 'UPDATE' THEN 'branch_id,kind' WHEN 'DELETE' THEN '_aux,branch_id,created_by_id,description,id,key,kind,run_id,size,suffix,uid' ELSE '' END AS fields,
         CASE WHEN n.op <> 'INSERT' THEN a.kind END AS previous_kind, CASE WHEN n.op = 'DELETE' THEN a._aux END AS previous_aux
       FROM numbered n LEFT JOIN artifact a ON a.uid = n.uid""",
)
def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _sql(spark, sf_dir, _CHANGES, "documents")
    log = A.emit_log(view(spark, sf_dir, "artifact"), changes, table_name="reg_artifact", start_id=10000)
    fields = S.array_join(S.coalesce(S.sort_array(S.json_object_keys("data")), S.array()), ",")
    return log.select(
        "id", "event_type", "sqlrecord_id", "branch_id", fields.alias("fields"),
        S.get_json_object("data", "$.kind").alias("previous_kind"), S.get_json_object("data", "$._aux").alias("previous_aux"),
    )


# of every forty documents: good updates, inserts with and without a branch, deletes, and one change for each reason to refuse
_MIXED_CHANGES = """SELECT CASE doc_id % 10 WHEN 1 THEN 'INSERT' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'DELETE' ELSE 'UPDATE' END AS op,
  CASE WHEN doc_id % 10 IN (1, 2) THEN concat('new', CAST(doc_id AS STRING)) WHEN doc_id % 10 = 4 THEN concat('lost', CAST(doc_id AS STRING))
    WHEN doc_id % 40 IN (5, 15) THEN concat('a', CAST(doc_id - doc_id % 40 AS STRING)) ELSE concat('a', CAST(doc_id AS STRING)) END AS uid,
  doc_id + 1000000 AS sqlrecord_id, doc_id % 40 AS n,
  CASE doc_id % 10 WHEN 1 THEN '{{"kind": "model", "branch_id": 7}}' WHEN 2 THEN '{{"kind": "model"}}' WHEN 3 THEN NULL WHEN 6 THEN '[1]'
    WHEN 7 THEN '{{"size": "large"}}' WHEN 8 THEN '{{"nothing": 1}}' WHEN 9 THEN '{{"id": 5}}' ELSE '{{"kind": null, "size": 3}}' END AS patch FROM {documents}"""
# a change is refused for the first of these
_REFUSED = """CASE WHEN op <> 'INSERT' AND n % 10 = 4 THEN 'unknown uid' WHEN op = 'UPDATE' AND n IN (0, 5, 15) THEN 'repeated uid'
  WHEN n % 10 = 6 THEN 'malformed' WHEN n % 10 IN (7, 8, 9) THEN 'field' END"""


@named("s06_rejected_changes", (), f"SELECT uid, op, reason FROM (SELECT *, {_REFUSED} AS reason FROM ({_duck(_MIXED_CHANGES, 'documents')})) WHERE reason IS NOT NULL")
def s06_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _sql(spark, sf_dir, _MIXED_CHANGES, "documents")
    return A.rejected_changes(view(spark, sf_dir, "artifact"), changes).select("uid", "op", "reason")


@named(
    "s06_emit_accepted", ("artifact",),
    f"""WITH accepted AS (SELECT * FROM ({_duck(_MIXED_CHANGES, 'documents')}) WHERE {_REFUSED} IS NULL),
       numbered AS (SELECT *, 500 + row_number() OVER (ORDER BY substr(md5(uid), 1, 4), uid) AS log_id FROM accepted)
       SELECT n.log_id AS id, n.op AS event_type, coalesce(a.id, n.sqlrecord_id) AS sqlrecord_id,
         CASE WHEN n.op <> 'INSERT' THEN a.branch_id WHEN n.n % 10 = 1 THEN 7 ELSE 1 END AS branch_id,
         CASE WHEN n.op <> 'INSERT' THEN a.kind END AS previous_kind, CASE WHEN n.op <> 'INSERT' THEN CAST(a.size AS VARCHAR) END AS previous_size
       FROM numbered n LEFT JOIN artifact a ON a.uid = n.uid""",
)
def s06_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _sql(spark, sf_dir, _MIXED_CHANGES, "documents")
    log = A.emit_log(view(spark, sf_dir, "artifact"), changes, table_name="reg_artifact", start_id=500)
    return log.select(
        "id", "event_type", "sqlrecord_id", "branch_id",
        S.get_json_object("data", "$.kind").alias("previous_kind"), S.get_json_object("data", "$.size").alias("previous_size"),
    )


_CURSORS = """SELECT concat('job', CAST(c_custkey % 400 AS STRING)) AS key,
  CASE c_custkey % 7 WHEN 0 THEN 'broken' WHEN 1 THEN concat('{{"dbwrite_id": "', CAST(c_custkey AS STRING), '", "instance_id": "one"}}')
    WHEN 2 THEN concat('{{"dbwrite_id": ', CAST(c_custkey AS STRING), ', "instance_id": "two"}}')
    WHEN 3 THEN concat('{{"dbwrite_id": -', CAST(c_custkey + 1 AS STRING), ', "instance_id": "one"}}')
    ELSE concat('{{"dbwrite_id": ', CAST(c_custkey AS STRING), ', "instance_id": "one"}}') END AS value FROM {customer}"""
_LOADED = """loaded AS (SELECT concat('job', CAST(c_custkey % 400 AS STRING)) AS key, min(c_custkey) AS dbwrite_id FROM customer
  WHERE c_custkey % 7 > 3 GROUP BY ALL)"""


@named("s07_load_cursor", (), f"WITH {_LOADED} SELECT key, dbwrite_id FROM loaded")
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.load_cursor(_sql(spark, sf_dir, _CURSORS, "customer"), "one")


@named(
    "s08_save_cursor", (),
    f"""WITH cursors AS ({_duck(_CURSORS, 'customer')}), saved AS (SELECT concat('job', CAST(s_suppkey * 5 AS STRING)) AS key, 70 + s_suppkey AS position FROM supplier)
       SELECT key, CASE WHEN json_valid(value) THEN json_extract_string(value, '$.dbwrite_id') END AS dbwrite_id FROM cursors
         WHERE key NOT IN (SELECT key FROM saved)
       UNION ALL SELECT key, CAST(position AS STRING) FROM saved""",
)
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    positions = _sql(
        spark, sf_dir,
        "SELECT concat('job', CAST(s_suppkey * 5 AS STRING)) AS key, 70 + s_suppkey AS dbwrite_id FROM {supplier}", "supplier",
    )
    saved = U.save_cursor(_sql(spark, sf_dir, _CURSORS, "customer"), positions, "one")
    return saved.select("key", S.get_json_object("value", "$.dbwrite_id").alias("dbwrite_id"))


@named(
    "s09_start_cursor", ("write_log",),
    f"""WITH {_LOADED}, jobs AS (SELECT concat('job', CAST(p_partkey AS STRING)) AS key FROM part)
       SELECT j.key, coalesce(l.dbwrite_id, (SELECT max(id) FROM write_log)) AS start_id FROM jobs j LEFT JOIN loaded l ON l.key = j.key""",
)
def s09(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = _sql(spark, sf_dir, "SELECT concat('job', CAST(p_partkey AS STRING)) AS key FROM {part}", "part")
    return U.start_cursor(jobs, _sql(spark, sf_dir, _CURSORS, "customer"), view(spark, sf_dir, "write_log"), "one")
