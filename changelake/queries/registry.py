"""Registry queries: filters, projections, sorting, look-ups."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as S

from changelake.functions.codes import is_internal
from changelake.functions.jsoncols import upload_ongoing
from changelake.operators import query as Q
from changelake.operators.changes import filter_deleted
from changelake.operators.indexes import search_postings, text_postings, write_postings
from changelake.plans.filters import F, FilterExpression
from changelake.queries import named
from changelake.sources.catalog import Catalog, Registry
from changelake.sources.fixtures import catalog, table, view
from changelake.sources.readers import scratch_dir


def _ids(spark: SparkSession, sf_dir: str, registry: str, filter: FilterExpression, *columns: str) -> DataFrame:
    return Q.query(catalog(spark, sf_dir), registry, filter, limit=None).select("id", *columns)


def _filter(name: str, registry: str, source: str, filter: FilterExpression, where: str, *columns: str, views=()) -> None:
    """A query that returns the ids (and columns) of the records matching a filter."""
    picked = ", ".join(["id", *columns])

    @named(name, (source, *views), f"SELECT {picked} FROM {source} WHERE {where}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _ids(spark, sf_dir, registry, filter, *columns)


_filter(
    "q01_equal", "artifact", "artifact", (F("suffix") == ".csv") | (F("kind") == None),  # noqa: E711
    "suffix = '.csv' OR kind IS NULL", "suffix", "kind",
)
_filter(
    "q02_compare", "run", "run",
    (F("created_at") >= dt.date(1995, 6, 1)) & (F("created_by_id") < 700) & (F("initiated_by_run_id") > 8),
    "created_at >= TIMESTAMP '1995-06-01' AND created_by_id < 700 AND initiated_by_run_id > 8", "created_by_id",
)
_filter("q03_range", "artifact", "artifact", (F("size") >= 100) & (F("size") < 1500), "size >= 100 AND size < 1500", "size")
_filter("q04_not_equal", "artifact", "artifact", F("kind") != "dataset", "kind IS DISTINCT FROM 'dataset'", "kind")
_filter(
    "q05_in", "artifact", "artifact", F("suffix").is_in({".txt", ".csv"}) | F("kind").is_in([]),
    "suffix IN ('.txt', '.csv')", "suffix",
)
_filter(
    "q06_not_in", "artifact", "artifact", F("kind").not_in(["dataset", "plan"]), "kind NOT IN ('dataset', 'plan')", "kind"
)
_filter(
    "q07_is_null", "run", "run", F("space_id").is_null() & F("initiated_by_run_id").is_not_null(),
    "space_id IS NULL AND initiated_by_run_id IS NOT NULL",
)
_filter("q08_startswith", "artifact", "artifact", F("key").startswith("src1"), "starts_with(key, 'src1')", "key")
_filter("q09_endswith", "artifact", "artifact", F("key").endswith("7.csv"), "ends_with(key, '7.csv')", "key")
_filter("q10_contains", "run", "run", F("reference").contains("1/2-H"), "contains(reference, '1/2-H')")
_filter(
    "q12_and", "run", "run", (F("branch_id") == 1) & (F("_status_code") == 0) & (F("space_id") == 2),
    "branch_id = 1 AND _status_code = 0 AND space_id = 2",
)
_filter(
    "q13_or", "run", "run", (F("branch_id") == 42) | ((F("_status_code") == -1) & (F("space_id") == 1)),
    "branch_id = 42 OR (_status_code = -1 AND space_id = 1)",
)
_filter(
    "q15_json_path", "run", "run", (F("params")["price"] > 150_000) & (F("params")["sample"] == "S3"),
    "CAST(json_extract(params, '$.price') AS DOUBLE) > 150000 AND json_extract_string(params, '$.sample') = 'S3'",
)
_filter(
    "q16_to_one_path", "run", "run",
    (F("created_by", "name") == "BUILDING") | (F("initiated_by_run", "created_by", "handle").endswith("7")),
    """EXISTS (SELECT 1 FROM app_user u WHERE u.id = run.created_by_id AND u.name = 'BUILDING')
       OR EXISTS (SELECT 1 FROM run p JOIN app_user u ON u.id = p.created_by_id
                  WHERE p.id = run.initiated_by_run_id AND ends_with(u.handle, '7'))""",
    views=("app_user",),
)
_filter(
    "q17_to_many_path", "run", "run", (F("input_artifacts", "suffix") == ".csv") & (F("branch_id") == 1),
    """branch_id = 1 AND EXISTS (SELECT 1 FROM run_input i JOIN artifact a ON a.id = i.artifact_id
       WHERE i.run_id = run.id AND a.suffix = '.csv')""",
    views=("run_input", "artifact"),
)
_filter(
    "q17_to_many_in_or", "user", "app_user",
    (F("name") == "MACHINERY") | (F("created_runs", "initiated_by_run", "_status_code") == 0),
    """name = 'MACHINERY' OR EXISTS (SELECT 1 FROM run r JOIN run p ON p.id = r.initiated_by_run_id
       WHERE r.created_by_id = app_user.id AND p._status_code = 0)""",
    views=("run",),
)
_filter(
    "q18_relation_count", "run", "run", (F("input_artifacts").count() >= 7) | (F("input_artifacts").count() == 0),
    """(SELECT count(*) FROM run_input i WHERE i.run_id = run.id) >= 7
       OR (SELECT count(*) FROM run_input i WHERE i.run_id = run.id) = 0""",
    views=("run_input",),
)


@named(
    "q11_array_contains", (),
    "SELECT doc_id AS id, list_contains([lang, source], 'en') AS by_lang FROM documents "
    "WHERE list_contains([lang, source], 'en') OR list_contains([lang, source], 'src3')",
)
def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tags = S.array("lang", "source")
    rows = docs.select(S.col("doc_id").alias("id"), tags.alias("tags"), S.to_json(tags).alias("tags_json"))
    reg = Registry("core.document", "reg_document", lambda: rows, json_fields=frozenset({"tags_json"}))
    found = Q.query(Catalog([reg]), "document", F("tags").contains("en") | F("tags_json").contains("src3"), limit=None)
    return found.select("id", S.array_contains("tags", "en").alias("by_lang"))


@named(
    "q22_deleted_rows", ("write_log",),
    """SELECT id FROM write_log WHERE event_type = 'DELETE'
       AND starts_with(json_extract_string(data, '$.key'), 'src1') AND json_extract(data, '$.branch_id') = 1
       AND (json_extract_string(data, '$.kind') IS NULL OR json_extract_string(data, '$.kind') NOT IN ('model'))""",
)
def q22(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F("key").startswith("src1") & (F("branch") == 1) & F("kind").not_in(["model"])
    return filter_deleted(view(spark, sf_dir, "write_log"), f).select("id")


@named(
    "q26_branch_scope", ("artifact", "branch"),
    """SELECT 'trash' AS scope, id FROM artifact WHERE branch_id = -1
       UNION ALL SELECT 'fix-1', a.id FROM artifact a JOIN branch b ON b.id = a.branch_id WHERE b.name = 'fix-1'""",
)
def q26(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        _ids(spark, sf_dir, "artifact", Q.on_branch(name)).select(S.lit(name).alias("scope"), "id")
        for name in ("trash", "fix-1")
    ]
    return parts[0].unionByName(parts[1])


@named("q27_branch_ids", ("artifact",), "SELECT id, branch_id FROM artifact WHERE branch_id IN (42, -1)")
def q27(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = catalog(spark, sf_dir)
    found = Q.query(cat, "artifact", branch_ids=[42, -1], limit=None)
    none = Q.query(cat, "artifact", branch_ids=[], limit=None)
    return found.unionByName(none).select("id", "branch_id")


@named(
    "q28_artifact_criteria", ("artifact",),
    """SELECT id, key, kind FROM artifact WHERE starts_with(key, 'src') AND suffix IN ('.csv', '.txt')
       AND (kind IS NULL OR kind NOT IN ('__internal_run__', '__internal_config__'))""",
)
def q28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(spark, sf_dir, "artifact", Q.artifact_filter(key_prefix="src", suffix=[".csv", ".txt"]), "key", "kind")


@named(
    "q29_internal", ("artifact",),
    "SELECT id, coalesce(kind IN ('__internal_run__', '__internal_config__'), false) AS is_internal FROM artifact",
)
def q29(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "artifact").select("id", is_internal(S.col("kind")).alias("is_internal"))


_UPLOADING = "coalesce(_aux IN ('{\"so\": 1}', '{\"so\": true}'), false)"


@named("q30_upload_ongoing", ("artifact",), f"SELECT id, {_UPLOADING} AS uploading FROM artifact")
def q30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "artifact").select("id", upload_ongoing(S.col("_aux")).alias("uploading"))


@named("q31_ready", ("artifact",), f"SELECT id, key FROM artifact WHERE NOT {_UPLOADING}")
def q31(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.ready(view(spark, sf_dir, "artifact")).select("id", "key")


@named(
    "q41_record_query", ("artifact",),
    """SELECT id, key, size FROM artifact
       WHERE suffix = '.csv' AND branch_id IN (1, 42)
         AND (contains(lower(uid), '1') OR contains(lower(key), '1') OR contains(lower(suffix), '1')
              OR contains(lower(kind), '1') OR contains(lower(description), '1') OR contains(lower(_aux), '1'))
       ORDER BY size DESC, id LIMIT 40 OFFSET 5""",
)
def q41(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.query(
        catalog(spark, sf_dir), "artifact", F("suffix") == ".csv", select=["id", "key", "size"], order_by=["-size"],
        limit=40, offset=5, search="1", branch_ids=[1, 42],
    )


@named(
    "q42_projection_to_one", ("run", "app_user"),
    """SELECT r.id, u.handle, u.name, p.uid AS parent_uid FROM run r LEFT JOIN app_user u ON u.id = r.created_by_id
       LEFT JOIN run p ON p.id = r.initiated_by_run_id WHERE r.branch_id = 42""",
)
def q42_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Q.query(
        catalog(spark, sf_dir), "run", F("branch_id") == 42, limit=None,
        select=["id", "created_by(handle, name)", "initiated_by_run(uid)"],
    )
    return rows.select("id", "created_by.handle", "created_by.name", S.col("initiated_by_run.uid").alias("parent_uid"))


@named(
    "q42_projection_to_many", ("run", "run_input", "artifact"),
    """SELECT r.id, a.key, a.size FROM run r
       LEFT JOIN (run_input i JOIN artifact a ON a.id = i.artifact_id) ON i.run_id = r.id WHERE r.branch_id = 42""",
)
def q42_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Q.query(
        catalog(spark, sf_dir), "run", F("branch_id") == 42, limit=None, select=["id", "input_artifacts(key, size)"]
    )
    return rows.select("id", "input_artifacts.key", "input_artifacts.size")


@named(
    "q43_no_foreign_keys", ("artifact",), "SELECT id, uid, key, suffix, kind, description, size, _aux FROM artifact"
)
def q43(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.query(catalog(spark, sf_dir), "artifact", include_foreign_keys=False, limit=None)


@named(
    "q44_sort", ("run",),
    "SELECT id, created_by_id, _status_code FROM run ORDER BY _status_code DESC, created_by_id, id LIMIT 200",
)
def q44(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.query(
        catalog(spark, sf_dir), "run", order_by=["-_status_code", "created_by_id"], limit=200,
        select=["id", "created_by_id", "_status_code"],
    )


@named("q45_limit_offset", ("artifact",), "SELECT id, uid FROM artifact ORDER BY id LIMIT 250 OFFSET 130")
def q45(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.query(catalog(spark, sf_dir), "artifact", limit=250, offset=130).select("id", "uid")


@named("q46_newest", ("run",), "SELECT id, uid FROM run ORDER BY id DESC LIMIT 100")
def q46(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.newest(view(spark, sf_dir, "run"), 100).select("id", "uid")


@named(
    "q47_search", ("app_user",),
    "SELECT id, handle FROM app_user WHERE contains(lower(handle), 'mer#000000012') OR contains(lower(name), 'build')",
)
def q47(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = catalog(spark, sf_dir)
    parts = [Q.query(cat, "user", search=text, limit=None) for text in ("MER#000000012", "Build")]
    return parts[0].unionByName(parts[1]).select("id", "handle").distinct()


@named(
    "q47_search_postings", ("app_user",),
    """SELECT id, handle, needle FROM app_user, (VALUES ('mer#000000012'), ('build'), ('9'), ('0#'), ('nowhere')) n(needle)
       WHERE contains(lower(handle), needle) OR contains(lower(name), needle)""",
)
def q47_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, folder = view(spark, sf_dir, "app_user"), scratch_dir(spark, "postings")
    write_postings(text_postings(people), folder)
    postings = spark.read.parquet(folder)
    found = [search_postings(people, postings, text).withColumn("needle", S.lit(text.lower())) for text in ("MER#000000012", "Build", "9", "0#", "nowhere")]
    return reduce(DataFrame.unionByName, found).select("id", "handle", "needle")


@named(
    "q48_by_ids", ("artifact", "run_input"),
    "SELECT id, key FROM artifact WHERE id IN (SELECT artifact_id FROM run_input) AND suffix = '.txt'",
)
def q48(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = catalog(spark, sf_dir)
    return Q.by_ids(cat, "artifact", cat.link("run_input"), F("suffix") == ".txt", column="artifact_id").select("id", "key")


@named(
    "q49_lookups", ("branch", "app_user", "write_log"),
    """SELECT 'branch' AS what, id, name FROM branch WHERE name = 'release-3'
       UNION ALL SELECT 'user', id, name FROM app_user WHERE id IN (SELECT created_by_id FROM write_log)""",
)
def q49(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = catalog(spark, sf_dir)
    branch = Q.lookup_branch(cat, "release-3").select(S.lit("branch").alias("what"), "id", "name")
    return branch.unionByName(
        Q.users(cat, cat.log(), "created_by_id").select(S.lit("user").alias("what"), "id", "name")
    )
