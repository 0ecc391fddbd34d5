"""Changing tables: inserts, partial updates, validation, and the log rows that changes leave behind.

Tables are never changed in place. An operator returns the new table, or the rows to add, for the caller to
write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as S
from pyspark.sql import types as T

from changelake.functions import jsoncols as J
from changelake.functions.codes import DEFAULT_BRANCH_ID
from changelake.plans.joins import lookup, touched
from changelake.plans.once import computed_once
from changelake.plans.segments import hashed_segment, numbered

_JSON_NAMES = {T.StringType: "STRING", T.BooleanType: "BOOLEAN"}


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a present, non-null JSON value has the type of a field; there is no conversion."""
    if isinstance(kind, T.IntegralType):
        return J.type_name(value) == "BIGINT"
    if isinstance(kind, T.NumericType):
        return J.is_number(value)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return S.coalesce(J.as_string(value).try_cast(kind).isNotNull(), S.lit(False))
    return J.type_name(value) == _JSON_NAMES.get(type(kind), "STRING")


def _typed(value: Column, kind: T.DataType) -> Column:
    """A JSON value as a field's type; JSON null is null."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return J.as_string(value).try_cast(kind)
    return S.try_variant_get(value, "$", kind.simpleString())


def _wrong_types(row: Column, fields: list[T.StructField]) -> Column:
    """Names of the fields whose JSON value has the wrong type."""
    wrong = [
        S.when(~J.is_null(J.member(row, f.name)) & ~_fits(J.member(row, f.name), f.dataType), S.lit(f.name)) for f in fields
    ]
    return S.array_compact(S.array(*wrong)) if wrong else S.array().cast("array<string>")


def validate(raw: DataFrame, schema: T.StructType, *, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split rows of JSON text into typed rows and bad ones.

    Known fields must have their type or be null; a text that isn't a JSON object is bad. The first table has
    one column per known field and ``extra``, the other fields as JSON text by name. The second has the
    original columns and ``errors``, the names of the wrong fields (``$`` for the whole text).
    """
    fields = list(schema.fields)
    parsed = computed_once(raw, __row=J.parsed(S.col(column)))
    is_object = S.coalesce(J.type_name(S.col("__row")).startswith("OBJECT"), S.lit(False))
    errors = S.when(~is_object, S.array(S.lit("$"))).otherwise(_wrong_types(S.col("__row"), fields))
    checked = computed_once(parsed, errors=errors)
    names = [f.name for f in fields]
    others = S.map_filter(
        S.try_variant_get(S.col("__row"), "$", "map<string,variant>"), lambda key, _: ~key.isin(names)
    )
    good = checked.where(S.size("errors") == 0).select(
        *[_typed(J.member(S.col("__row"), f.name), f.dataType).alias(f.name) for f in fields],
        S.transform_values(others, lambda _, value: S.to_json(value)).alias("extra"),
    )
    bad = checked.where(S.size("errors") > 0).drop("__row")
    return good, bad


def insert_records(df: DataFrame, rows: DataFrame, *, order: str = "uid", digits: int = 4) -> DataFrame:
    """The new rows with ids that follow the largest one, to be appended.

    ``order`` is a unique text column. Ids are given in the order of its MD5's first ``digits`` hex digits,
    then of the column, so that numbering is spread over tasks.
    """
    start = df.agg(S.coalesce(S.max("id"), S.lit(0))).scalar()
    rows = numbered(rows.drop("id"), [], [order], "__n", hashed_segment(order, digits))
    rows = rows.select((start + S.col("__n")).alias("id"), *rows.drop("__n").columns)
    known = [S.col(name).cast(df.schema[name].dataType) if name in df.columns else S.col(name) for name in rows.columns]
    return rows.select(*[column.alias(name) for column, name in zip(known, rows.columns, strict=True)])


def update_records(df: DataFrame, patches: DataFrame, *, patch: str = "patch") -> tuple[DataFrame, DataFrame]:
    """The table after partial updates, and the updates that were rejected.

    ``patches``: ``uid`` and a JSON object of the fields to set, where null clears a field; one per uid.
    Rejected ones have a ``reason``: ``malformed``, ``unknown uid``, ``repeated uid`` or ``field`` for an
    unknown field or a value of the wrong type. A rejected update changes nothing.
    """
    checked = _checked_patches(df, patches, patch)
    good = checked.where(S.col("reason").isNull()).select(S.col("uid").alias("__uid"), "__patch")
    joined = df.join(good, S.col("uid") == S.col("__uid"), "left")
    fields = [f for f in df.schema if f.name not in ("id", "uid")]
    updates = {
        f.name: S.when(
            J.member(S.col("__patch"), f.name).isNotNull(), _typed(J.member(S.col("__patch"), f.name), f.dataType)
        ).otherwise(S.col(f.name))
        for f in fields
    }
    updated = joined.withColumns(updates).select(*df.columns)
    known = df.select(S.col("uid").alias("__known")).where(S.col("__known").isNotNull())
    missing = checked.where(S.col("reason").isNull()).join(known, S.col("uid") == S.col("__known"), "left_anti")
    rejected = checked.where(S.col("reason").isNotNull()).unionByName(missing.withColumn("reason", S.lit("unknown uid")))
    return updated, rejected.select("uid", patch, "reason")


def _checked_patches(df: DataFrame, patches: DataFrame, patch: str) -> DataFrame:
    """One row per uid with ``__patch`` parsed and a ``reason`` if it can't be applied."""
    fields = [f for f in df.schema if f.name not in ("id", "uid")]
    single = patches.groupBy("uid").agg(S.min(patch).alias(patch), S.count(S.lit(1)).alias("__times"))
    parsed = computed_once(single, __patch=J.parsed(S.col(patch)))
    unknown = S.size(S.array_except(J.object_keys(S.col(patch)), S.array(*[S.lit(f.name) for f in fields]))) > 0
    reason = (
        S.when(S.col("__times") > 1, "repeated uid")
        .when(~J.type_name(S.col("__patch")).startswith("OBJECT"), "malformed")
        .when(unknown | (S.size(_wrong_types(S.col("__patch"), fields)) > 0), "field")
    )
    return computed_once(parsed, reason=reason).drop("__times")


def _judged(before: DataFrame, changes: DataFrame, patch: str) -> DataFrame:
    """Changes with the record's old values, ``__patch`` parsed, ``__keys``, and a ``reason`` where the table refuses them.

    The one join to the table serves both what is refused and what is logged.
    """
    fields = [f for f in before.schema if f.name not in ("id", "uid")]
    old = touched(before, "uid", changes, "uid").withColumnsRenamed({c: f"__old_{c}" for c in before.columns})
    times = changes.where(S.col("op") == "UPDATE").groupBy(S.col("uid").alias("__uid")).agg(S.count(S.lit(1)).alias("__times"))
    rows = lookup(changes.join(old, S.col("uid") == S.col("__old_uid"), "left"), times.where("__times > 1"), {"uid": "__uid"})
    rows = computed_once(rows, __patch=J.parsed(S.col(patch)), __keys=J.object_keys(S.col(patch)))
    is_update = S.col("op") == "UPDATE"
    has_patch = is_update | ((S.col("op") == "INSERT") & S.col(patch).isNotNull())
    extra = S.size(S.array_except("__keys", S.array(*[S.lit(f.name) for f in before.schema]))) > 0
    wrong = S.size(_wrong_types(S.col("__patch"), fields)) > 0
    fixed = S.arrays_overlap("__keys", S.array(S.lit("id"), S.lit("uid")))
    reason = (
        S.when((S.col("op") != "INSERT") & S.col("__old_uid").isNull(), "unknown uid")
        .when(is_update & S.col("__times").isNotNull(), "repeated uid")
        .when(has_patch & ~S.coalesce(J.type_name(S.col("__patch")).startswith("OBJECT"), S.lit(False)), "malformed")
        .when(has_patch & (extra | wrong | (is_update & fixed)), "field")
    )
    return computed_once(rows, reason=reason).drop("__times")


def rejected_changes(before: DataFrame, changes: DataFrame, patch: str = "patch") -> DataFrame:
    """Changes that ``emit_log`` leaves out, with a ``reason``: what ``update_records`` refuses, and unknown records."""
    return _judged(before, changes, patch).where(S.col("reason").isNotNull()).select(*changes.columns, "reason")


def emit_log(
    before: DataFrame,
    changes: DataFrame,
    *,
    table_name: str,
    start_id: int | Column,
    patch: str = "patch",
    digits: int = 4,
    default_branch: int = DEFAULT_BRANCH_ID,
) -> DataFrame:
    """The write-log rows for a set of changes to a table.

    ``changes``: ``op`` (``INSERT``, ``UPDATE`` or ``DELETE``), ``uid``, ``sqlrecord_id`` (for inserts),
    ``patch`` (JSON object of the new values) and optionally ``created_at`` and ``created_by_id``. An insert
    logs no data and is on ``default_branch`` if it names none, an update the previous values of the touched
    fields, a delete the whole previous row. Changes that ``rejected_changes`` tells are left out. ``space_id`` and
    ``run_id`` are those of the changes, else the record's. Ids
    follow ``start_id`` in the order of ``hashed_segment(uid)``, then ``uid``.
    """
    columns = before.columns
    rows = _judged(before, changes, patch).where(S.col("reason").isNull())
    pieces = []
    for name in columns:
        whole = S.to_json(S.struct(S.col(f"__old_{name}").alias(name)), {"ignoreNullFields": "false"})
        logged = (S.col("op") == "DELETE") | S.array_contains("__keys", name)
        pieces.append(S.when(logged, S.substr(whole, S.lit(2), S.length(whole) - 2)))
    data = S.concat(S.lit("{"), S.concat_ws(",", *pieces), S.lit("}"))
    patched = J.member(S.col("__patch"), "branch_id")
    old_branch = S.col("__old_branch_id") if "branch_id" in columns else S.lit(None).cast("bigint")
    branch = S.when(patched.isNotNull() & (S.col("op") != "DELETE"), J.as_long(patched)).otherwise(old_branch)
    branch = S.when((S.col("op") == "INSERT") & J.is_null(patched), S.lit(default_branch)).otherwise(branch)
    rows = numbered(rows, [], ["uid"], "__n", hashed_segment("uid", digits))

    def given(name: str, kind: str) -> Column:
        known = [S.col(name)] if name in changes.columns else []
        known += [S.col(f"__old_{name}")] if name in columns and name in ("space_id", "run_id") else []
        return S.coalesce(*known).cast(kind) if known else S.lit(None).cast(kind)

    id_column = (start_id if isinstance(start_id, Column) else S.lit(start_id)) + S.col("__n")
    return rows.select(
        id_column.alias("id"),
        S.concat(S.lit("w"), id_column.cast("string")).alias("uid"),
        S.col("op").alias("event_type"),
        S.lit(table_name).alias("table_name"),
        S.coalesce(S.col("__old_id"), given("sqlrecord_id", "bigint")).alias("sqlrecord_id"),
        given("created_at", "timestamp_ntz").alias("created_at"),
        given("created_by_id", "bigint").alias("created_by_id"),
        branch.alias("branch_id"),
        given("space_id", "bigint").alias("space_id"),
        given("run_id", "bigint").alias("run_id"),
        S.when(S.col("op") != "INSERT", data).alias("data"),
    )


def write_append(df: DataFrame, path: str, *, sort_by: str = "id") -> None:
    """Append rows to a Parquet table, sorted within files so that a range of ids skips most row groups."""
    df.sortWithinPartitions(sort_by).write.mode("append").parquet(path)
