"""Gates: is the data there yet? One condition, or a table of conditions with one verdict each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as S
from pyspark.sql import types as T

from changelake.functions.codes import (
    BRANCH_STATUS,
    DEFAULT_BRANCH_ID,
    INTERNAL_KINDS,
    branch_status,
    check_names,
    is_internal,
)
from changelake.functions.jsoncols import upload_ongoing
from changelake.operators.query import artifact_filter, newest, on_branch
from changelake.plans.filters import FilterExpression, all_of
from changelake.plans.joins import lookup
from changelake.plans.matching import apply_filter
from changelake.sources.catalog import Catalog

OPEN, PENDING, FAILED = "success", "pending", "failure"
#: A gate that can never open: it asks for less than one record, or for more than are looked at.
INVALID = "invalid"


def _check(min_count: int, limit: int | None) -> None:
    if min_count < 1 or (limit is not None and limit < min_count):
        raise ValueError("min_count must be at least 1 and limit not below it")


def _waits(catalog: Catalog, registry: str, wait_for_upload: bool | None) -> bool:
    """Artifacts wait for their upload unless told otherwise."""
    if wait_for_upload is not None:
        return wait_for_upload
    return catalog.registry(registry).name == "core.artifact"


def matching_records(
    catalog: Catalog,
    registry: str,
    filter: FilterExpression | None = None,
    *,
    branch: str | int | None = "main",
    limit: int | None = None,
    wait_for_upload: bool | None = None,
) -> DataFrame:
    """Matches on the branch that have been uploaded; with ``limit``, of the newest so many."""
    df = apply_filter(catalog, registry, catalog.load(registry), all_of(filter, on_branch(branch)))
    df = df if limit is None else newest(df, limit)
    return df.where(~upload_ongoing(S.col("_aux"))) if _waits(catalog, registry, wait_for_upload) else df


def record_gate(
    catalog: Catalog,
    registry: str,
    filter: FilterExpression | None = None,
    *,
    branch: str | int | None = "main",
    min_count: int = 1,
    limit: int | None = None,
    wait_for_upload: bool | None = None,
) -> DataFrame:
    """The matching records if there are at least ``min_count`` of them, else nothing."""
    _check(min_count, limit)
    rows = matching_records(
        catalog, registry, filter, branch=branch, limit=limit, wait_for_upload=wait_for_upload
    )
    return rows.where(rows.agg(S.count(S.lit(1)) >= min_count).scalar())


def artifact_gate(
    catalog: Catalog,
    *,
    key: str | None = None,
    key_prefix: str | None = None,
    suffix: str | Iterable[str] | None = None,
    kind: str | Iterable[str] | None = None,
    include_internal: bool = False,
    internal_kinds: Iterable[str] = INTERNAL_KINDS,
    filter: FilterExpression | None = None,
    branch: str | int | None = "main",
    min_count: int = 1,
    limit: int | None = None,
    wait_for_upload: bool = True,
) -> DataFrame:
    """``record_gate`` for artifacts by the usual criteria."""
    criteria = artifact_filter(
        key=key, key_prefix=key_prefix, suffix=suffix, kind=kind, include_internal=include_internal,
        extra=filter, internal_kinds=internal_kinds,
    )
    return record_gate(
        catalog, "artifact", criteria, branch=branch, min_count=min_count, limit=limit, wait_for_upload=wait_for_upload
    )


def branch_gate(
    branches: DataFrame,
    gates: DataFrame,
    target: str | Sequence[str] = ("merged",),
    failure: str | Sequence[str] = ("closed",),
) -> DataFrame:
    """Verdict per gate on a branch's status: ``success``, ``failure`` or ``pending``.

    ``gates`` has ``gate_id`` and ``branch_id`` or ``branch_name``; an absent branch is pending. Array columns
    ``target`` and ``failure`` override the arguments per gate.
    """
    target = check_names(target, BRANCH_STATUS, "target")
    failure = check_names(failure, BRANCH_STATUS, "failure")
    if not target:
        raise ValueError("target must not be empty")
    if both := set(target) & set(failure):
        raise ValueError(f"statuses {sorted(both)} are both target and failure")
    key = "branch_id" if "branch_id" in gates.columns else "branch_name"
    known = branches.select(
        S.col("id" if key == "branch_id" else "name").alias("__branch"), S.lit(True).alias("__found"),
        branch_status(S.col("_status_code")).alias("status"),
    )

    def among(column: str, names: list[str]) -> Column:
        names_column = S.col(column) if column in gates.columns else S.array(*[S.lit(n) for n in names]).cast("array<string>")
        return S.array_contains(names_column, S.col("status"))

    joined = gates.join(known, S.col(key) == S.col("__branch"), "left")
    verdict = (
        S.when(S.col("__found").isNull(), PENDING)
        .when(among("target", target), OPEN)
        .when(among("failure", failure), FAILED)
        .otherwise(PENDING)
    )
    return joined.withColumn("verdict", verdict).drop("__branch", "__found")


def evaluate_gates(
    artifacts: DataFrame,
    gates: DataFrame,
    *,
    branch: int | None = DEFAULT_BRANCH_ID,
    limit: int | None = None,
    wait_for_upload: bool = True,
    internal_kinds: Iterable[str] = INTERNAL_KINDS,
) -> DataFrame:
    """Verdict per gate of a table of artifact gates: ``gate_id, n_ready, min_count, verdict``.

    A gate's criteria are its non-null columns among ``key``, ``key_prefix``, ``suffix`` and ``kind`` (each of the last
    two a value or an array of them) and ``branch_id``, without which ``branch`` holds. Matches still uploading don't
    count; with ``limit``, only the newest so many are looked at. A gate that asks for more than these, for less than one
    or for no number is ``invalid`` whatever there is.

    Gates with equal criteria are one *criterion*. A criterion is matched by equality on everything it fixes: the whole
    key, or the key cut to the prefix's length, and each of its suffixes and kinds. An artifact offers one combination
    for each shape of criteria there is, so it only meets those it matches. Counts are summed before the shuffle.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    types = {f.name: f.dataType for f in gates.schema}

    def listed(name: str) -> Column:
        if name not in types:
            return S.lit(None).cast("array<string>")
        if isinstance(types[name], T.ArrayType):
            return S.when(S.size(name) > 0, S.array_sort(S.array_distinct(S.col(name))))
        return S.when(S.col(name).isNotNull(), S.array(name))

    def single(name: str) -> Column:
        return S.col(name) if name in types else S.lit(None).cast("string")

    own_branch = S.col("branch_id") if "branch_id" in types else S.lit(None)
    criteria = {
        "__key": single("key"), "__prefix": S.nullif(single("key_prefix"), S.lit("")), "__suffixes": listed("suffix"), "__kinds": listed("kind"),
        "__branch": S.coalesce(own_branch, S.lit(branch)).cast("bigint"),
    }
    keyed = gates.withColumns(criteria).withColumn("__criterion", S.to_json(S.struct(*criteria)))
    wanted = keyed.select("__criterion", *criteria).dropDuplicates(["__criterion"])
    # what a criterion fixes; a key fixes more than a prefix, which is checked afterwards
    size = S.when(S.col("__key").isNotNull(), S.lit(-1)).otherwise(S.coalesce(S.length("__prefix"), S.lit(0)))
    shape = S.struct(
        size.alias("size"), S.col("__suffixes").isNotNull().alias("by_suffix"), S.col("__kinds").isNotNull().alias("by_kind"),
        S.col("__branch").isNotNull().alias("by_branch"),
    )
    none = S.array(S.lit("").cast("string"))
    wanted = wanted.withColumn("__shape", shape)
    # one row, no longer than the longest prefix times eight
    shapes = wanted.agg(S.collect_set("__shape")).scalar()
    wanted = wanted.withColumn("__w_cut", S.coalesce("__key", "__prefix", S.lit("")))
    wanted = wanted.withColumn("__w_suffix", S.explode(S.coalesce("__suffixes", none)))
    wanted = wanted.withColumn("__w_kind", S.explode(S.coalesce("__kinds", none)))
    wanted = wanted.select(
        "__criterion", S.col("__shape").alias("__w_shape"), "__w_cut", "__w_suffix", "__w_kind", S.coalesce("__branch", S.lit(0)).alias("__w_branch"),
        S.col("__prefix").alias("__w_prefix"),
    )

    uploading = upload_ongoing(S.col("_aux")) if wait_for_upload else S.lit(False)
    rows = artifacts.select("id", "key", "suffix", "kind", "branch_id", uploading.alias("uploading")).withColumn("__shape", S.explode(shapes))
    fixed = S.col("__shape.size")
    rows = rows.where((fixed <= 0) | (S.length("key") >= fixed))
    rows = rows.withColumns({
        "__cut": S.when(fixed < 0, S.col("key")).when(fixed == 0, "").otherwise(S.substr("key", S.lit(1), fixed)),
        "__suffix": S.when(S.col("__shape.by_suffix"), S.col("suffix")).otherwise(""),
        "__kind": S.when(S.col("__shape.by_kind"), S.col("kind")).otherwise(""),
        "__branch": S.when(S.col("__shape.by_branch"), S.col("branch_id")).otherwise(S.lit(0)),
    })
    rows = rows.where(S.col("__shape.by_kind") | ~is_internal(S.col("kind"), internal_kinds))
    equal = [S.col(f"__{name}") == S.col(f"__w_{name}") for name in ("cut", "suffix", "kind", "branch", "shape")]
    matches = rows.join(wanted, reduce(lambda a, b: a & b, equal))
    matches = matches.where(S.col("__w_prefix").isNull() | S.startswith("key", "__w_prefix"))
    matches = matches.select("__criterion", "id", "uploading")
    if limit is not None:  # every task keeps `limit` rows of a criterion before the shuffle
        latest = W.partitionBy("__criterion").orderBy(S.col("id").desc())
        matches = matches.withColumn("__rank", S.row_number().over(latest)).where(S.col("__rank") <= limit)
    found = matches.groupBy(S.col("__criterion").alias("__found")).agg(S.count_if(~S.col("uploading")).alias("__n"))
    n_ready = S.coalesce(S.col("__n"), S.lit(0))
    possible = (S.col("min_count") >= 1) & (S.lit(True) if limit is None else S.col("min_count") <= limit)
    return lookup(keyed, found, {"__criterion": "__found"}).select(
        "gate_id",
        n_ready.alias("n_ready"),
        "min_count",
        S.when(~S.coalesce(possible, S.lit(False)), INVALID).when(n_ready >= S.col("min_count"), OPEN).otherwise(PENDING).alias("verdict"),
    )


def gate_opened_at(events: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The keys and log id of the ``n``-th event per gate: the moment a wait for ``n`` of them ends.

    Each task keeps its ``n`` lowest ids per gate before the shuffle.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    order = W.partitionBy(*keys).orderBy("id")
    ranked = events.select(*keys, "id").withColumn("__rank", S.row_number().over(order))
    return ranked.where(S.col("__rank") == n).select(*keys, S.col("id").alias("opened_at"))
