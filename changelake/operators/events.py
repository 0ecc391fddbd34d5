"""Semantic change events: the write log joined to current records, actors and branches.

Every function returns one row per event with the log id as ``id``. Rows come unordered; ``in_order`` sorts
them by log id where a consumer needs that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as S

from changelake.functions import jsoncols as J
from changelake.functions.codes import (
    BLOCK_KINDS,
    BRANCH_STATUS,
    INTERNAL_KINDS,
    RECORD_EVENTS,
    as_list,
    branch_status,
    check_names,
    is_internal,
)
from changelake.functions.patterns import glob_any
from changelake.operators import changes as C
from changelake.operators.query import artifact_filter, branch_id
from changelake.operators.subscriptions import delivered, interned, match_criteria
from changelake.plans.filters import FilterExpression, is_local
from changelake.plans.joins import lookup, touched
from changelake.plans.matching import apply_filter, previous_row_matches
from changelake.plans.once import computed_once
from changelake.plans.segments import SPAN, numbered, span_of
from changelake.sources.catalog import Catalog, Registry

Step = Callable[[DataFrame], DataFrame]


def with_actor(df: DataFrame, users: DataFrame | None) -> DataFrame:
    """Add ``changed_by``: the actor's id, with handle and name if the user is known; null without an id."""
    if users is None:
        known = df.withColumns({"__handle": S.lit(None).cast("string"), "__name": S.lit(None).cast("string")})
    else:
        people = users.select(
            S.col("id").alias("__user"), S.col("handle").alias("__handle"), S.col("name").alias("__name")
        )
        known = lookup(df, people, {"created_by_id": "__user"})
    actor = S.struct(S.col("created_by_id").alias("id"), S.col("__handle").alias("handle"), S.col("__name").alias("name"))
    return known.withColumn("changed_by", S.when(S.col("created_by_id").isNotNull(), actor)).drop("__handle", "__name")


def exclude_marked(df: DataFrame, marker: str) -> DataFrame:
    """Leave out writes to bookkeeping records: those whose ``reference_type`` is ``marker``.

    Looks at the current record where there is one (a struct column ``record``), else at the previous row.
    """
    data = S.col("__data") if "__data" in df.columns else C.parsed_data()
    before = J.equals(J.member(data, "reference_type"), marker)
    fields = df.schema["record"].dataType.fieldNames() if "record" in df.columns else []
    if "record" not in df.columns:
        return df.where(~before)
    if "reference_type" not in fields:
        return df.where(S.col("record").isNotNull() | ~before)
    now = S.col("record.reference_type").eqNullSafe(S.lit(marker))
    return df.where(~S.when(S.col("record").isNotNull(), now).otherwise(before))


def _events(events: str | Iterable[str]) -> list[str]:
    names = check_names(events, RECORD_EVENTS, "events")
    if not names:
        raise ValueError("events must not be empty")
    return [name for name in RECORD_EVENTS if name in names]


def _scope(catalog: Catalog, records: DataFrame, branch: str | int | None) -> int | None:
    """The branch events are relative to; none for a registry without branches."""
    return branch_id(catalog, branch) if "branch_id" in records.columns else None


def _keep(events: Sequence[str], changed: str | Iterable[str] | None) -> Column:
    wanted = S.col("event").isin(list(events))
    fields = as_list(changed)
    if not fields:
        return wanted
    overlap = S.arrays_overlap(C.changed_fields(), S.array(*[S.lit(name) for name in fields]))
    return wanted & ((S.col("event") != "updated") | overlap)


def _classified(
    rows: DataFrame, table_name: str, events: list[str], branch: int | None, wait_for_upload: bool = False
) -> DataFrame:
    """Candidate rows with ``event``, ``__data`` and ``__completes``."""
    data = S.col("__data")
    rows = C.with_parsed_data(rows.where(C.scanned(table_name, events, branch)))
    rows = rows.where(C.candidates(table_name, events, branch, wait_for_upload, data))
    return computed_once(rows, event=C.record_event(branch, data), __completes=C.is_upload_completion(data))


def _with_records(rows: DataFrame, records: DataFrame, completions: DataFrame | None = None) -> DataFrame:
    """Attach the current record, and ``__found``; a hard delete has none.

    ``completions`` are attached to the records first: only rows with a record need them, and so the log rows
    are shuffled once.
    """
    table = records.select(S.col("id").alias("__record_id"), S.lit(True).alias("__found"), S.struct("*").alias("record"))
    if completions is not None:
        table = table.join(completions, S.col("__record_id") == S.col("sqlrecord_id"), "left").drop("sqlrecord_id")
    return lookup(rows, table, {"sqlrecord_id": "__record_id"}, only=S.col("event_type") != "DELETE")


def _with_kept_record(rows: DataFrame, filter: FilterExpression | None, events: Sequence[str]) -> DataFrame:
    """Drop events whose record is gone or doesn't match.

    A hard delete is checked on its previous row. A record that moved off the branch and is gone since is
    reported only if there is no filter to check.
    """
    found = S.col("__found").isNotNull()
    if "deleted" not in events:
        return rows.where(found).drop("__found")
    if filter is None:
        found = found | (S.col("event") == "deleted")
    kept = S.when(S.col("event_type") == "DELETE", previous_row_matches(filter, S.col("__data"))).otherwise(found)
    return rows.where(kept).drop("__found")


def _payload(rows: DataFrame, registry: Registry) -> DataFrame:
    return rows.select(
        "id",
        "event",
        S.lit(registry.name).alias("registry"),
        "table_name",
        S.col("sqlrecord_id").alias("record_id"),
        "record",
        S.col("data").alias("previous"),
        C.changed_fields().alias("changed_fields"),
        "changed_by",
        C.summary(rows).alias("dbwrite"),
    )


def record_events(
    catalog: Catalog,
    registry: str,
    *,
    events: str | Iterable[str] = ("created",),
    branch: str | int | None = "main",
    filter: FilterExpression | None = None,
    changed_fields: str | Iterable[str] | None = None,
    log: DataFrame | None = None,
    marker: str | None = None,
    refine: Step | None = None,
    only_touched: bool = False,
) -> DataFrame:
    """Records of a registry created, updated or deleted, relative to a branch.

    :param filter: Checked on the current record, for hard deletes on the previous row.
    :param changed_fields: Report an update only if it changed one of these.
    :param log: The log rows to look at, by default the catalog's whole log.
    :param marker: Leave out records with this ``reference_type``.
    :param refine: Step that may drop or reclassify rows (columns of the log, ``event`` and ``record``).
    :param only_touched: For a small ``log``: cut the registry to the records it is about before joining.
    """
    names = _events(events)
    reg = catalog.registry(registry)
    if "deleted" in names and not is_local(filter):
        raise ValueError("deleted events only support filters on direct fields of the record")
    records = reg.load()
    scope = _scope(catalog, records, branch)
    rows = catalog.log() if log is None else log
    rows = _classified(rows, reg.table_name, names, scope)
    rows = rows.where(S.col("event").isin(names))
    records = apply_filter(catalog, reg, records, filter)
    rows = _with_records(rows, touched(records, "id", rows, "sqlrecord_id") if only_touched else records)
    if marker is not None:
        rows = exclude_marked(rows, marker)
    if refine is not None:
        rows = refine(rows)
    rows = _with_kept_record(rows.where(_keep(names, changed_fields)), filter, names)
    return _payload(with_actor(rows, _users(catalog)), reg)


def artifact_events(
    catalog: Catalog,
    *,
    registry: str = "artifact",
    key: str | None = None,
    key_prefix: str | None = None,
    suffix: str | Iterable[str] | None = None,
    kind: str | Iterable[str] | None = None,
    include_internal: bool = False,
    internal_kinds: Iterable[str] = INTERNAL_KINDS,
    wait_for_upload: bool = True,
    events: str | Iterable[str] = ("created",),
    branch: str | int | None = "main",
    filter: FilterExpression | None = None,
    changed_fields: str | Iterable[str] | None = None,
    log: DataFrame | None = None,
    completions: DataFrame | None = None,
    refine: Step | None = None,
    only_touched: bool = False,
) -> DataFrame:
    """Artifacts created, updated or deleted, where *created* waits for the upload.

    With ``wait_for_upload``, the end of an artifact's first upload is its creation and the end of a later
    one an update; inserts followed by such an end, updates during an upload and deletes of failed uploads
    aren't reported. The ends of uploads are ``completions`` as made by ``upload_completions``, by default
    those in the catalog's whole log.
    """
    names = _events(events)
    reg = catalog.registry(registry)
    internal_kinds = list(internal_kinds)
    criteria = artifact_filter(
        key=key, key_prefix=key_prefix, suffix=suffix, kind=kind, include_internal=include_internal,
        extra=filter, internal_kinds=internal_kinds,
    )
    if "deleted" in names and not is_local(criteria):
        raise ValueError("deleted events only support filters on direct fields of the record")
    records = reg.load()
    scope = _scope(catalog, records, branch)
    rows = catalog.log() if log is None else log
    rows = _classified(rows, reg.table_name, names, scope, wait_for_upload)
    event, completes = S.col("event"), S.col("__completes")
    uploads = wait_for_upload and not {"created", "updated"}.isdisjoint(names)
    if wait_for_upload:
        rows = rows.withColumn("event", S.when((event == "updated") & completes, "created").otherwise(event))
    kept = event.isin(names)
    rows = rows.where(kept | (completes & (event == "created")) if uploads else kept)

    records = apply_filter(catalog, reg, records, criteria)
    done = None
    if uploads:
        done = C.upload_completions(catalog.log(), reg.table_name) if completions is None else completions
    if only_touched:
        records = touched(records, "id", rows, "sqlrecord_id")
        done = None if done is None else touched(done, "sqlrecord_id", rows, "sqlrecord_id")
    rows = _with_records(rows, records, done)
    if done is None:
        nothing = S.lit(None).cast("bigint")
        rows = rows.withColumns({"first_completion": nothing, "last_completion": nothing})

    if not include_internal:
        rows = rows.where(~(S.col("__found").isNotNull() & is_internal(S.col("record.kind"), internal_kinds)))
    if wait_for_upload:
        rows = computed_once(rows, __event=_after_upload()).drop("event").withColumnRenamed("__event", "event")
    rows = rows.where(S.col("event").isNotNull()).drop("first_completion", "last_completion")
    if refine is not None:
        rows = refine(rows)
    rows = _with_kept_record(rows.where(_keep(names, changed_fields)), criteria, names)
    return _payload(with_actor(rows, _users(catalog)), reg)


def _after_upload() -> Column:
    """The event once uploads are taken into account; null drops the write."""
    event, kind, completes = S.col("event"), S.col("event_type"), S.col("__completes")
    uploading = J.upload_ongoing(S.col("record._aux"))
    failed = J.ongoing(J.member(S.col("__data"), "_aux"))
    ends_later = S.coalesce(S.col("last_completion") > S.col("id"), S.lit(False))
    ended_before = S.coalesce(S.col("first_completion") < S.col("id"), S.lit(False))
    return (
        S.when(kind == "DELETE", S.when(~failed, event))
        .when((event == "created") & (kind == "INSERT"), S.when(~uploading & ~ends_later, event))
        .when((event == "created") & completes, S.when(ended_before, "updated").otherwise(event))
        .when((event == "updated") & uploading, S.lit(None))
        .otherwise(event)
    )


def _users(catalog: Catalog) -> DataFrame | None:
    return catalog.load("user") if "core.user" in catalog.names() else None


def branch_summary(branches: DataFrame) -> DataFrame:
    """``(branch_key, branch)``: the id and a struct of the branch's fields with its status as a name."""
    columns = []
    for name in ("id", "uid", "name", "description", "status", "created_by_id", "created_at"):
        if name == "status":
            columns.append(branch_status(S.col(C.STATUS_FIELD)).alias("status"))
        elif name in branches.columns:
            columns.append(S.col(name))
        else:
            columns.append(S.lit(None).cast("string").alias(name))
    return branches.select(S.col("id").alias("branch_key"), S.struct(*columns).alias("branch"))


def status_events(
    catalog: Catalog,
    *,
    to_status: str | Iterable[str] | None = None,
    from_status: str | Iterable[str] | None = None,
    branch_name: str | Iterable[str] | None = None,
    log: DataFrame | None = None,
    later: DataFrame | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Changes of a branch's status. Unresolved and unchanged ones are left out.

    Pass ``later`` (the whole log) when ``log`` is only a part of it.
    """
    to_names = check_names(to_status, BRANCH_STATUS, "to_status")
    from_names = check_names(from_status, BRANCH_STATUS, "from_status")
    reg = catalog.registry("branch")
    branches = reg.load()

    def writes(df: DataFrame) -> DataFrame:
        return df.where(S.col("table_name") == reg.table_name)

    rows = C.field_transitions(
        writes(catalog.log() if log is None else log),
        branches,
        later=None if later is None else writes(later),
        skip_null=True,
        span=span,
    )
    rows = rows.where(S.col("is_resolved") & ~S.col("previous_value").eqNullSafe(S.col("new_value")))
    rows = rows.withColumns(
        {
            "from_status": branch_status(S.col("previous_value")),
            "to_status": branch_status(S.col("new_value")),
        }
    )
    if to_names:
        rows = rows.where(S.col("to_status").isin(to_names))
    if from_names:
        rows = rows.where(S.col("from_status").isin(from_names))
    rows = lookup(rows, branch_summary(branches), {"sqlrecord_id": "branch_key"})
    rows = with_actor(rows.where(glob_any(S.col("branch.name"), branch_name)), _users(catalog))
    return rows.select(
        "id",
        S.lit("status_changed").alias("event"),
        "from_status",
        "to_status",
        "branch",
        "changed_by",
        C.summary(rows).alias("dbwrite"),
    )


def block_events(
    catalog: Catalog,
    *,
    kinds: str | Iterable[str] = BLOCK_KINDS,
    branch_name: str | Iterable[str] | None = None,
    log: DataFrame | None = None,
) -> DataFrame:
    """Comments and readmes added to branches."""
    names = check_names(kinds, BLOCK_KINDS, "kinds")
    if not names:
        raise ValueError("kinds must not be empty")
    reg = catalog.registry("branchblock")
    rows = catalog.log() if log is None else log
    rows = rows.where((S.col("table_name") == reg.table_name) & (S.col("event_type") == "INSERT"))
    blocks = reg.load().where(S.col("kind").isin(names))
    blocks = blocks.select(
        S.col("id").alias("__block_id"), "kind", S.col("branch_id").alias("__block_branch"), S.struct("*").alias("block")
    )
    rows = lookup(rows, blocks, {"sqlrecord_id": "__block_id"}, "inner")
    rows = lookup(rows, branch_summary(catalog.load("branch")), {"__block_branch": "branch_key"})
    rows = with_actor(rows.where(glob_any(S.col("branch.name"), branch_name)), _users(catalog))
    return rows.select(
        "id",
        S.lit("block_created").alias("event"),
        "kind",
        "block",
        "branch",
        "changed_by",
        C.summary(rows).alias("dbwrite"),
    )


def custom_events(
    catalog: Catalog, candidates: Column, derive: Step, *, log: DataFrame | None = None, actors: bool = True
) -> DataFrame:
    """A pipeline of one's own: which log rows to read, and how to turn them into events.

    ``derive`` gets the chosen rows and keeps the log's columns; ``changed_by`` and ``dbwrite`` are added.
    """
    rows = derive((catalog.log() if log is None else log).where(candidates))
    if actors:
        rows = with_actor(rows, _users(catalog))
    extra = [name for name in rows.columns if name not in C.SUMMARY_FIELDS and name != "data"]
    return rows.select("id", *extra, C.summary(rows).alias("dbwrite"))


def all_events(*events: DataFrame) -> DataFrame:
    """Events of all kinds in one table. ``record`` and ``block`` become JSON text; other columns are null
    where a kind doesn't have them."""
    if not events:
        raise ValueError("all_events() needs at least one table")

    def envelope(df: DataFrame) -> DataFrame:
        for name in ("record", "block"):
            if name in df.columns:
                df = df.withColumn(name, S.to_json(S.col(name)))
        return df

    combined = envelope(events[0])
    for df in events[1:]:
        combined = combined.unionByName(envelope(df), allowMissingColumns=True)
    return combined


def in_order(events: DataFrame) -> DataFrame:
    """Sorted by log id."""
    return events.orderBy("id")


def dedupe_events(events: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """One row per log id, for events delivered more than once."""
    return events.dropDuplicates(list(keys))


def batch_events(
    events: DataFrame, consumer: Sequence[str], *, size: int = 200, span: int = SPAN
) -> DataFrame:
    """Hand events to consumer runs, at most ``size`` per run, in log order.

    One row per run: the consumer's columns, ``batch`` (from 0), ``n_events`` and ``events``, a sorted array of
    the other columns as structs, log id first. A consumer with more events gets more runs; events without a
    consumer are nobody's.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    events = events.dropna(subset=list(consumer))
    rows = numbered(events, consumer, ["id"], "__n", span_of(S.col("id"), span))
    rows = rows.withColumn("batch", S.floor((S.col("__n") - 1) / size))
    rest = [name for name in events.columns if name not in consumer and name != "id"]
    return rows.groupBy(*consumer, "batch").agg(
        S.count(S.lit(1)).alias("n_events"),
        S.sort_array(S.collect_list(S.struct("id", *rest))).alias("events"),
    )


def match_subscriptions(
    log: DataFrame, subscriptions: DataFrame, *, prefilter: bool = True, branchless: Iterable[str] = ()
) -> DataFrame:
    """Log rows that concern each of many subscriptions: ``sub_id``, ``event``, the log's columns and ``changed_fields``.

    The product of ``match_criteria`` and membership, for callers that want a row for each subscriber; see
    ``subscriptions`` for what a subscription is and for tables that don't grow with the subscribers.
    """
    criteria, membership = interned(subscriptions, branchless)
    return delivered(match_criteria(log, criteria, prefilter=prefilter), membership)
