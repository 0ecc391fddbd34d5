"""Reading the write log: what a logged write means.

A log row says that a record was inserted, updated or deleted. ``data`` holds the *previous* values of the
changed fields for an update, the whole previous row for a delete, and is null for an insert.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as S

from changelake.functions import jsoncols as J
from changelake.functions.codes import RAW_EVENTS
from changelake.plans.filters import FilterExpression
from changelake.plans.joins import lookup
from changelake.plans.matching import local_predicate, previous_row_matches
from changelake.plans.once import computed_once
from changelake.plans.segments import SPAN, lead_once, lead_value
from changelake.sources.schemas import SUMMARY_FIELDS

STATUS_FIELD = "_status_code"


def read_log(
    log: DataFrame,
    filter: FilterExpression | None = None,
    *,
    after_id: int | None = None,
    limit: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """Log rows after a position, filtered; sorted by id when a limit is given."""
    if after_id is not None:
        log = log.where(S.col("id") > after_id)
    if filter is not None:
        log = log.where(local_predicate(log, filter))
    if limit is None:
        return log
    return log.orderBy(S.col("id").desc() if descending else S.col("id").asc()).limit(limit)


def filter_deleted(log: DataFrame, filter: FilterExpression | None) -> DataFrame:
    """Deletes whose previous row matches a filter on direct fields."""
    rows = with_parsed_data(log.where(S.col("event_type") == "DELETE"))
    return rows.where(previous_row_matches(filter, S.col("__data"))).drop("__data")


def latest_id(log: DataFrame) -> DataFrame:
    """One row with the newest log id, 0 for an empty log."""
    return log.agg(S.coalesce(S.max("id"), S.lit(0)).alias("latest_id"))


def previous_values(data: Column | None = None) -> Column:
    """Previous values as JSON object text, ``{}`` when nothing was logged."""
    return S.coalesce(S.col("data") if data is None else data, S.lit("{}"))


def changed_fields() -> Column:
    """Sorted names of the fields an update changed; empty for other writes."""
    return S.when(S.col("event_type") == "UPDATE", J.object_keys(S.col("data"))).otherwise(
        S.array().cast("array<string>")
    )


def summary(log: DataFrame) -> Column:
    """The known fields of a log row but its previous values, as a struct."""
    return S.struct(*[S.col(name) for name in SUMMARY_FIELDS if name in log.columns])


def parsed_data() -> Column:
    return J.parsed(S.col("data"))


def with_parsed_data(log: DataFrame) -> DataFrame:
    """Add ``__data``: the previous values as a variant, parsed once."""
    return computed_once(log, __data=parsed_data())


def moved(data: Column) -> Column:
    """Whether an update changed the branch."""
    previous = J.member(data, "branch_id")
    return previous.isNotNull() & ~J.as_long(previous).eqNullSafe(S.col("branch_id"))


def raw_event() -> Column:
    """``created``, ``updated`` or ``deleted`` by the kind of write alone; null for other kinds."""
    event = S.lit(None).cast("string")
    for kind, name in RAW_EVENTS.items():
        event = S.when(S.col("event_type") == kind, S.lit(name)).otherwise(event)
    return event


def record_event(branch: int | None, data: Column | None = None) -> Column:
    """What a write means for a branch, null when nothing.

    A record is *created* on a branch by an insert or by moving onto it, *deleted* by a delete or by moving
    off it, and *updated* by any other update of a record on the branch. ``None`` gives ``raw_event``.
    ``data`` is the parsed ``data`` column, if it has been parsed already.
    """
    if branch is None:
        return raw_event()
    data = parsed_data() if data is None else data
    kind, here, moves = S.col("event_type"), S.col("branch_id") == branch, moved(data)
    previous = J.member(data, "branch_id")
    was_here = J.as_long(previous) == branch
    deleted_here = S.when(previous.isNotNull(), was_here).otherwise(here)
    return (
        S.when(kind == "INSERT", S.when(here, "created"))
        .when(
            kind == "UPDATE",
            S.when(moves, S.when(here, "created").when(was_here, "deleted")).otherwise(S.when(here, "updated")),
        )
        .when((kind == "DELETE") & deleted_here, "deleted")
    )


def classify(log: DataFrame, branch: int | None = None) -> DataFrame:
    """Add the column ``event``."""
    if branch is None:
        return log.withColumn("event", raw_event())
    return with_parsed_data(log).withColumn("event", record_event(branch, S.col("__data"))).drop("__data")


def scanned(table_name: str, events: Iterable[str], branch: int | None = None) -> Column:
    """The part of ``candidates`` that reads plain columns only and reaches the scan."""
    events = list(events)
    kind = S.col("event_type")
    kinds = []
    if "created" in events:
        kinds += ["INSERT", "UPDATE"]
    if "updated" in events:
        kinds += ["UPDATE"]
    if "deleted" in events:
        kinds += ["DELETE"] if branch is None else ["DELETE", "UPDATE"]
    wanted = (S.col("table_name") == table_name) & kind.isin(sorted(set(kinds)))
    if branch is None:
        return wanted
    # a record that left the branch is the only kind of write logged on another one
    return wanted & ((S.col("branch_id") == branch) | (S.lit("deleted" in events) & (kind == "UPDATE")))


def candidates(
    table_name: str,
    events: Iterable[str],
    branch: int | None = None,
    wait_for_upload: bool = False,
    data: Column | None = None,
) -> Column:
    """Log rows worth reading for these events.

    This is part of the meaning of events on a branch: it also leaves out deletes logged on another branch,
    and moves from no branch unless updates are asked for.
    """
    events = list(events)
    kind = S.col("event_type")
    here = S.lit(True) if branch is None else S.col("branch_id") == branch
    data = parsed_data() if data is None else data
    clauses = []
    if "created" in events:
        clauses.append((kind == "INSERT") & here)
        becoming = []
        if branch is not None:
            becoming.append(~J.is_null(J.member(data, "branch_id")))
        if wait_for_upload:
            becoming.append(~J.is_null(J.member(data, "_aux")))
        if becoming and "updated" not in events:
            clauses.append((kind == "UPDATE") & here & (becoming[0] if len(becoming) == 1 else becoming[0] | becoming[1]))
    if "updated" in events:
        clauses.append((kind == "UPDATE") & here)
    if "deleted" in events:
        clauses.append((kind == "DELETE") & here)
        if branch is not None:
            clauses.append((kind == "UPDATE") & J.equals(J.member(data, "branch_id"), branch))
    wanted = clauses[0]
    for clause in clauses[1:]:
        wanted = wanted | clause
    return (S.col("table_name") == table_name) & wanted


def is_upload_completion(data: Column | None = None) -> Column:
    """Whether an update ended an upload: the previous marker said it was ongoing."""
    aux = J.member(parsed_data() if data is None else data, "_aux")
    return (S.col("event_type") == "UPDATE") & J.ongoing(aux)


def upload_completions(log: DataFrame, table_name: str) -> DataFrame:
    """First and last completion per record: ``(sqlrecord_id, first_completion, last_completion)``.

    That is all the rules for uploads need, and min and max combine before the shuffle.
    """
    # most updates don't touch the marker: a plain text test spares parsing them
    updates = log.where((S.col("table_name") == table_name) & (S.col("event_type") == "UPDATE") & S.col("data").contains("_aux"))
    done = computed_once(updates, __aux=J.member(parsed_data(), "_aux")).where(J.ongoing(S.col("__aux")))
    return done.groupBy("sqlrecord_id").agg(
        S.min("id").alias("first_completion"), S.max("id").alias("last_completion")
    )


def _changes(log: DataFrame, field: str, skip_null: bool) -> DataFrame:
    """Updates that changed the field, with its ``previous_value``."""
    updates = log.where(
        (S.col("event_type") == "UPDATE") & S.col("sqlrecord_id").isNotNull() & S.col("data").contains(field)
    )
    parsed = computed_once(updates, __value=J.member(parsed_data(), field))
    parsed = parsed.where(~J.is_null(S.col("__value")) if skip_null else S.col("__value").isNotNull())
    return parsed.withColumn("previous_value", J.as_long(S.col("__value"))).drop("__value")


def field_transitions(
    log: DataFrame,
    current: DataFrame,
    field: str = STATUS_FIELD,
    *,
    later: DataFrame | None = None,
    skip_null: bool = False,
    span: int = SPAN,
) -> DataFrame:
    """Previous and new value of an integer field for every update that changed it.

    The log holds previous values only. The new value is the previous value of the record's next change, in
    ``log`` or first thing in ``later`` (rows after the last one of ``log``), else the value in ``current``,
    else null. Adds ``previous_value``, ``new_value`` and ``is_resolved``. ``skip_null`` leaves out changes from
    null.
    """
    changes = lead_value(_changes(log, field, skip_null), ["sqlrecord_id"], "id", "previous_value", "__next", span)
    if later is not None:
        end = log.agg(S.max("id")).scalar()
        wanted = _changes(log, field, skip_null).select(S.col("sqlrecord_id").alias("__wanted")).distinct()
        following = (
            _changes(later.where(S.col("id") > end), field, skip_null)
            .join(wanted, S.col("sqlrecord_id") == S.col("__wanted"), "left_semi")
            .groupBy("sqlrecord_id")
            .agg(S.min_by(S.struct(S.col("previous_value").alias("value")), "id").alias("__later"))
        )
        changes = lookup(changes, following, {"sqlrecord_id": "sqlrecord_id"})
        changes = changes.withColumn("__next", S.coalesce("__next", "__later")).drop("__later")
    now = current.select("id", S.struct(S.col(field).cast("bigint").alias("value")).alias("__now"))
    now = now.withColumnRenamed("id", "__current_id")
    changes = lookup(changes, now, {"sqlrecord_id": "__current_id"})
    known = S.coalesce("__next", "__now")
    return changes.withColumns({"new_value": known["value"], "is_resolved": known["value"].isNotNull()}).drop(
        "__next", "__now"
    )


def settle_transitions(
    batch: DataFrame, pending: DataFrame | None = None, field: str = STATUS_FIELD, *, skip_null: bool = False, span: int = SPAN
) -> DataFrame:
    """The changes of an integer field in a batch and those still open before it, each with what the record's next one tells.

    Adds ``previous_value``, ``new_value`` and ``is_open``: a record's last change is open until a later batch has another.
    ``pending`` are the open rows of the batch before, of the same columns; those that stay open are the next ``pending``.
    Batches follow the log's order. The batch is read once.
    """
    rows = _changes(batch, field, skip_null)
    if pending is not None:
        rows = rows.unionByName(pending.select(*rows.columns))
    rows = lead_once(rows, ["sqlrecord_id"], "id", "previous_value", "__next", span)
    return rows.withColumns({"new_value": S.col("__next.value"), "is_open": S.col("__next").isNull()}).drop("__next")


def close_transitions(pending: DataFrame, current: DataFrame, field: str = STATUS_FIELD) -> DataFrame:
    """Open changes with the record's current value as ``new_value``: what ``field_transitions`` gives for each last one."""
    now = current.select(S.col("id").alias("__current_id"), S.col(field).cast("bigint").alias("__now"))
    rows = lookup(pending.drop("new_value"), now, {"sqlrecord_id": "__current_id"})
    return rows.withColumn("new_value", S.col("__now")).drop("__now")
