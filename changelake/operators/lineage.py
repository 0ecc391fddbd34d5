"""Lineage: run roll-ups, parents, restarts, source versions and scopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as S

from changelake.functions.codes import (
    DEFAULT_BRANCH_ID,
    DEFAULT_SPACE_ID,
    FAILED_STATES,
    RUN_STATUS,
    run_status,
    run_status_code,
)
from changelake.functions.references import flow_reference, task_reference, transform_key, valid_scope  # noqa: F401
from changelake.plans.joins import lookup, touched
from changelake.plans.segments import SPAN, numbered, span_of

FLOW_REFERENCE_TYPE = "flow_run"


def latest_flow_run(runs: DataFrame, reference_type: str | None = None) -> DataFrame:
    """The newest run per reference, leaving out the archive and the trash.

    A maximum per reference instead of a window: it combines before the shuffle, so a reference with very many
    runs is no hot spot.
    """
    kept = runs.where((S.col("branch_id") >= DEFAULT_BRANCH_ID) & S.col("reference").isNotNull())
    if reference_type is not None:
        kept = kept.where(S.col("reference_type") == reference_type)
    newest = S.max_by(S.struct(*[S.col(c) for c in runs.columns]), S.struct("created_at", "id")).alias("run")
    return kept.groupBy("reference").agg(newest).select("run.*")


def attach_parents(steps: DataFrame, flows: DataFrame, *, on: str = "flow_reference") -> DataFrame:
    """Add ``flow_run_id``: the flow run whose reference a step names; null for none."""
    table = flows.select(S.col("reference").alias("__reference"), S.col("id").alias("flow_run_id"))
    return lookup(steps, table, {on: "__reference"})


def orphan_steps(steps: DataFrame, flows: DataFrame, *, on: str = "flow_reference") -> DataFrame:
    """Steps that name a flow run which doesn't exist."""
    table = flows.select(S.col("reference").alias("__reference")).distinct()
    return lookup(steps.where(S.col(on).isNotNull()), table, {on: "__reference"}, "left_anti")


def flow_outcome(
    task_states: DataFrame, members: DataFrame | None = None, own_task: str | None = None, scopes: DataFrame | None = None
) -> DataFrame:
    """``(run_id[, scope], outcome)``: ``errored`` if a member task failed in any map index, else ``completed``.

    Without a list of members, every task but ``own_task`` is one. ``scopes`` (``run_id``, ``scope``) lists those to be
    reported even if they have no member.
    """
    failed = S.coalesce(S.col("state").isin(list(FAILED_STATES)), S.lit(False))
    outcome = S.when(S.bool_or(S.col("__failed")), "errored").otherwise("completed").alias("outcome")
    if members is None:
        counts = S.lit(True) if own_task is None else ~S.col("task_id").eqNullSafe(S.lit(own_task))
        return task_states.select("run_id", (failed & counts).alias("__failed")).groupBy("run_id").agg(outcome)
    failures = task_states.where(failed).select(S.col("run_id").alias("__run"), S.col("task_id").alias("__task")).distinct()
    failures = failures.withColumn("__failed", S.lit(True))
    rows = lookup(members, failures, {"run_id": "__run", "task_id": "__task"})
    rows = rows.select("run_id", "scope", S.coalesce(S.col("__failed"), S.lit(False)).alias("__failed"))
    if scopes is not None:
        rows = rows.unionByName(scopes.select("run_id", "scope", S.lit(False).alias("__failed")))
    return rows.groupBy("run_id", "scope").agg(outcome)


def close_runs(runs: DataFrame, outcomes: DataFrame, finished_at: str = "finished_at") -> DataFrame:
    """Give the runs with an outcome its status code and finish time; other runs stay as they are.

    ``outcomes`` has ``run_id``, ``outcome`` and optionally ``finished_at``; without it, the time is now.
    """
    now = S.col(finished_at) if finished_at in outcomes.columns else S.to_timestamp_ntz(S.current_timestamp())
    ends = outcomes.select(S.col("run_id").alias("__run"), run_status_code(S.col("outcome")).alias("__code"), now.alias("__end"))
    if "finished_at" not in runs.columns:
        runs = runs.withColumn("finished_at", S.lit(None).cast(ends.schema["__end"].dataType))
    columns = runs.columns
    joined = lookup(runs, ends, {"id": "__run"})
    closed = S.col("__code").isNotNull()
    return joined.withColumns(
        {
            "_status_code": S.when(closed, S.col("__code")).otherwise(S.col("_status_code")),
            "finished_at": S.when(closed, S.col("__end")).otherwise(S.col("finished_at")),
        }
    ).select(*columns)


def _existing(runs: DataFrame, starts: DataFrame) -> DataFrame:
    """Starts with the newest run of their reference: ``__run_id`` and what it is on."""
    known = latest_flow_run(touched(runs, "reference", starts, "reference")).select(
        S.col("reference").alias("__reference"), S.col("id").alias("__run_id"),
        S.col("space_id").alias("__space"), S.col("branch_id").alias("__branch"),
    )
    return lookup(starts, known, {"reference": "__reference"})


def apply_attempts(runs: DataFrame, starts: DataFrame) -> DataFrame:
    """Runs after flow starts: a start with a known reference restarts that run, others become new runs.

    ``starts`` has ``reference``, ``started_at`` and the columns of new runs (``id`` at least), one row per
    reference. A restarted run gets the start time and status *restarted*, and its finish time is cleared. A
    start that would change the run's space or branch changes nothing; see ``restart_conflicts``.
    """
    columns = list(runs.columns)
    for name in ("started_at", "finished_at"):
        if name not in columns:
            runs = runs.withColumn(name, S.lit(None).cast(starts.schema["started_at"].dataType))
            columns.append(name)
    matched = _existing(runs, starts)
    conflicts = _conflict(starts)
    restarts = matched.where(S.col("__run_id").isNotNull() & ~conflicts).select(
        S.col("__run_id").alias("__restarted"), S.col("started_at").alias("__started_at")
    )
    again = S.col("__started_at").isNotNull()
    kept = lookup(runs, restarts, {"id": "__restarted"}).withColumns(
        {
            "started_at": S.when(again, S.col("__started_at")).otherwise(S.col("started_at")),
            "finished_at": S.when(~again, S.col("finished_at")),
            "_status_code": S.when(again, S.lit(RUN_STATUS["restarted"])).otherwise(S.col("_status_code")),
        }
    )
    new = matched.where(S.col("__run_id").isNull()).drop("__run_id", "__space", "__branch")
    new = new.withColumn("_status_code", S.lit(RUN_STATUS["started"]))
    return kept.select(*columns).unionByName(new.select(*[c for c in columns if c in new.columns]), allowMissingColumns=True)


def _conflict(starts: DataFrame):
    def differs(column: str, current: str):
        if column not in starts.columns:
            return S.lit(False)
        return S.col(column).isNotNull() & ~S.col(column).eqNullSafe(S.col(current))

    return differs("space_id", "__space") | differs("branch_id", "__branch")


def restart_conflicts(runs: DataFrame, starts: DataFrame) -> DataFrame:
    """Starts that would move an existing run: ``reference, run_id, space_conflict, branch_conflict``."""
    matched = _existing(runs, starts).where(S.col("__run_id").isNotNull() & _conflict(starts))

    def conflict(column: str, current: str):
        if column not in starts.columns:
            return S.lit(False)
        return S.col(column).isNotNull() & ~S.col(column).eqNullSafe(S.col(current))

    return matched.select(
        "reference",
        S.col("__run_id").alias("run_id"),
        conflict("space_id", "__space").alias("space_conflict"),
        conflict("branch_id", "__branch").alias("branch_conflict"),
    )


def inherit_scope(steps: DataFrame, flows: DataFrame, *, on: str = "initiated_by_run_id") -> DataFrame:
    """Space and branch a step ends up with: its own, else its flow's unless that is the default, else null.

    Adds ``effective_space_id`` and ``effective_branch_id``.
    """
    table = flows.select(
        S.col("id").alias("__flow"), S.col("space_id").alias("__space"), S.col("branch_id").alias("__branch")
    )

    def inherited(own: str, flow: str, default: int):
        return S.coalesce(S.col(own), S.when(S.col(flow) != default, S.col(flow)))

    return (
        lookup(steps, table, {on: "__flow"})
        .withColumns(
            {
                "effective_space_id": inherited("space_id", "__space", DEFAULT_SPACE_ID),
                "effective_branch_id": inherited("branch_id", "__branch", DEFAULT_BRANCH_ID),
            }
        )
        .drop("__space", "__branch")
    )


def invalid_branch_runs(runs: DataFrame) -> DataFrame:
    """Runs on the archive or in the trash, where none may be."""
    return runs.where(S.col("branch_id") < DEFAULT_BRANCH_ID)


def version_transforms(observations: DataFrame, *, order: str = "obs", span: int = SPAN) -> DataFrame:
    """Which version of which transform each observed source is.

    ``observations`` has ``key``, ``source`` and a unique integer ``order``. A source seen before belongs to
    the transform it was first seen under, with that key; a new source under a known key is its next version.
    Returns ``order, transform_key, version, is_latest``.
    """
    rows = observations.select(order, "key", S.sha2("source", 256).alias("hash"))
    first = rows.groupBy("hash").agg(S.min(order).alias("__first"), S.min_by("key", order).alias("transform_key"))
    segment = span_of(S.col("__first"), span)
    versions = numbered(first, ["transform_key"], ["__first"], "version", segment, "__versions").select(
        S.col("hash").alias("__hash_of"),
        "transform_key",
        "version",
        (S.col("version") == S.col("__versions")).alias("is_latest"),
    )
    return lookup(rows, versions, {"hash": "__hash_of"}).select(order, "transform_key", "version", "is_latest")


def scope_boundary(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Whether each member of a scope is a root (nothing upstream in the scope) or a leaf (nothing downstream).

    ``members``: one row ``run_id, scope, task_id`` per member; ``edges``: ``run_id, upstream, downstream``.
    """
    keys = ["run_id", "scope", "task_id"]
    scopes = members.select(*keys)
    down = edges.join(
        scopes.select("run_id", "scope", S.col("task_id").alias("downstream")), ["run_id", "downstream"]
    )
    inside = down.join(
        scopes.select("run_id", "scope", S.col("task_id").alias("upstream")), ["run_id", "scope", "upstream"]
    )
    # an edge says that its upper end is no leaf and its lower end no root
    ends = S.explode(
        S.array(
            S.struct(S.col("upstream").alias("task_id"), S.lit(False).alias("root"), S.lit(True).alias("above")),
            S.struct(S.col("downstream").alias("task_id"), S.lit(True).alias("root"), S.lit(False).alias("above")),
        )
    )
    marks = inside.select("run_id", "scope", ends.alias("end")).select(
        "run_id", "scope", S.col("end.task_id").alias("task_id"), S.col("end.root").alias("below"), S.col("end.above").alias("above")
    )
    members_and_marks = scopes.withColumns({"below": S.lit(False), "above": S.lit(False)}).unionByName(marks)
    return members_and_marks.groupBy(*keys).agg(
        (~S.bool_or("below")).alias("is_root"), (~S.bool_or("above")).alias("is_leaf")
    )


def scope_conflicts(scopes: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Misused scopes: ``(dag_id, scope, problem)`` for an id used twice in a DAG and for a scope without tasks.

    ``scopes``: one row ``(dag_id, scope)`` per declared scope; ``members``: ``(dag_id, scope)`` per task.
    """
    twice = scopes.groupBy("dag_id", "scope").agg(S.count(S.lit(1)).alias("n")).where(S.col("n") > 1)
    report = twice.select("dag_id", "scope", S.lit("duplicate").alias("problem"))
    if members is None:
        return report
    used = members.select("dag_id", "scope").distinct()
    empty = scopes.select("dag_id", "scope").distinct().join(used, ["dag_id", "scope"], "left_anti")
    return report.unionByName(empty.withColumn("problem", S.lit("empty")))


def instance_mismatches(steps: DataFrame, flows: DataFrame, *, on: str = "initiated_by_run_id") -> DataFrame:
    """Steps that ran on another instance than their flow run; an unknown instance passes.

    Adds ``flow_instance``.
    """
    table = flows.select(S.col("id").alias("__flow"), S.col("instance").alias("flow_instance"))
    return lookup(steps, table, {on: "__flow"}, "inner").where(S.col("instance") != S.col("flow_instance"))


def flow_report(runs: DataFrame) -> DataFrame:
    """Per flow run: its status, and how many of its steps there are, completed, errored and still open."""
    code = S.col("_status_code")
    steps = (
        runs.where(S.col("initiated_by_run_id").isNotNull())
        .groupBy(S.col("initiated_by_run_id").alias("__flow"))
        .agg(
            S.count(S.lit(1)).alias("n_steps"),
            S.count_if(code == RUN_STATUS["completed"]).alias("n_completed"),
            S.count_if(code == RUN_STATUS["errored"]).alias("n_errored"),
            S.count_if(code < RUN_STATUS["completed"]).alias("n_open"),
        )
    )
    flows = runs.where(S.col("initiated_by_run_id").isNull())
    joined = lookup(flows, steps, {"id": "__flow"})
    counts = [S.coalesce(c, S.lit(0)).alias(c) for c in ("n_steps", "n_completed", "n_errored", "n_open")]
    return joined.select(S.col("id").alias("flow_run_id"), "reference", run_status(code).alias("status"), *counts)
