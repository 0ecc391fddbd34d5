"""The event operators on a stream of log rows.

Events need the *current* records, and status changes need the record's next change, so a micro-batch is
handled as a batch (``foreachBatch``) whose tables are read anew. Output files are named by the batch, so a
batch that is repeated after a failure replaces its own output instead of adding to it.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as S
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from changelake.operators.changes import upload_completions
from changelake.operators.delivered import SCHEMA, add_delivered, no_intervals, undelivered
from changelake.operators.events import (
    artifact_events,
    block_events,
    custom_events,
    match_subscriptions,
    record_events,
    status_events,
)
from changelake.operators.subscriptions import match_criteria
from changelake.plans.segments import SPAN
from changelake.sources.catalog import Catalog

Sink = Callable[[DataFrame, int], None]


def parquet_sink(path: str) -> Sink:
    """Write each batch to its own folder ``batch=<id>``; a repeated batch overwrites it."""

    def write(events: DataFrame, batch_id: int) -> None:
        events.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


class _Completions:
    """The ends of uploads a stream has passed, so that a micro-batch needn't read the log behind it.

    Each batch leaves a folder with its own; every ``every``-th one holds all up to it. What lies behind the
    first batch is read once. A repeated batch overwrites its folder and sees the same folders before it.
    """

    schema = "sqlrecord_id long, first_completion long, last_completion long, batch int"

    def __init__(self, catalog: Catalog, table_name: str, path: str, every: int = 50) -> None:
        self.catalog, self.table_name, self.path, self.every = catalog, table_name, path, every

    @staticmethod
    def _merged(*parts: DataFrame) -> DataFrame:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.groupBy("sqlrecord_id").agg(
            S.min("first_completion").alias("first_completion"), S.max("last_completion").alias("last_completion")
        )

    def advance(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Note the batch's completions; return those known in it: before, in and behind it in the log."""
        log, start = self.catalog.log(), batch.agg(S.min("id")).first()[0]
        ahead = log.where(S.col("id") >= start) if start is not None else log.limit(0)
        parts = [upload_completions(batch, self.table_name)]
        if batch_id == 0:
            passed = upload_completions(log.where(S.col("id") < start) if start is not None else log, self.table_name)
        else:
            base = (batch_id - 1) // self.every * self.every
            stored = batch.sparkSession.read.schema(self.schema).parquet(self.path)
            passed = stored.where(S.col("batch").between(base, batch_id - 1)).drop("batch")
        if batch_id % self.every == 0:
            parts.append(passed)
        self._merged(*parts).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return self._merged(passed, upload_completions(ahead, self.table_name))


def batch_operator(
    kind: str, catalog: Catalog, state: str | None = None, **options: Any
) -> Callable[[DataFrame, int], DataFrame]:
    """The operator of a kind of events as a function of a batch of log rows and its number."""
    if kind == "record":
        return lambda log, _: record_events(catalog, log=log, only_touched=True, **options)
    if kind == "artifact":
        registry = catalog.registry(options.get("registry", "artifact"))
        done = _Completions(catalog, registry.table_name, state) if state else None

        def artifacts(log: DataFrame, batch_id: int) -> DataFrame:
            known = done.advance(log, batch_id) if done else None
            return artifact_events(catalog, log=log, completions=known, only_touched=True, **options)

        return artifacts
    if kind == "status":
        return lambda log, _: status_events(catalog, log=log, later=catalog.log(), **options)
    if kind == "block":
        return lambda log, _: block_events(catalog, log=log, **options)
    if kind == "subscriptions":
        return lambda log, _: match_subscriptions(log, **options)
    if kind == "criteria":
        return lambda log, _: match_criteria(log, **options)
    if kind == "custom":
        return lambda log, _: custom_events(catalog, log=log, **options)
    raise ValueError(f"unknown kind {kind!r}; known: record, artifact, status, block, subscriptions, criteria, custom")


def stream_events(
    kind: str,
    log_stream: DataFrame,
    catalog: Catalog,
    sink: Sink | str,
    checkpoint: str,
    *,
    interval: str | None = None,
    **options: Any,
) -> StreamingQuery:
    """Run an event operator continuously.

    Events of a batch are written before its position is committed: at least once, exactly once with the
    Parquet sink. Without ``interval``, what is there is read and the query ends. A batch reads the log from
    its own start on, so let the batch operator report a long past and start the stream behind it.

    The kind ``subscriptions`` serves a whole table of watchers from one stream: start it at the least of their
    positions and give each its own as ``start_id``. ``criteria`` writes the matches of distinct criteria only, as many
    for any number of watchers; ``subscriptions.delivered`` and ``totals`` take each watcher's from them.
    """
    write = parquet_sink(sink) if isinstance(sink, str) else sink
    operator = batch_operator(kind, catalog, f"{checkpoint.rstrip('/')}-completions", **options)
    reused = kind in ("record", "artifact", "status")  # these read a batch more than once

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist() if reused else batch
        try:
            write(operator(batch, batch_id), batch_id)
        finally:
            if reused:
                batch.unpersist()

    writer = log_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def dedupe_stream(
    events: DataFrame, delay: str, *, time: str = "created_at", keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Drop repeated rows that arrive within ``delay`` of each other."""
    if not isinstance(events.schema[time].dataType, T.TimestampType):
        events = events.withColumn(time, S.col(time).cast("timestamp"))
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def deliver_once(
    events: DataFrame, sink: Sink | str, checkpoint: str, *, interval: str | None = None, span: int = SPAN
) -> StreamingQuery:
    """Events of a stream whose log id hasn't been delivered before, whatever the delay.

    The ids delivered so far are a table of intervals next to the checkpoint, written anew with each batch; a repeated
    batch starts from the same one and replaces its own output.
    """
    write = parquet_sink(sink) if isinstance(sink, str) else sink
    folder = f"{checkpoint.rstrip('/')}-delivered"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = spark.read.schema(SCHEMA).parquet(f"{folder}/batch={batch_id - 1}") if batch_id else no_intervals(spark)
        batch = batch.persist()
        try:
            write(undelivered(batch, known, span), batch_id)
            add_delivered(known, batch.select("id"), span).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _least_ids(n: int, keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each gate in a batch of rows: how many it has, and its ``n`` least ids.

    Runs where the rows are read, so a hot gate is cut down in every task before its rows meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import Table
        from pyarrow.compute import list_slice

        for batch in batches:
            rows = Table.from_batches([batch]).sort_by("id").group_by(keys, use_threads=False)
            found = rows.aggregate([("id", "count"), ("id", "list")])
            ids = list_slice(found.column("id_list"), 0, n)
            yield from Table.from_arrays(
                [*[found.column(key) for key in keys], found.column("id_count"), ids], names=[*keys, "total", "ids"]
            ).to_batches()

    return run


def _fire_once(n: int, keys: list[str]) -> StatefulProcessor:
    """Counts a gate's events and reports the id of the ``n``-th, once.

    A class made in a function travels to the Python workers whole, so they needn't have this package.
    """

    class FireOnce(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "n long")

        def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
            before = self.seen.get()[0] if self.seen.exists() else 0
            if before >= n:
                return
            missing, total, lowest = n - before, 0, []
            for frame in rows:  # never more than the missing ids are kept
                total += int(frame["total"].sum())
                for ids in frame["ids"]:
                    lowest = heapq.nsmallest(missing, [*lowest, *ids])
            self.seen.update((min(before + total, n),))
            if before + total >= n:
                yield pd.DataFrame({**dict(zip(keys, [[k] for k in key], strict=True)), "opened_at": [int(lowest[-1])]})

        def close(self) -> None:
            pass

    return FireOnce()


def stream_gate(events: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """One row per gate, when its running count of events reaches ``n``: the keys and ``opened_at``, the log id
    of the ``n``-th event. Micro-batches must follow the log's order.

    A gate's rows are added up in two levels: in every task that reads some, to a count and the ``n`` least ids, and then
    in the gate's state.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    own = [events.schema[key] for key in keys]
    schema = T.StructType([*own, T.StructField("opened_at", T.LongType())])
    partial = T.StructType([*own, T.StructField("total", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))])
    return (
        events.select(*keys, S.col("id").cast("bigint").alias("id"))
        .mapInArrow(_least_ids(n, list(keys)), partial)
        .groupBy(*keys)
        .transformWithStateInPandas(_fire_once(n, list(keys)), schema, outputMode="Append", timeMode="None")
    )
