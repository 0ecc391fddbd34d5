"""Log ids delivered so far, as disjoint intervals: repeats are told after any delay, and a dense log stays a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as S

from changelake.plans.segments import SPAN, span_of

SCHEMA = "segment bigint, first_id bigint, last_id bigint"


def no_intervals(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def add_delivered(intervals: DataFrame, ids: DataFrame, span: int = SPAN) -> DataFrame:
    """The intervals with more ids (column ``id``) in them: ``segment``, ``first_id`` and ``last_id``.

    Intervals end at multiples of ``span``, so that no task sees more than the ids between two of them. Repeated ids go
    before they move, and null ids are nobody's.
    """
    own = ids.where(S.col("id").isNotNull()).select(S.col("id").cast("bigint").alias("first_id")).distinct()
    own = own.select(span_of(S.col("first_id"), span).alias("segment"), "first_id", S.col("first_id").alias("last_id"))
    rows = intervals.select("segment", "first_id", "last_id").unionByName(own)
    order = W.partitionBy("segment").orderBy("first_id", "last_id")
    before = S.max("last_id").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("__new", S.coalesce(S.col("first_id") > before + 1, S.lit(True)).cast("int"))
    rows = rows.withColumn("__run", S.sum("__new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = rows.groupBy("segment", "__run").agg(S.min("first_id").alias("first_id"), S.max("last_id").alias("last_id"))
    return merged.select("segment", "first_id", "last_id")


def undelivered(events: DataFrame, intervals: DataFrame, span: int = SPAN) -> DataFrame:
    """One row of each log id that is in no interval; events without an id are dropped.

    Events and the intervals of their segment are sorted together, and an event is in an interval if the last one that
    begins before it doesn't end before it.
    """
    once = events.where(S.col("id").isNotNull()).dropDuplicates(["id"])
    names = once.columns
    rows = once.withColumns({"__at": S.col("id").cast("bigint"), "__last": S.lit(None).cast("bigint")})
    known = intervals.select(S.col("first_id").alias("__at"), S.col("last_id").alias("__last"))
    both = rows.unionByName(known, allowMissingColumns=True).withColumn("__segment", span_of(S.col("__at"), span))
    order = W.partitionBy("__segment").orderBy("__at", S.col("__last").isNull())
    reached = S.max("__last").over(order.rowsBetween(W.unboundedPreceding, 0))
    both = both.withColumn("__reached", reached)
    fresh = S.col("__last").isNull() & S.coalesce(S.col("__reached") < S.col("__at"), S.lit(True))
    return both.where(fresh).select(*names)
