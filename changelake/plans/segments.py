"""Ordered computations per key that never put a whole key into one task.

``lead`` and ``row_number`` over ``Window.partitionBy(key)`` sort all rows of a key in one task. Here a key's
rows are cut into *segments* along the order: rows of one segment are handled by a window per
``(key, segment)``, and what a segment needs from the others comes from a table with one row per
``(key, segment)``. With a unique integer order and ``span`` order values to a segment, a window holds at most
``span`` rows of a key, and the second table at most ``range / span`` rows of it. Keys and order must not be
null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPAN = 1_000_000
_SEGMENT = "__segment"


def span_of(order: Column, span: int = SPAN) -> Column:
    """Segment of an integer order value: the multiple of ``span`` at or below it."""
    return order - F.pmod(order, F.lit(span))


def _segmented(df: DataFrame, segment: Column) -> DataFrame:
    return df.withColumn(_SEGMENT, segment)


def _attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the per-segment table back; the rows are partitioned by these keys already."""
    return rows.join(summary, [*keys, _SEGMENT], "left").drop(_SEGMENT)


def lead_value(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, span: int = SPAN) -> DataFrame:
    """Add ``out``: a struct with the ``value`` of the key's next row by ``order``; null on the last row."""
    rows = _segmented(df, span_of(F.col(order), span))
    inside = W.partitionBy(*keys, _SEGMENT).orderBy(order)
    rows = rows.withColumn("__inside", F.lead(F.struct(F.col(value).alias("value"))).over(inside))
    first = (
        _segmented(df, span_of(F.col(order), span))
        .groupBy(*keys, _SEGMENT)
        .agg(F.min_by(F.struct(F.col(value).alias("value")), order).alias("__first_value"))
    )
    across = W.partitionBy(*keys).orderBy(_SEGMENT)
    following = first.withColumn("__across", F.lead("__first_value").over(across)).drop("__first_value")
    joined = _attach(rows, following, keys)
    return joined.withColumn(out, F.coalesce("__inside", "__across")).select(*df.columns, out)


def lead_once(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, span: int = SPAN) -> DataFrame:
    """``lead_value`` with the rows read and shuffled once.

    Only the first and last rows of segments look across borders: among these, a last row's next one is the first of the
    next segment. Both parts come from the same exchange.
    """
    rows = _segmented(df, span_of(F.col(order), span))
    inside = W.partitionBy(*keys, _SEGMENT).orderBy(order)
    held = F.struct(F.col(value).alias("value"))
    rows = rows.withColumns({out: F.lead(held).over(inside), "__first": F.lag(F.lit(True)).over(inside).isNull()})
    ends = rows.where(F.col("__first") | F.col(out).isNull())
    across = F.lead(F.struct(F.col(value).alias("value"))).over(W.partitionBy(*keys).orderBy(order))
    ends = ends.withColumn("__across", across).where(F.col(out).isNull()).withColumn(out, F.col("__across"))
    names = [*df.columns, out]
    return rows.where(F.col(out).isNotNull()).select(*names).unionByName(ends.select(*names))


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str, segment: Column, total: str | None = None
) -> DataFrame:
    """Add ``out``: the row number (from 1) per key by ``order``, and ``total``: the key's number of rows.

    ``segment`` must not decrease along ``order``, for example ``span_of(id)`` when ``order`` is the id.
    Without keys, the whole table is numbered; its one-row-per-segment table is all a single task sees.
    """
    rows = _segmented(df, segment)
    inside = W.partitionBy(*keys, _SEGMENT).orderBy(*order)
    rows = rows.withColumn("__local", F.row_number().over(inside).cast("bigint"))
    sizes = _segmented(df, segment).groupBy(*keys, _SEGMENT).agg(F.count(F.lit(1)).alias("__size"))
    across = (W.partitionBy(*keys) if keys else W.partitionBy()).orderBy(_SEGMENT)
    before = F.sum("__size").over(across.rowsBetween(W.unboundedPreceding, -1))
    columns = {"__before": F.coalesce(before, F.lit(0))}
    if total is not None:
        columns[total] = F.sum("__size").over(W.partitionBy(*keys))
    sizes = sizes.withColumns(columns).drop("__size")
    joined = _attach(rows, sizes, keys)
    return joined.withColumn(out, F.col("__local") + F.col("__before")).drop("__local", "__before")


def hashed_segment(column: Column | str, digits: int = 4) -> Column:
    """A segment for any unique column: leading hex digits of its MD5. Number rows by (this, column)."""
    return F.substring(F.md5(F.col(column) if isinstance(column, str) else column), 1, digits)
