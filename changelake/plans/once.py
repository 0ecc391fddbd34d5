"""Computing a column once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    A filter on a column made by ``withColumn`` is moved below it and computes the expression again, and so
    does every expression built on it: JSON would be parsed many times per row, and the generated code outgrow
    what the JVM compiles. Columns of a generator stay where they are; this one makes one row from one row.
    """
    return df.select("*", F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, for use inside an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
