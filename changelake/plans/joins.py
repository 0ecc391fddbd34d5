"""Joins to lookup tables.

Nothing here forces a broadcast: Spark broadcasts a side by its known or measured size
(``spark.sql.autoBroadcastJoinThreshold``) and otherwise does a sort-merge join, whose skewed partitions
adaptive execution splits, also when a single key fills them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hash(df: DataFrame, columns: list[str]) -> Column:
    # the hash of an int and of the equal long differ
    kinds = {c: df.schema[c].dataType for c in columns}
    return F.xxhash64(*[F.col(c).cast("bigint") if isinstance(kinds[c], T.IntegralType) else F.col(c) for c in columns])


def lookup(
    rows: DataFrame, table: DataFrame, on: Mapping[str, str], how: str = "left", only: Column | None = None
) -> DataFrame:
    """Join rows to a table with one row per key, so that a hot key in ``rows`` can be split.

    ``on`` maps columns of ``rows`` to those of ``table``, which are dropped; ``only`` restricts the rows that
    may match. Adaptive execution splits a skewed partition only if both inputs of a join come straight from
    an exchange. A table made by an aggregation or another join may be partitioned by the key already and join
    without one; the hash of the key as a further join key makes Spark exchange it again. It is the smaller
    side.
    """
    left = rows.withColumn("__hash", _hash(rows, list(on)))
    right = table.withColumn("__table_hash", _hash(table, list(on.values())))
    right = right.withColumnsRenamed({c: f"__table_{c}" for c in on.values()})
    condition = F.col("__hash") == F.col("__table_hash")
    for column, key in on.items():
        condition = condition & (rows[column] == F.col(f"__table_{key}"))
    if only is not None:
        condition = condition & only
    joined = left.join(right, condition, how).drop("__hash")
    return joined if how in ("left_semi", "left_anti") else joined.drop("__table_hash", *[f"__table_{c}" for c in on.values()])


def touched(table: DataFrame, key: str, rows: DataFrame, column: str) -> DataFrame:
    """The part of a large table whose key is among the values of a column of few rows.

    The values are few enough to be broadcast, by their size, so the table is scanned but not shuffled.
    """
    values = rows.select(F.col(column).alias("__touched")).distinct()
    return table.join(values, F.col(key) == F.col("__touched"), "left_semi")


def distinct_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct non-null values: duplicates of a hot value go before the shuffle."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias(name)).distinct()
