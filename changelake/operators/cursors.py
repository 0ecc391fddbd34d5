"""Cursor tables: how far each job has read the write log.

A cursor is a row ``(key, value)`` whose value is JSON text ``{"dbwrite_id": ..., "instance_id": ...}``.
"""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as S

from changelake.functions import jsoncols as J
from changelake.operators.changes import latest_id
from changelake.plans.filters import FilterExpression, plain
from changelake.plans.once import computed_once


def load_cursor(cursors: DataFrame, instance: str) -> DataFrame:
    """``(key, dbwrite_id)`` per job. Values that are invalid or of another instance are ignored; of several
    values for a job the smallest counts, so that nothing is missed."""
    parsed = computed_once(cursors, __value=J.parsed(S.col("value")))
    at = J.as_long(J.member(S.col("__value"), "dbwrite_id"))
    valid = (at >= 0) & (J.as_string(J.member(S.col("__value"), "instance_id")) == instance)
    return parsed.where(valid).groupBy("key").agg(S.min(at).alias("dbwrite_id"))


def save_cursor(cursors: DataFrame, positions: DataFrame, instance: str) -> DataFrame:
    """The cursor table after saving ``(key, dbwrite_id)`` rows; jobs that aren't among them stay as they are."""
    value = S.to_json(S.struct("dbwrite_id", S.lit(instance).alias("instance_id")))
    saved = positions.groupBy("key").agg(S.max("dbwrite_id").alias("dbwrite_id")).select("key", value.alias("value"))
    others = cursors.select("key", "value").join(saved.select(S.col("key").alias("__saved")), S.col("key") == S.col("__saved"), "left_anti")
    return others.unionByName(saved)


def start_cursor(jobs: DataFrame, cursors: DataFrame, log: DataFrame, instance: str) -> DataFrame:
    """``(key, start_id)``: the stored position, else the newest log id, so that a new job reports later writes
    only."""
    stored = load_cursor(cursors, instance).withColumnRenamed("key", "__key")
    joined = jobs.select("key").join(stored, S.col("key") == S.col("__key"), "left")
    return joined.select("key", S.coalesce("dbwrite_id", latest_id(log).scalar()).alias("start_id"))


def job_key(kind: str, **watched: Any) -> str:
    """A stable name for a job by what it watches; settings such as batch sizes aren't part of it."""
    def form(value: Any) -> Any:
        return value.to_dict() if isinstance(value, FilterExpression) else plain(value)

    identity = json.dumps({name: form(value) for name, value in watched.items()}, sort_keys=True, default=str)
    return f"{kind}.{hashlib.sha256(identity.encode()).hexdigest()[:16]}"
