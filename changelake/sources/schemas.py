"""Known fields of the tables. Other columns are allowed everywhere and kept."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "time": T.TimestampNTZType()}


def _schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


WRITE_LOG = _schema(
    id="long", uid="string", event_type="string", table_name="string", sqlrecord_id="long", created_at="time",
    created_by_id="long", branch_id="long", space_id="long", run_id="long", data="string",
)
ARTIFACT = _schema(
    id="long", uid="string", key="string", suffix="string", kind="string", branch_id="long", _aux="string"
)
BRANCH = _schema(
    id="long", uid="string", name="string", description="string", _status_code="int", created_by_id="long",
    created_at="time",
)
BRANCH_BLOCK = _schema(id="long", uid="string", branch_id="long", kind="string", content="string")
USER = _schema(id="long", uid="string", handle="string", name="string")
CURSOR = _schema(key="string", value="string")

# fields of a log row that events carry along: all but the previous values
SUMMARY_FIELDS = [field.name for field in WRITE_LOG if field.name != "data"]
