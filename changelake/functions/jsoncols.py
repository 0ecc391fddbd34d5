"""Column functions for JSON text columns.

JSON is kept as text in tables and parsed where it is read. A value is handled as a *variant*, so that an
absent key (SQL null), a JSON null (variant null) and a typed value stay apart. Only the ``try_`` forms are
used: a malformed text gives null and never stops a job.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def parsed(text: Column) -> Column:
    """The text as a variant, null when it isn't JSON."""
    return F.try_parse_json(text)


def member(variant: Column, *keys: str) -> Column:
    """The value under nested object keys as a variant; null when a key is absent."""
    path = "$" + "".join(f'["{key}"]' for key in keys)
    return F.try_variant_get(variant, path, "variant")


def is_null(variant: Column) -> Column:
    """The key is absent or its value is JSON null."""
    return variant.isNull() | F.is_variant_null(variant)


def type_name(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant), F.lit("VOID"))


def is_string(variant: Column) -> Column:
    return type_name(variant) == "STRING"


def is_number(variant: Column) -> Column:
    return type_name(variant).rlike(_NUMBER)


def as_string(variant: Column) -> Column:
    """A JSON string; other types give null."""
    return F.when(is_string(variant), F.try_variant_get(variant, "$", "string"))


def as_number(variant: Column) -> Column:
    """A JSON number as a double; other types give null."""
    return F.when(is_number(variant), F.try_variant_get(variant, "$", "double"))


def as_long(variant: Column) -> Column:
    """A JSON integer; the string ``"1"`` is not one."""
    return F.when(type_name(variant) == "BIGINT", F.try_variant_get(variant, "$", "bigint"))


def as_boolean(variant: Column) -> Column:
    return F.when(type_name(variant) == "BOOLEAN", F.try_variant_get(variant, "$", "boolean"))


def equals(variant: Column, value) -> Column:
    """Whether a variant is the JSON value ``value``, with no conversion between types. Never null."""
    if value is None:
        return is_null(variant)
    if isinstance(value, bool):
        match = as_boolean(variant) == F.lit(value)
    elif isinstance(value, int):
        match = F.when(
            type_name(variant) == "BIGINT", F.try_variant_get(variant, "$", "bigint") == F.lit(value)
        ).otherwise(as_number(variant) == F.lit(float(value)))
    elif isinstance(value, float):
        match = as_number(variant) == F.lit(value)
    elif isinstance(value, str):
        match = as_string(variant) == F.lit(value)
    else:  # objects and arrays: a variant prints its object keys in one order
        match = F.to_json(variant) == F.to_json(F.parse_json(F.lit(json.dumps(value))))
    return F.coalesce(match, F.lit(False))


def unwrapped(variant: Column) -> Column:
    """Decode a JSON string that itself holds JSON; anything else is returned as it is."""
    inner = F.try_parse_json(F.try_variant_get(variant, "$", "string"))
    return F.when(is_string(variant), F.coalesce(inner, variant)).otherwise(variant)


def decode_json(text: Column) -> Column:
    """Decode a possibly twice-encoded JSON text to plain JSON text; text that isn't JSON stays as it is."""
    value = unwrapped(parsed(text))
    return F.coalesce(F.when(is_string(value), as_string(value)).otherwise(F.to_json(value)), text)


def object_keys(text: Column) -> Column:
    """Sorted keys of a JSON object, an empty array for anything else."""
    return F.coalesce(F.sort_array(F.json_object_keys(text)), F.array().cast("array<string>"))


def ongoing(aux: Column) -> Column:
    """Whether a (possibly encoded) upload marker is an object whose ``so`` is ``1`` or ``true``.

    Read as text and parsed again, an encoded marker is decoded and a plain one stays the same.
    """
    so = member(F.try_parse_json(F.try_variant_get(aux, "$", "string")), "so")
    # type and value in one text: 1.0 prints as 1 but isn't an integer
    return F.coalesce(F.concat(F.schema_of_variant(so), F.to_json(so)).isin("BIGINT1", "BOOLEANtrue"), F.lit(False))


def upload_ongoing(aux_text: Column) -> Column:
    """Whether an artifact's ``_aux`` text says that its upload is still in progress."""
    return ongoing(parsed(aux_text))
