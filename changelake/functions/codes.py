"""Enumerations stored as codes, and the columns that translate them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Branch status names and the codes stored in `_status_code`.
BRANCH_STATUS = {"closed": -2, "merged": -1, "standalone": 0, "draft": 1, "review": 2}

# Run status names and the codes stored in `_status_code`.
RUN_STATUS = {"scheduled": -3, "restarted": -2, "started": -1, "completed": 0, "errored": 1, "aborted": 2}

# Ids of the branches that always exist, and of the default space.
SPECIAL_BRANCHES = {"main": 1, "archive": 0, "trash": -1}
DEFAULT_BRANCH_ID = 1
DEFAULT_SPACE_ID = 1

# Record events in reporting order, and the raw log event each stands for.
RECORD_EVENTS = ("created", "updated", "deleted")
RAW_EVENTS = {"INSERT": "created", "UPDATE": "updated", "DELETE": "deleted"}

# Kinds of branch blocks, artifacts and transforms.
BLOCK_KINDS = ("comment", "readme")
ARTIFACT_KINDS = ("dataset", "model", "plan")
TRANSFORM_KINDS = ("pipeline", "notebook", "script", "function")

# Kinds of artifacts made by the recording system itself. Name the ones of your system here or pass
# `internal_kinds` to the operators.
INTERNAL_KINDS = ("__internal_run__", "__internal_config__")

# States of a task that make its flow run fail.
FAILED_STATES = ("failed", "upstream_failed")


def name_of(code: Column, codes: Mapping[str, int], default: str | None = None) -> Column:
    """Translate a code to its name; ``default`` for null and unknown codes."""
    result = F.lit(default).cast("string")
    for name, value in codes.items():
        result = F.when(code == value, F.lit(name)).otherwise(result)
    return result


def code_of(name: Column, codes: Mapping[str, int]) -> Column:
    result = F.lit(None).cast("int")
    for known, value in codes.items():
        result = F.when(name == known, F.lit(value)).otherwise(result)
    return result


def branch_status(code: Column) -> Column:
    """Branch status name; null and unknown codes are ``standalone``."""
    return name_of(code, BRANCH_STATUS, "standalone")


def run_status(code: Column) -> Column:
    """Run status name; null for an unknown code."""
    return name_of(code, RUN_STATUS)


def run_status_code(name: Column) -> Column:
    return code_of(name, RUN_STATUS)


def is_internal(kind: Column, internal_kinds: Iterable[str] = INTERNAL_KINDS) -> Column:
    """Whether an artifact kind is one of the recording system's own. Never null."""
    return F.coalesce(kind.isin(list(internal_kinds)), F.lit(False))


def as_list(value: str | Iterable[str] | None) -> list[str] | None:
    """One name or several, as a list; ``None`` stays ``None``."""
    if value is None:
        return None
    return [value] if isinstance(value, str) else list(value)


def check_names(value: str | Iterable[str] | None, allowed: Iterable[str], what: str) -> list[str] | None:
    """``as_list`` after checking every name."""
    names = as_list(value)
    unknown = [name for name in names or [] if name not in set(allowed)]
    if unknown:
        raise ValueError(f"{what}: {unknown} not among {sorted(allowed)}")
    return names
