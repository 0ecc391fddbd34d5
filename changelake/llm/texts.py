"""Columns of text that several operators use: words, lines and keys of lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``[\x20\x09-\x0D]``, what separates words.
SPACES = " \t\n\x0b\f\r"
SPACE_PATTERN = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """All runs of ``[^\\x20\\x09-\\x0D]``; a null text has none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed != "", F.split(trimmed, SPACE_PATTERN)).otherwise(F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case and nothing else; texts of other letters take the slower way."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, capitals, capitals.lower()))


def lines(text: Column) -> Column:
    """The text split at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def set_aside(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """The table with columns of these names under other ones, and the columns that bring all of its own back."""
    taken = {name.lower() for name in names}
    own = {name: f"__own_{name}" for name in docs.columns if name.lower() in taken}
    return docs.withColumnsRenamed(own), [F.col(own.get(name, name)).alias(name) for name in docs.columns]
