"""Shell-style name patterns as regular expressions of the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from changelake.plans.once import let

_SPECIAL = set(r"\.[]{}()+-*?^$|&~#")


def _quoted(char: str) -> str:
    return "\\" + char if char in _SPECIAL else char


def glob_regex(pattern: str) -> str:
    """The anchored regular expression of a case-sensitive glob with ``*``, ``?`` and ``[...]``."""
    out, at = [], 0
    while at < len(pattern):
        char = pattern[at]
        # a closing bracket right after the opening one (or after its negation) is a member of the set
        first = at + 2 if pattern[at + 1 : at + 2] == "!" else at + 1
        end = pattern.find("]", first + 1) if char == "[" else -1
        if char == "*":
            out.append(".*")
        elif char == "?":
            out.append(".")
        elif end > 0:
            members = pattern[first:end]
            body = "".join(c if c == "-" and 0 < i < len(members) - 1 else _quoted(c) for i, c in enumerate(members))
            out.append(f"[{'^' if first == at + 2 else ''}{body}]")
            at = end
        else:
            out.append(_quoted(char))
        at += 1
    return r"^(?s:" + "".join(out) + r")\z"


def glob_any(name: Column, patterns: str | Iterable[str] | None) -> Column:
    """Whether a name matches any of the patterns; without patterns everything matches, a null name never."""
    patterns = [patterns] if isinstance(patterns, str) else list(patterns or [])
    if not patterns:
        return F.lit(True)
    match = F.lit(False)
    for pattern in patterns:
        match = match | name.rlike(glob_regex(pattern))
    return F.coalesce(match, F.lit(False))


#: A set, a wildcard, a run of other characters, or a bracket that opens no set.
_GLOB_TOKEN = r"\[!?+(?s:.)[^\]]*+\]|[*?]|[^*?\[]++|\["
_QUOTE = r"([\\.\[\]{}()+*?^$|&~#])"
_CUT = "\ufdd0"


def glob_columns(pattern: Column) -> Column:
    """Of a column of globs, the struct ``regex`` (as ``glob_regex`` makes it of one), ``piece``, the longest piece without
    wildcards and the first among equals, and ``length``, that of the names it matches, null where it isn't fixed."""

    def is_set(token: Column) -> Column:
        return token.startswith("[") & (F.length(token) > 1)

    def wild(token: Column) -> Column:
        return token.isin("*", "?") | is_set(token)

    def members(token: Column) -> Column:
        negated = F.substr(token, F.lit(2), F.lit(1)) == "!"
        own = F.substr(token, F.when(negated, 3).otherwise(2), F.length(token) - F.when(negated, 3).otherwise(2))
        quoted = F.regexp_replace(own, F.lit(_QUOTE), F.lit(r"\\$1"))
        ends = F.regexp_replace(F.regexp_replace(quoted, F.lit("^-"), F.lit(r"\\-")), F.lit(r"(?<!\\)-\z"), F.lit(r"\\-"))
        return F.concat(F.when(negated, "[^").otherwise("["), ends, F.lit("]"))

    def expression(token: Column) -> Column:
        literal = F.regexp_replace(F.regexp_replace(token, F.lit(_QUOTE), F.lit(r"\\$1")), F.lit("-"), F.lit(r"\\-"))
        return F.when(token == "*", ".*").when(token == "?", ".").when(is_set(token), members(token)).otherwise(literal)

    def described(tokens: Column) -> Column:
        pieces = F.split(F.array_join(F.transform(tokens, lambda t: F.when(wild(t), F.lit(_CUT)).otherwise(t)), ""), _CUT)
        by_length = F.array_sort(F.transform(pieces, lambda p, i: F.struct((-F.length(p)).alias("n"), i.alias("i"), p.alias("p"))))
        sizes = F.aggregate(tokens, F.lit(0), lambda n, t: n + F.when(wild(t), 1).otherwise(F.length(t)))
        return F.struct(
            F.concat(F.lit(r"^(?s:"), F.array_join(F.transform(tokens, expression), ""), F.lit(r")\z")).alias("regex"),
            F.get(by_length, F.lit(0))["p"].alias("piece"),
            F.when(~F.array_contains(tokens, "*"), sizes).alias("length"),
        )

    return let(F.regexp_extract_all(pattern, F.lit(_GLOB_TOKEN), F.lit(0)), described)
