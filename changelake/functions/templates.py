"""Templates in texts, by their syntax: what is a literal, a comment or raw text can't hide or fake a name.

A text is cut into tokens by one regular expression and scanned by a fold, a pushdown scanner whose state is a struct:
the kind of region (text, expression, block, comment, raw), an open quote, the depth of brackets, and the last tokens.
A text whose regions don't all close is no template at all: rendering it fails before anything is read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as S

from changelake.plans.once import let

_TEXT, _EXPRESSION, _BLOCK, _COMMENT, _RAW, _RAW_TAG, _BROKEN = range(7)
#: Escaped quotes, words, runs of what means nothing here, and single characters that may.
_TOKEN = r"""\\['"\\]|[A-Za-z_0-9]+|[^\\'"{}%#()\[\].|=A-Za-z_0-9]+|(?s:.)"""
_BLANK = " \t\n\r"
#: Stand-ins, no characters of any text, for escaped backslashes and quotes while strings are cut out of JSON.
_BACKSLASH, _QUOTE = "\ufdd0", "\ufdd1"


def string_leaves(json: Column) -> Column:
    """The decoded strings of a compact JSON text at any depth, keys left out."""
    marked = S.replace(S.replace(json, S.lit("\\\\"), S.lit(_BACKSLASH)), S.lit('\\"'), S.lit(_QUOTE))
    literals = S.regexp_extract_all(marked, S.lit('"[^"]*+"(?::)?+'), S.lit(0))

    def decoded(literal: Column) -> Column:
        whole = S.replace(S.replace(literal, S.lit(_BACKSLASH), S.lit("\\\\")), S.lit(_QUOTE), S.lit('\\"'))
        return S.try_variant_get(S.try_parse_json(whole), "$", "string")

    return S.array_compact(S.transform(S.filter(literals, lambda x: ~S.endswith(x, S.lit(":"))), decoded))


def _flags(s: Column, t: Column, names: list[str]) -> Column:
    """What a token is in a state."""
    code = s["mode"].isin(_EXPRESSION, _BLOCK) & (s["quote"] == "")
    flat = code & (s["depth"] == 0)
    told = S.translate(t, _BLANK, "") != ""
    no_name = s["last"].isin(".", "|", "is") | ((s["last"] == "not") & (s["before"] == "is"))
    return S.struct(
        code.alias("code"),
        (code & told).alias("told"),
        ((s["mode"] == _TEXT) & (s["p"] == "{") & t.isin("{", "%", "#")).alias("opens"),
        ((s["mode"] == _EXPRESSION) & flat & (s["p"] == "}") & (t == "}")).alias("ends_expression"),
        ((s["mode"] == _BLOCK) & flat & (s["p"] == "%") & (t == "}")).alias("ends_block"),
        ((s["mode"] == _COMMENT) & (s["p"] == "#") & (t == "}")).alias("ends_comment"),
        ((s["mode"] == _RAW) & (s["p"] == "{") & (t == "%")).alias("raw_tag"),
        ((s["mode"] == _RAW_TAG) & (S.translate(t, _BLANK + "-+", "") != "")).alias("in_tag"),
        (code & t.isin(names) & ~no_name).alias("name"),
        (code & (t == "}") & (s["depth"] > 0)).alias("closes"),
        # a keyword argument isn't a name that is read; a parameter of a macro is one
        (code & (s["open"] == 1) & (t == "=") & (s["depth"] > 0) & (s["first"] != "macro")).alias("keyword"),
    )


def _next(s: Column, t: Column, f: Column) -> Column:
    edge = f["opens"] | f["ends_expression"] | f["ends_block"] | f["ends_comment"]
    mode = (
        S.when(f["opens"], S.when(t == "{", _EXPRESSION).when(t == "%", _BLOCK).otherwise(_COMMENT))
        .when(f["ends_block"] & (s["first"] == "raw"), _RAW)
        .when(edge, _TEXT)
        .when(f["code"] & t.startswith("\\"), _BROKEN)  # only strings have escapes
        .when(f["raw_tag"], _RAW_TAG)
        .when(f["in_tag"], S.when(t == "endraw", _BLOCK).otherwise(_RAW))
        .otherwise(s["mode"])
    )
    quote = S.when(s["quote"] != "", S.when(t == s["quote"], "").otherwise(s["quote"])).when(f["code"] & t.isin("'", '"'), t).otherwise("")
    depth = (
        S.when(edge, 0)
        .when(f["code"] & t.isin("(", "[", "{"), s["depth"] + 1)
        .when(f["closes"] | (f["code"] & t.isin(")", "]")), S.greatest(s["depth"] - 1, S.lit(0)))
        .otherwise(s["depth"])
    )
    first = (
        S.when(edge, "")
        .when(f["in_tag"], "/raw")
        .when(f["told"] & (s["mode"] == _BLOCK) & (s["first"] == "") & (S.translate(t, _BLANK + "-+", "") != ""), t)
        .otherwise(s["first"])
    )
    read = S.when(s["open"] == 1, f["told"] & ~f["keyword"]).otherwise((s["open"] == 2) & f["told"] & (t == "="))
    return S.struct(
        mode.cast("int").alias("mode"),
        quote.alias("quote"),
        depth.cast("int").alias("depth"),
        S.when(edge | f["raw_tag"] | f["closes"] | (s["quote"] != ""), "").otherwise(t).alias("p"),
        S.when(edge, "").when(f["told"], t).otherwise(s["last"]).alias("last"),
        S.when(edge, "").when(f["told"], s["last"]).otherwise(s["before"]).alias("before"),
        first.alias("first"),
        S.when(f["name"], 1).when(f["keyword"], 2).when(f["told"], 0).otherwise(s["open"]).cast("int").alias("open"),
        (s["named"] | read).alias("named"),
        (s["any"] | f["ends_expression"] | (f["ends_block"] & ~s["first"].isin("raw", "/raw"))).alias("any"),
    )


def scanned(text: Column, names: Iterable[str] = ()) -> Column:
    """Of a text, the struct ``any`` (it has an expression or a statement) and ``named`` (one that reads one of the names)."""
    wanted = list(names)
    empty = S.lit("")
    start = S.struct(
        S.lit(0).alias("mode"), empty.alias("quote"), S.lit(0).alias("depth"), empty.alias("p"), empty.alias("last"), empty.alias("before"),
        empty.alias("first"), S.lit(0).alias("open"), S.lit(False).alias("named"), S.lit(False).alias("any"),
    )

    def step(s: Column, t: Column) -> Column:
        return let(_flags(s, t, wanted), lambda f: _next(s, t, f))

    def finish(s: Column) -> Column:
        whole = s["mode"] == _TEXT
        return S.struct((whole & s["any"]).alias("any"), (whole & s["named"]).alias("named"))

    return S.aggregate(S.regexp_extract_all(text, S.lit(_TOKEN), S.lit(0)), start, step, finish)
