"""Which parameters of a run are recorded: fixed fields of a flow run, and what a step leaves out.

Parameters are a JSON object as text. One from which something is dropped is written anew, compactly and with
its keys sorted; others stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as S

from changelake.functions import jsoncols as J
from changelake.functions.templates import scanned, string_leaves
from changelake.plans.joins import lookup
from changelake.plans.once import computed_once, let

# The template variables secrets come from.
SECRET_NAMES = ("var", "conn")
# braces and percent signs, written as they are or as escapes
_MAY_BE_TEMPLATE = r"(?:\{|\\u007[bB])(?:[{%]|\\u007[bB]|\\u0025)"
#: Characters of a secret's anchor, bits of the map that all anchors are in, characters of a text that are cut at once,
#: and the share of texts, one in so many, that tells which pieces are rare.
GRAM, BITS, CHUNK, SAMPLE = 6, 1 << 18, 256, 64


def _values(params: Column) -> Column:
    """The object as ``map<string, variant>``; null for anything else."""
    return S.try_variant_get(J.parsed(params), "$", "map<string,variant>")


def _kept(params: Column, keep: Callable[[Column, Column], Column], suspect: Column) -> Column:
    """The parameters that ``keep`` lets through; a text that isn't ``suspect`` needn't be parsed."""
    return S.when(suspect, S.to_json(S.map_filter(_values(params), keep))).otherwise(params)


def exclude_params(df: DataFrame, names: Iterable[str], column: str = "params") -> DataFrame:
    """Drop parameters by name; a text that isn't an object becomes null."""
    names = list(names)
    wanted = S.array(*[S.lit(name) for name in names]).cast("array<string>")
    named = S.coalesce(S.arrays_overlap(S.json_object_keys(S.col(column)), wanted), S.lit(True))
    return df.withColumn(column, _kept(S.col(column), lambda key, _: ~key.isin(names), named))


def is_templated(text: Column, mode: str) -> Column:
    """Whether a string in a value's JSON text is a template of the kind: ``secrets``, ``all`` or ``none``.

    Strings are scanned one by one; those without an opening, or without a secret's name, are passed over.
    """
    if mode == "none":
        return S.lit(False)
    if mode not in ("secrets", "all"):
        raise ValueError(f"mode is 'secrets', 'all' or 'none', not {mode!r}")
    secrets = mode == "secrets"
    worth = r"(?s)\{[{%].*\b(?:NAMES)\b".replace("NAMES", "|".join(SECRET_NAMES)) if secrets else r"\{[{%]"
    leaves = S.filter(string_leaves(text), lambda leaf: leaf.rlike(worth))
    return S.exists(leaves, lambda leaf: scanned(leaf, SECRET_NAMES if secrets else ())["named" if secrets else "any"])


def exclude_templated(df: DataFrame, mode: str = "secrets", column: str = "params") -> DataFrame:
    """Drop parameters with a template in them or in anything nested: all, or those that read secrets."""
    if mode == "none":
        return df
    def plain(_: Column, value: Column) -> Column:
        return ~S.coalesce(is_templated(S.to_json(value), mode), S.lit(False))

    return df.withColumn(column, _kept(S.col(column), plain, S.col(column).rlike(_MAY_BE_TEMPLATE)))


def _anchors(secrets: DataFrame, texts: DataFrame) -> DataFrame:
    """Each secret with ``size`` and ``anchor``, the hash of the rarest of its pieces of ``GRAM`` characters.

    A shorter secret is its own piece. How rare a piece is comes from the beginnings of some texts (``SAMPLE``); it decides
    how many places are looked at twice, not what is found.
    """
    size = S.least(S.length("__secret"), S.lit(GRAM))
    pieces = secrets.select("__secret", size.alias("size"), S.explode(S.sequence(S.lit(1), S.length("__secret") - size + 1)).alias("at"))
    pieces = pieces.withColumn("anchor", S.xxhash64(S.substr("__secret", S.col("at"), S.col("size"))))
    sizes = secrets.agg(S.collect_set(size)).scalar()  # at most as many as ``GRAM``
    sampled = texts.where(S.pmod(S.xxhash64("text"), S.lit(SAMPLE)) == 0).select(S.explode(_chunks(S.substr("text", S.lit(1), S.lit(CHUNK)))).alias("chunk"))
    usual = _places(sampled, sizes).groupBy(S.col("hash").alias("__hash")).agg(S.count(S.lit(1)).alias("n"))
    rated = lookup(pieces, usual, {"anchor": "__hash"})
    best = S.min_by(S.struct("size", "anchor"), S.struct(S.coalesce("n", S.lit(0)), "at"))
    return rated.groupBy("__secret").agg(best.alias("best")).select("__secret", "best.size", "best.anchor")


def _chunks(text: Column) -> Column:
    """A text in pieces of ``CHUNK`` characters, each with the beginning of the next."""

    def joined(parts: Column) -> Column:
        def with_next(part: Column, i: Column) -> Column:
            return S.concat(part, S.coalesce(S.substr(S.get(parts, i + 1), S.lit(1), S.lit(GRAM - 1)), S.lit("")))

        return S.transform(parts, with_next)

    return let(S.regexp_extract_all(text, S.lit(f"(?s).{{1,{CHUNK}}}"), S.lit(0)), joined)


def _places(chunks: DataFrame, sizes: Column) -> DataFrame:
    """``hash`` of the pieces of all sizes at all places of the column ``chunk``."""
    spread = chunks.withColumn("__size", S.explode(sizes)).where(S.length("chunk") >= S.col("__size"))
    spread = spread.withColumn("__at", S.explode(S.sequence(S.lit(1), S.length("chunk") - S.col("__size") + 1)))
    return spread.withColumn("hash", S.xxhash64(S.substr("chunk", S.col("__at"), S.col("__size")))).drop("__at", "__size", "chunk")


def _bit_map(anchors: DataFrame) -> Column:
    """The hashes in a bit map of ``BITS`` bits, as an array of 64-bit words that is the same for every row."""
    at = S.pmod("anchor", S.lit(BITS))
    words = anchors.groupBy(S.shiftright(at, 6).alias("word")).agg(S.bit_or(S.expr(f"shiftleft(1L, cast(pmod(anchor, {BITS}) & 63 AS INT))")).alias("bits"))
    table = words.agg(S.map_from_entries(S.collect_list(S.struct("word", "bits"))).alias("m"))
    every = S.sequence(S.lit(0).cast("bigint"), S.lit(BITS // 64 - 1).cast("bigint"))
    return table.select(S.transform(every, lambda w: S.coalesce(S.element_at("m", w), S.lit(0).cast("bigint")))).scalar()


def exclude_masked(df: DataFrame, secrets: DataFrame, *, secret: str = "secret", column: str = "params") -> DataFrame:
    """Drop parameters with a known secret anywhere in their value; names don't matter.

    Values are compared as canonical JSON text, at any depth, with secrets escaped in the same way and as they are.
    A text that isn't an object becomes null if it contains a secret.

    Rows are told apart by their parameters alone, so ids may be null or repeat. Each secret has an anchor, a rare piece
    of it, and all anchors are in a bit map of fixed size. The places of a value are tested against the map where the
    value is read; only those that pass are looked up among the anchors, and what is found is compared in full. Neither
    side has to fit in a task.
    """
    named = secrets.where(S.length(secret) > 0).select(S.col(secret).alias("__secret"))
    escaped = S.to_json(S.col("__secret").cast("variant"))
    known = named.union(named.select(S.substr(escaped, S.lit(2), S.length(escaped) - 2))).distinct()
    rows = df.withColumns({"__k1": S.xxhash64(column), "__k2": S.xxhash64(S.lit(1), column)})
    texts = rows.select("__k1", "__k2", S.col(column).alias("__params")).where(S.col("__params").isNotNull()).distinct()
    found = computed_once(texts, __values=_values(S.col("__params")))
    whole = S.coalesce(S.to_json(J.parsed(S.col("__params"))), S.col("__params"))
    entries = S.when(S.col("__values").isNull(), S.array(S.struct(S.lit(None).cast("string").alias("name"), whole.alias("text")))).otherwise(
        S.transform(S.map_entries("__values"), lambda e: S.struct(e["key"].alias("name"), S.coalesce(S.to_json(e["value"]), S.lit("null")).alias("text")))
    )
    values = found.select("__k1", "__k2", S.explode(entries).alias("__entry")).select("__k1", "__k2", "__entry.name", "__entry.text")
    anchors = _anchors(known, rows.select(S.col(column).alias("text")))
    sizes = anchors.agg(S.collect_set("size")).scalar()
    places = _places(values.select("__k1", "__k2", "name", S.explode(_chunks(S.col("text"))).alias("chunk")), sizes)
    bit = S.pmod("hash", S.lit(BITS))
    marked = S.get(_bit_map(anchors), S.shiftright(bit, 6).cast("int")).bitwiseAND(S.expr(f"shiftleft(1L, cast(pmod(hash, {BITS}) & 63 AS INT))"))
    pieces = places.where(marked != 0).distinct()
    suspects = pieces.join(anchors, S.col("hash") == S.col("anchor")).select(
        S.col("__k1").alias("__m1"), S.col("__k2").alias("__m2"), S.col("name").alias("__name"), "__secret"
    ).distinct()
    same = (S.col("__m1") == S.col("__k1")) & (S.col("__m2") == S.col("__k2")) & S.col("__name").eqNullSafe(S.col("name"))
    hits = suspects.join(values, same).where(S.contains(S.col("text"), S.col("__secret"))).select("__m1", "__m2", "__name")
    # at most the parameters of one text per group
    masked = hits.groupBy("__m1", "__m2").agg(S.collect_set("__name").alias("__masked"))
    joined = lookup(rows, masked, {"__k1": "__m1", "__k2": "__m2"})
    kept = _kept(S.col(column), lambda name, _: ~S.array_contains("__masked", name), S.col("__masked").isNotNull())
    return joined.withColumn(column, kept).select(*df.columns)


def flow_params(df: DataFrame, out: str = "params") -> DataFrame:
    """Add the parameters of a flow run: fixed fields without nulls, ``conf`` only if it has entries.

    Columns: ``dag_id``, ``run_id`` and optionally ``run_type``, ``logical_date``, ``data_interval_start``,
    ``data_interval_end`` and ``conf`` (JSON text).
    """
    fields = [
        S.col(name).cast("string").alias(name)
        for name in ("dag_id", "run_id", "run_type", "logical_date", "data_interval_start", "data_interval_end")
        if name in df.columns
    ]
    if "conf" in df.columns:
        conf = J.parsed(S.col("conf"))
        fields.append(S.when(S.size(J.object_keys(S.col("conf"))) > 0, conf).alias("conf"))
    return df.withColumn(out, S.to_json(S.struct(*fields)))
