"""Looking things up by pieces of text: search by postings of trigrams, and many name patterns against many names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as S
from pyspark.sql import types as T

from changelake.functions.patterns import glob_columns
from changelake.operators.query import search_condition
from changelake.plans.groups import expanded, group_counts
from changelake.plans.once import computed_once, let

GRAM = 3
#: Longest piece of a pattern that is looked up.
PIECE = 8


def _grams(text: Column, size: int = GRAM) -> Column:
    """Distinct runs of ``size`` characters of a text; a shorter text as a whole."""

    def runs(chars: Column) -> Column:
        starts = S.sequence(S.lit(0), S.size(chars) - size)
        return S.transform(starts, lambda i: S.concat(*[S.get(chars, i + n) for n in range(size)]))

    long = let(S.split(text, ""), runs)
    return S.when(S.char_length(text) >= size, S.array_distinct(long)).otherwise(S.array(text))


def text_postings(df: DataFrame, columns: Sequence[str] | None = None, id: str = "id") -> DataFrame:
    """``gram`` and ``id``: which records have which trigram in any of the columns, by default all text columns.

    Case doesn't count. Empty and null texts have none, and rows without an id are left out.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if columns is None else list(columns)
    texts = S.array_compact(S.array(*[S.lower(S.col(name)) for name in names])) if names else S.array().cast("array<string>")
    rows = df.where(S.col(id).isNotNull()).select(S.col(id).alias("id"), S.filter(texts, lambda text: text != "").alias("texts")).where(S.size("texts") > 0)
    # the short rows are dealt by id, not their grams; those of one row are told apart inside it
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    rows = rows.withColumn("__rows", S.count(S.lit(1)).over(W.partitionBy("id")))
    grams = S.explode(S.array_distinct(S.flatten(S.transform("texts", lambda text: _grams(text))))).alias("gram")
    alone = rows.where(S.col("__rows") == 1).select(grams, "id")
    return alone.unionByName(rows.where(S.col("__rows") > 1).select(grams, "id").distinct())


def write_postings(postings: DataFrame, path: str, files: int | None = None) -> None:
    """Write postings in the order of their grams, so that a search reads the row groups of its own."""
    n = files or int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings.repartitionByRange(n, "gram", "id").sortWithinPartitions("gram", "id").write.mode("overwrite").parquet(path)


def _needle(spark: SparkSession, text: str) -> list[str]:
    """The trigrams of a needle, lowered as the records are."""
    lowered = spark.range(1).select(S.lower(S.lit(text))).first()[0]
    return sorted({lowered[i : i + GRAM] for i in range(len(lowered) - GRAM + 1)}) or [lowered]


def search_postings(df: DataFrame, postings: DataFrame, text: str, columns: Sequence[str] | None = None, id: str = "id") -> DataFrame:
    """The records with the text in one of the columns, in any case: the rows of ``search_condition``, by postings.

    Records that have all trigrams of the needle are candidates and checked in full. A needle of one or two characters
    is looked up in the grams that hold it; an empty one finds every record with a text.
    """
    grams = _needle(df.sparkSession, text)
    short = len(grams) == 1 and len(grams[0]) < GRAM
    rows = postings.where(S.contains(S.col("gram"), S.lit(grams[0])) if short else S.col("gram").isin(grams))
    # a bit for each gram, shared by several in needles of more than 63
    bits = S.lit(0).cast("bigint")
    for n, gram in enumerate([] if short else grams):
        bits = S.when(S.col("gram") == gram, S.lit(1 << n % 63).cast("bigint")).otherwise(bits)
    every = 0 if short else (1 << min(len(grams), 63)) - 1
    found = rows.groupBy(S.col("id").alias("__id")).agg(S.bit_or(bits).alias("n")).where(S.col("n") == every).select("__id")
    searched = df if columns is None else df.select(*columns)
    near = df.join(found, S.col(id) == S.col("__id"), "left_semi") if text else df
    return near.where(search_condition(searched, text))


def match_patterns(names: DataFrame, patterns: DataFrame, *, name: str = "name", pattern: str = "pattern") -> DataFrame:
    """Pairs of rows of ``names`` and ``patterns`` where the name matches the glob; columns of both.

    A pattern is looked up by the beginning of its longest piece without wildcards, among all runs of that length in the
    names; one without such a piece by its length, if that is fixed. Only patterns like ``*`` meet every name. What is
    found is checked with the pattern as a regular expression. Null names and patterns match nothing. Rows of one pattern
    are looked up once, and taken from their groups in the end.
    """

    asked = patterns.where(S.col(pattern).isNotNull()).withColumn("__pattern", S.col(pattern))
    counts = group_counts(asked, ["__pattern"])
    globs = computed_once(counts, __glob=glob_columns(S.col("__pattern")))
    piece = S.substr("__glob.piece", S.lit(1), S.lit(PIECE))
    key = S.when(piece != "", S.concat(S.lit("p"), piece)).when(S.col("__glob.length").isNotNull(), S.concat(S.lit("n"), S.col("__glob.length").cast("string"))).otherwise("*")
    globs = globs.withColumns({"__key": key, "__size": S.length(piece)})
    sizes = globs.agg(S.collect_set("__size")).scalar()  # no more than ``PIECE`` and zero
    rows = names.where(S.col(name).isNotNull())
    text = S.col(name)

    def runs(chars: Column) -> Column:
        starts = S.sequence(S.lit(0), S.size(chars) - S.col("__length"))
        return S.transform(starts, lambda i: S.concat(S.lit("p"), S.array_join(S.slice(chars, i + 1, S.col("__length")), "")))

    whole = S.array(S.concat(S.lit("n"), S.length(text).cast("string")), S.lit("*"))
    rows = rows.withColumn("__length", S.explode(S.array_union(S.array(S.lit(0)), sizes))).where(S.length(text) >= S.col("__length"))
    keys = S.when(S.col("__length") == 0, whole).otherwise(S.array_distinct(let(S.split(text, ""), runs)))
    rows = rows.withColumn("__name_key", S.explode(keys))
    joined = rows.join(globs, S.col("__name_key") == S.col("__key"))
    joined = joined.where(S.regexp(text, S.col("__glob.regex"))).drop("__glob", "__key", "__size", "__name_key", "__length")
    return expanded(joined, ["__pattern"], asked, ["__pattern"], counts)
