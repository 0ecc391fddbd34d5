"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target of words, and each of its documents the same expected number of copies, target over size of
the source. The whole part is given to all. The fractions are rounded in pairs: of two open documents, as many words
as possible move from one to the other, in a direction drawn so that both keep their expected copies, until one of
them has a whole number. The words of the pair stay the same, so a source ends within one document of its target.

The pairing is a reduction tree. Documents of a source are dealt into chunks of about ``CHUNK``; in a chunk they are
paired one after the other, which leaves at most one open, and the open ones of all chunks are dealt and paired again
until a source has one. A source of any size is spread over all tasks.

Rows that agree in source, id and text are counted together first: of ``m`` of them, ``m`` times the fraction have one
copy more and at most one stays open, so repeated rows and ids can't fill a chunk. Draws are hashes of the documents:
reruns agree. Documents without words take nothing and never stay open. A null source is the last one, null ids and
texts are allowed, an empty table gives no rows, and columns other than the named ones are left as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changelake.llm.storage import written
from changelake.llm.texts import n_words
from changelake.plans.joins import lookup

CHUNK = 256
_CLOSE = 1e-12


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source``, ``source_size`` and ``target``, from rows of ``source`` and ``size``.

    Sources in order of code points, null last, have the weights in turn. ``share`` of all words is dealt by weight; no
    target passes ``most`` times the source's size, and what is above is dealt again. In order of size over weight, the
    words per weight that all later sources would get, were all earlier ones full, rises up to the right level and falls
    behind it: the level is the greatest. One row for each source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.get(F.array([F.lit(float(w)) for w in weights]), (number - 1) % len(weights))
    ranked = per_source.withColumns({"number": number, "weight": weight})
    order = W.orderBy(F.col("source_size") / F.col("weight"), "number")
    full = F.coalesce(F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * most
    later = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy()) * share
    level = F.max("level").over(W.partitionBy())
    leveled = ranked.withColumn("level", (total - full) / later).withColumn("level", level)
    target = F.least(F.col("source_size") * most, F.col("weight") * F.col("level"))
    return leveled.select("source", "source_size", F.greatest(target, F.lit(0.0)).alias("target"))


def _draw(*columns: Column) -> Column:
    """A number from 0 to below 1 that only depends on the columns."""
    return F.xxhash64(*columns).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair(state: Column, new: Column, seed: Column) -> Column:
    """Move words between the open document and a new one until one of them is whole."""
    old = state["open"]

    def moved(x: Column) -> Column:
        up = F.least(x["old_room"], x["new_has"])  # words the old one can take from the new one
        down = F.least(x["old_has"], x["new_room"])
        to_old = _draw(seed, old["unit"], new["unit"]) * (up + down) < down
        old_whole = F.when(to_old, x["old_room"] <= x["new_has"]).otherwise(x["old_has"] <= x["new_room"])
        words = F.when(to_old, up).otherwise(-down)
        closed = F.struct(
            F.when(old_whole, old["unit"]).otherwise(new["unit"]).alias("unit"),
            F.when(old_whole == to_old, F.lit(1)).otherwise(F.lit(0)).alias("up"),
        )
        rest = F.struct(
            F.when(old_whole, new["unit"]).otherwise(old["unit"]).alias("unit"),
            F.when(old_whole, new["p"] - words / new["size"]).otherwise(old["p"] + words / old["size"]).alias("p"),
            F.when(old_whole, new["size"]).otherwise(old["size"]).alias("size"),
        )
        return F.struct(closed.alias("closed"), rest.alias("rest"))

    def settled(x: Column) -> Column:
        whole = (x["rest"]["p"] < _CLOSE) | (x["rest"]["p"] > 1 - _CLOSE)
        second = F.struct(x["rest"]["unit"].alias("unit"), F.round(x["rest"]["p"]).cast("int").alias("up"))
        done = F.concat(state["done"], F.array(x["closed"]))
        return F.struct(
            F.when(~whole, x["rest"]).alias("open"),
            F.when(whole, F.concat(done, F.array(second))).otherwise(done).alias("done"),
        )

    sides = F.struct(
        (old["p"] * old["size"]).alias("old_has"), ((1 - old["p"]) * old["size"]).alias("old_room"),
        (new["p"] * new["size"]).alias("new_has"), ((1 - new["p"]) * new["size"]).alias("new_room"),
    )
    paired = _let(_let(sides, moved), settled)
    return F.when(old.isNull(), F.struct(new.alias("open"), state["done"].alias("done"))).otherwise(paired)


def _folded(rows: DataFrame, chunks: Column, level: int, seed: int) -> DataFrame:
    """A row for each chunk of a source: ``done`` decisions and the ``open`` document, if any."""
    item = F.struct("unit", "p", "size")
    kind = rows.select(item.alias("x")).schema["x"].dataType.simpleString()
    unit = rows.schema["unit"].dataType.simpleString()
    start = F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast(f"array<struct<unit:{unit},up:int>>").alias("done"))
    chunk = F.pmod(F.xxhash64(F.lit(seed + level), "unit"), chunks)
    dealt = rows.groupBy("source", "n", chunk.alias("chunk")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    fold = F.aggregate("items", start, lambda state, x: _pair(state, x, F.lit(seed + level)))
    return dealt.withColumn("fold", F.explode(F.array(fold))).select("source", "n", "chunk", "fold.*")


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    chunk: int = CHUNK,
) -> DataFrame:
    """Copies for every distinct row.

    A row for each ``doc_id``, ``source`` and ``text_hash`` with ``n_rows`` that agree in them, ``size``,
    ``source_size``, ``target``, ``copies`` of each, and ``extra``, how many of the rows have one copy more.
    """
    sized = docs.select("source", "doc_id", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size"))
    units = written(sized.groupBy("source", "doc_id", "text_hash", "size").agg(F.count(F.lit(1)).alias("m")), "mix-units")
    targets = source_targets(units.select("source", (F.col("size") * F.col("m")).alias("size")), weights, share, most)
    counts = units.where(F.col("size") > 0).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumnRenamed("source", "__of")
    targets = targets.join(counts, F.col("source").eqNullSafe(F.col("__of")), "left").drop("__of")
    keyed = {"k1": F.coalesce("source", F.lit("")), "k2": F.col("source").isNull()}
    rows = lookup(units.withColumns(keyed), targets.withColumns(keyed).drop("source"), {"k1": "k1", "k2": "k2"})
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    expected = F.least(expected, F.lit(float(most)))
    near = F.when(F.abs(expected - F.round(expected)) < _CLOSE, F.round(expected)).otherwise(expected)
    fraction = F.col("expected") - F.col("copies")
    rows = rows.withColumn("expected", near).withColumn("copies", F.floor("expected").cast("bigint"))
    rows = rows.withColumn("whole", F.floor(fraction * F.col("m") + _CLOSE).cast("bigint"))
    rows = rows.withColumn("p", F.when(F.col("size") > 0, F.greatest(fraction * F.col("m") - F.col("whole"), F.lit(0.0))).otherwise(0.0))
    unit = F.struct("doc_id", "text_hash", "size", "m", "copies", "whole", "source_size", "target")
    rows = rows.select("source", F.coalesce("n", F.lit(1)).alias("n"), unit.alias("unit"), "p", F.col("size").cast("double").alias("size"))
    is_open = (F.col("p") >= _CLOSE) & (F.col("p") <= 1 - _CLOSE)
    decided = [rows.where(~is_open).select("source", "unit", F.round("p").cast("int").alias("up"))]
    level, open_rows = 0, rows.where(is_open)
    largest = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    while True:
        size = chunk ** (level + 1)
        chunks = F.ceil(F.col("n") / F.lit(float(size)))
        folded = written(_folded(open_rows, chunks, level, seed), f"mix-level-{level}")
        decided.append(folded.select("source", F.inline("done")))
        open_rows = folded.where(F.col("open").isNotNull()).select("source", "n", "open.*")
        level += 1
        if size >= largest:
            break
    last = F.when(_draw(F.lit(seed - 1), F.col("unit")) < F.col("p"), 1).otherwise(0)
    decided.append(open_rows.select("source", "unit", last.alias("up")))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select(
        "unit.doc_id", "source", "unit.text_hash", F.col("unit.m").alias("n_rows"), "unit.size", "unit.source_size",
        "unit.target", "unit.copies", (F.col("unit.whole") + F.col("up")).alias("extra"),
    )


def per_row(mix: DataFrame) -> DataFrame:
    """A row for each document, with its ``copies`` and the words ``taken``."""
    nth = mix.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), "n_rows")))
    copies = F.col("copies") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)
    taken = nth.withColumn("copies", copies)
    return taken.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, each as often as it was drawn; all columns.

    Only rows that agree with others in source, id and text are numbered, and they alone are sorted for it.
    """
    mix = written(
        mixed(docs, **settings).select(
            F.col("doc_id").alias("__doc"), F.col("source").alias("__source"), F.col("text_hash").alias("__hash"),
            F.col("copies").alias("__copies"), F.col("extra").alias("__extra"), F.col("n_rows").alias("__rows"),
        ),
        "mix",
    )
    rows = docs.withColumn("__row", F.xxhash64("text"))
    match = rows["source"].eqNullSafe(F.col("__source")) & rows["doc_id"].eqNullSafe(F.col("__doc")) & (F.col("__row") == F.col("__hash"))
    single = rows.join(mix.where("__rows = 1"), match).withColumn("__nth", F.lit(1))
    several = rows.join(written(mix.where("__rows > 1"), "mix-repeats"), match)
    several = several.withColumn("__nth", F.row_number().over(W.partitionBy("source", "doc_id", "__row").orderBy(F.lit(0))))
    joined = single.unionByName(several)
    copies = F.col("__copies") + F.when(F.col("__nth") <= F.col("__extra"), 1).otherwise(0)
    joined = joined.withColumn("__n", copies).where(F.col("__n") > 0)
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n"))).select(*docs.columns)
