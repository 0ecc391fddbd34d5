"""Quality rules: plain limits, and robust multivariate outliers by language and source.

Counts of each whole text are turned into a vector of roughly symmetric statistics. For every cell of language and
source, for every language and for all documents, a minimum-covariance-determinant estimate finds the centre and spread
of the most concentrated share of the documents: from two starts, concentration steps keep that share of smallest
distances and estimate anew, the result of the least determinant counts, and a last step takes all documents inside the
usual ellipse. A cell's estimate leans on its language's, and that on the one of all, as if they stood for a fixed
number of rows: one rule for cells of any size, in which a cell's own rows soon outweigh the others. Documents whose
Mahalanobis distance from their cell is beyond the cutoff are rejected.

All steps are aggregates of a narrow table. Order statistics come from counts in fine bins, which add up in any order
and spread a hot cell over all tasks. Each variance is at least the square of a floor, so that a statistic that hardly
varies rejects nobody for a small difference.

Null and empty texts have no words and fail the limits. Null languages and sources make cells of their own. Rows are
judged one by one, repeated or not. Columns with other names stay out of the way; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changelake.llm.storage import written
from changelake.llm.texts import SPACES, lines, set_aside, words
from changelake.plans.joins import lookup
from changelake.plans.once import computed_once

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Least standard deviation of each statistic in ``statistics``.
FLOORS = (0.5, 0.15, 0.5, 0.3, 0.1)
SHARE = 0.75
_ALL = "all"  # the cell of all documents; others are JSON texts
_BINS = 256.0  # to a unit of a statistic, and to a unit of the logarithm of a squared distance


def text_counts(docs: DataFrame) -> DataFrame:
    """All columns and those of ``COUNTS``.

    Repeated three-word windows are found by sorting the hashes of a text's windows with their places, so that a text
    of any length takes little more than linear time; texts without a repeated window skip it.
    """
    text = F.coalesce("text", F.lit(""))
    spoken = F.filter(lines(F.col("text")), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    rows = computed_once(docs.drop(*COUNTS), __words=words(text), __lines=spoken)
    w = F.col("__words")
    window = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.lit(" "), F.get(w, i + 1), F.lit(" "), F.get(w, i + 2))
    )
    rows = computed_once(rows, __windows=F.when(F.size(w) >= 3, window))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = computed_once(rows, __sorted=F.when(repeats, placed))
    s = F.col("__sorted")
    again = F.transform(s, lambda x, j: F.when((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"]))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        F.array_sort(F.array_compact(again)), start,
        lambda state, i: F.struct((i + 3).alias("end"), (state["n"] + i + 3 - F.greatest(i, state["end"])).alias("n")),
        lambda state: state["n"],
    )
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.char_length(F.array_join("__words", "")),
        "n_symbols": F.char_length(text) - F.char_length(F.regexp_replace(text, "[#*$%&|<>]", "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    rows = rows.withColumns({name: count.cast("bigint") for name, count in counts.items()})
    return rows.drop("__words", "__lines", "__windows", "__sorted")


def statistics() -> list[Column]:
    """The transformed statistics of a document with words."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        F.log1p(n.cast("double")), F.log(chars / n) * 2, F.log1p(1000 * F.col("n_symbols") / chars),
        F.log1p(F.col("n_dup_lines").cast("double")), F.sqrt(F.col("n_repeat_words") / n),
    ]


def chi2_below(x: float, d: int) -> float:
    """Probability that a chi-square variable of ``d`` degrees is below ``x``."""
    a, half = d / 2, x / 2
    term = total = 1 / a
    for n in range(1, 1000):
        term *= half / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a))) if x > 0 else 0.0


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 500.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_below(middle, d) < p else (low, middle)
    return high


def _quantiles(rows: DataFrame, values: Column, p: float) -> DataFrame:
    """For each ``cell``, the array ``q`` of quantiles of an array of values, as upper ends of bins."""
    binned = rows.select("cell", F.posexplode(F.transform(values, lambda x: F.floor(x * _BINS))).alias("dim", "bin"))
    counts = binned.groupBy("cell", "dim", "bin").agg(F.count(F.lit(1)).alias("n"))
    by_dim = W.partitionBy("cell", "dim")
    counts = counts.withColumns({"upto": F.sum("n").over(by_dim.orderBy("bin")), "all": F.sum("n").over(by_dim)})
    first = counts.where(F.col("upto") >= F.col("all") * p).groupBy("cell", "dim").agg(((F.min("bin") + 1) / _BINS).alias("v"))
    ordered = F.sort_array(F.collect_list(F.struct("dim", "v")))  # one for each statistic
    return first.groupBy("cell").agg(F.transform(ordered, lambda x: x["v"]).alias("q"))


def _distance(d: int) -> Column:
    """Squared distance of ``x`` by ``mean`` and ``whiten``, the inverse of the Cholesky factor row by row."""
    total: Column = F.lit(0.0)
    for i in range(d):
        z: Column = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.get("whiten", F.lit(i * d + j)) * (F.get("x", F.lit(j)) - F.get("mean", F.lit(j)))
        total = total + z * z
    return total


def _covariances(rows: DataFrame, floors: Sequence[float], factor: float) -> DataFrame:
    """``mean`` and ``cov`` (the lower triangle, row by row) of each cell's rows, the covariance times a factor for consistency."""
    d = len(floors)
    x = [F.get("x", F.lit(i)) for i in range(d)]
    sums = [F.avg(x[i]).alias(f"m{i}") for i in range(d)]
    sums += [F.avg(x[i] * x[j]).alias(f"s{i}{j}") for i in range(d) for j in range(i + 1)]
    table = rows.groupBy("cell").agg(*sums)
    covariance = []
    for i in range(d):
        for j in range(i + 1):
            value = (F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * factor
            covariance.append(F.greatest(value, F.lit(0.0)) + floors[i] ** 2 if i == j else value)
    return table.select("cell", F.array(*[F.col(f"m{i}") for i in range(d)]).alias("mean"), F.array(*covariance).alias("cov"))


def _whitened(table: DataFrame, d: int) -> DataFrame:
    """Adds ``whiten``, the inverse of the Cholesky factor of ``cov``, and ``log_det``, the logarithm of its determinant."""
    own, zero = table.columns, F.lit(0.0)
    place = {(i, j): i * (i + 1) // 2 + j for i in range(d) for j in range(i + 1)}
    table = table.withColumns({f"s{i}{j}": F.get("cov", F.lit(at)) for (i, j), at in place.items()})
    for j in range(d):  # Cholesky, column by column
        pivot = F.col(f"s{j}{j}") - sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), zero)
        table = table.withColumn(f"l{j}{j}", F.sqrt(F.greatest(pivot, F.lit(1e-12))))
        below = {}
        for i in range(j + 1, d):
            rest = F.col(f"s{i}{j}") - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), zero)
            below[f"l{i}{j}"] = rest / F.col(f"l{j}{j}")
        table = table.withColumns(below) if below else table
    for i in range(d):  # its inverse, row by row
        row = {f"w{i}{i}": 1 / F.col(f"l{i}{i}")}
        for j in range(i):
            row[f"w{i}{j}"] = -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), zero) / F.col(f"l{i}{i}")
        table = table.withColumns(row)
    whiten = [F.col(f"w{i}{j}") if j <= i else zero for i in range(d) for j in range(d)]
    log_det = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(d)), zero)
    return table.select(*own, F.array(*whiten).alias("whiten"), log_det.alias("log_det"))


def _with_distance(rows: DataFrame, estimates: DataFrame, d: int) -> DataFrame:
    joined = lookup(rows, estimates.select(F.col("cell").alias("__cell"), "mean", "whiten"), {"cell": "__cell"})
    return joined.withColumn("d2", _distance(d)).drop("mean", "whiten")


def _median_start(rows: DataFrame, floors: Sequence[float]) -> DataFrame:
    """Medians and, on the diagonal, squared median deviations."""
    d = len(floors)
    median = _quantiles(rows, F.col("x"), 0.5).withColumnsRenamed({"cell": "__cell", "q": "median"})
    centred = lookup(rows, median, {"cell": "__cell"})
    deviations = F.zip_with("x", "median", lambda x, m: F.abs(x - m))
    spread = _quantiles(centred.withColumn("x", deviations), F.col("x"), 0.5).withColumnRenamed("cell", "__of")
    start = median.join(spread, F.col("__cell") == F.col("__of"))
    diagonal = [F.pow(F.get("q", F.lit(i)) * 1.4826, F.lit(2.0)) + floors[i] ** 2 for i in range(d)]
    cov = [diagonal[i] if i == j else F.lit(0.0) for i in range(d) for j in range(i + 1)]
    return start.select(F.col("__cell").alias("cell"), F.col("median").alias("mean"), F.array(*cov).alias("cov"))


def mcd(
    rows: DataFrame, floors: Sequence[float] = FLOORS, share: float = SHARE, steps: int = 3, inside: float = 0.975,
    starts: Sequence[str] = ("medians",),
) -> DataFrame:
    """``mean``, ``cov`` and ``whiten`` of each ``cell`` of rows with a vector ``x``: the reweighted MCD estimates.

    Concentration steps go on from each of the ``starts``, ``medians`` (with median deviations) and ``means`` (with the
    covariance of all rows); of their results, the one with the least determinant counts. A step reads the rows and sums
    per cell; its estimates, a row for each cell and start, are written.
    """
    d = len(floors)
    makers = {"medians": lambda: _median_start(rows, floors), "means": lambda: _covariances(rows, floors, 1.0)}

    def of(start: str) -> Column:
        return F.concat(F.lit(f"{start}:"), F.col("cell"))

    first = [makers[start]().withColumn("cell", of(start)) for start in starts]
    estimates = first[0]
    for more in first[1:]:
        estimates = estimates.unionByName(more)
    estimates = written(_whitened(estimates, d), "mcd")
    each = rows.select(F.explode(F.array(*[of(start) for start in starts])).alias("cell"), "x")
    # the nearest share of a normal cloud is this much narrower than the whole
    factor = share / chi2_below(chi2_quantile(share, d), d + 2)
    for _ in range(steps):
        measured = _with_distance(each, estimates, d).withColumn("place", F.log1p("d2"))
        limit = _quantiles(measured, F.array("place"), share).select(F.col("cell").alias("__cell"), F.get("q", F.lit(0)).alias("limit"))
        nearest = lookup(measured, limit, {"cell": "__cell"}).where(F.col("place") < F.col("limit"))
        estimates = written(_whitened(_covariances(nearest, floors, factor), d), "mcd")
    order = F.array_position(F.array(*[F.lit(start) for start in starts]), F.substring_index("cell", ":", 1))
    plain = F.expr("substring(cell, length(substring_index(cell, ':', 1)) + 2)")
    best = estimates.groupBy(plain.alias("of")).agg(F.min_by(F.struct("mean", "whiten"), F.struct("log_det", order)).alias("e"))
    estimates = written(best.select(F.col("of").alias("cell"), "e.*"), "mcd")
    limit = chi2_quantile(inside, d)
    near = _with_distance(rows, estimates, d).where(F.col("d2") <= limit)
    return written(_whitened(_covariances(near, floors, inside / chi2_below(limit, d + 2)), d), "mcd")


def _leaning(own: DataFrame, wider: DataFrame, d: int, prior_rows: int) -> DataFrame:
    """Estimates of cells leaning on those of the wider cell ``up`` they belong to, as if that were ``prior_rows`` rows of theirs."""
    above = wider.select(F.col("cell").alias("__up"), F.col("mean").alias("mean_up"), F.col("cov").alias("cov_up"))
    joined = lookup(own, above, {"up": "__up"}, "inner")
    w = F.col("n") / (F.col("n") + F.lit(float(prior_rows)))
    a, b = "mean", "mean_up"
    apart = [F.get(a, F.lit(i)) - F.get(b, F.lit(i)) for i in range(d)]
    mean = [w * F.get(a, F.lit(i)) + (1 - w) * F.get(b, F.lit(i)) for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    cov = [
        w * F.get("cov", F.lit(at)) + (1 - w) * F.get("cov_up", F.lit(at)) + w * (1 - w) * apart[i] * apart[j]
        for at, (i, j) in enumerate(pairs)
    ]
    return joined.select("cell", F.array(*mean).alias("mean"), F.array(*cov).alias("cov"))


def judged(
    docs: DataFrame, least_words: int = 50, most_repeats: int = 50, prior_rows: int = 50, cutoff: float = 1 - 1e-9, share: float = SHARE
) -> DataFrame:
    """All columns of the documents with ``COUNTS``, ``base_failed``, ``distance`` (null where it failed) and ``kept``.

    A document fails the limits with fewer than ``least_words`` words or with more than ``most_repeats`` of a hundred
    in repeated windows; the others are judged by their distance, which a normal cloud passes with ``1 - cutoff``.
    """
    counted = text_counts(docs.drop("cell", "x", "d2", "base_failed", "distance", "kept"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    x = F.when(~F.col("base_failed"), F.array(*statistics()))
    return _verdict(written(counted.withColumn("x", x), "quality"), prior_rows, cutoff, share).select(
        *counted.columns, F.sqrt("d2").alias("distance"), F.col("kept")
    )


def _verdict(rows: DataFrame, prior_rows: int, cutoff: float, share: float) -> DataFrame:
    """Adds ``d2`` and ``kept`` to rows with ``x``."""
    d, whole = len(FLOORS), {"ignoreNullFields": "false"}
    own, up = F.to_json(F.struct("lang", "source"), whole), F.to_json(F.struct("lang"), whole)
    rows = rows.withColumn("cell", own)
    judged_rows = rows.where(F.col("x").isNotNull()).select("cell", up.alias("up"), "x")
    narrow = judged_rows.select(F.explode(F.array("cell", "up", F.lit(_ALL))).alias("cell"), "x")
    estimates = mcd(written(narrow, "quality-cells"), share=share, starts=("medians", "means"))
    sizes = written(judged_rows.groupBy("cell", "up").agg(F.count(F.lit(1)).alias("n")), "quality-sizes")
    by_lang = sizes.groupBy(F.col("up").alias("cell")).agg(F.sum("n").alias("n")).withColumn("up", F.lit(_ALL))

    def sized(table: DataFrame) -> DataFrame:
        return lookup(table, estimates.select(F.col("cell").alias("__of"), "mean", "cov"), {"cell": "__of"}, "inner")

    langs = _leaning(sized(by_lang), estimates, d, prior_rows)
    cells = written(_whitened(_leaning(sized(sizes), langs, d, prior_rows), d), "quality-estimates")
    limit = chi2_quantile(cutoff, d)
    return _with_distance(rows, cells, d).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= limit, F.lit(False)))


def good_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents that stay, with their own columns."""
    rows, own = set_aside(docs, (*COUNTS, "cell", "x", "d2", "base_failed", "distance", "kept"))
    return judged(rows, **settings).where("kept").select(*own)
