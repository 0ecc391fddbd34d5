"""A training-data pipeline over ``documents``: five stages, each by one of the operators of ``changelake.llm``.

Quality rules drop documents, line dedup drops lines, near-dedup keeps one document of each group, mixing repeats or
leaves out documents so that sources reach their targets, and packing cuts the ids of what is left into sequences. All
but the last return the columns of ``documents``; ``n_chars`` follows the text.

Null and empty texts fail the quality rules, so later stages meet empty texts only where all lines went; such a document
stays and is a sequence of its end id alone. Null ids, languages and sources are values like others. Rows that agree in
id and text are copies: one of them passes near-dedup. An empty table gives no sequence. Columns that a corpus has
besides go through all stages but the last untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import queries as llm
from changelake.llm.line_dedup import dedup_lines
from changelake.llm.mixing import mixture
from changelake.llm.near_dup import one_of_each
from changelake.llm.outliers import good_documents
from changelake.llm.packing import pack
from changelake.llm.storage import Scratch
from changelake.llm.texts import set_aside

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the limits that are no outliers of their language and source."""
    return good_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters and more in three or more documents stay in the newest only."""
    rows, own = set_aside(docs, ("n_lines", "n_dropped"))
    kept = dedup_lines(rows, min_docs=3, min_chars=20)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*own)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of those with four fifths of their five-word shingles in common."""
    return one_of_each(docs, shingle=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixture(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two length; the pieces of each document."""
    return llm.packed_digest(pack(docs, llm.vocabulary("byte_bpe_50k.json"), end_id=1, longest=2048, added_tokens=True))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Iterated estimates, sketches and token ids can't be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it and deleted once that is written."""
    tables, last = Scratch(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir), name)
        if last is not None:
            tables.drop(last)
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
