"""The pipeline against the plain versions of its stages."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.llm.test_line_dedup import brute as plain_lines
from tests.llm.test_near_dup import brute as plain_near
from tests.llm.test_outliers import failed
from tests.llm.test_packing import crc, library

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    out = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out.append(stage(spark, out[-1], SF).cache())
        assert out[-1].columns == columns and out[-1].dtypes == docs.dtypes
    rows = [{r.doc_id: r for r in df.collect()} for df in out[:4]]
    assert not any(failed(r.text) for r in rows[1].values()) and 0.6 < len(rows[1]) / len(rows[0]) < 1
    assert all(r == rows[0][i] for i, r in rows[1].items())
    texts = {doc: text for doc, _, _, text in plain_lines([(i, r.text) for i, r in rows[1].items()])}
    assert {i: r.text for i, r in rows[2].items()} == texts and all(r.n_chars == len(r.text) for r in rows[2].values())
    groups = plain_near(list(texts.items()), 5)
    assert set(rows[3]) == {doc for doc, _, component in groups if doc == component}
    mixed = out[4].collect()
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= set(rows[3]) and max(copies.values()) <= 2 and set(mixed) <= set(rows[3].values())
    packed = corpus_pipeline.STAGES[-1][1](spark, out[4], SF).collect()
    ids = dict(zip(copies, library("byte_bpe_50k.json", [rows[3][d].text for d in copies]), strict=True))
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in packed)
    for (doc, start, length, value), n in pieces.items():
        assert n == copies[doc] and value == crc(ids[doc][start : start + length])
    assert sum(r.length for r in packed) == sum(len(ids[d]) * n for d, n in copies.items())
    assert len({r.sequence_id for r in packed}) == len(packed)


def test_run(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "mixing", "packing"]
    df = corpus_pipeline.run(spark, SF)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and df.count() > 100


def test_odd_rows_and_columns(spark):
    """Nulls, empty and repeated rows, and columns named like those the operators add."""
    def text(i):
        return "\n".join(" ".join(f"w{(i * 31 + n * 17 + k * k * 7) % 997}" for k in range(12)) for n in range(8))

    rows = [(i, text(i), "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None) for i in range(60)]
    rows += [(None, text(3), "en", "s1"), (None, None, None, None), (70, "", "en", "s0"), (71, None, "en", "s0"), (5, text(5), "en", "s1"), (5, text(5), "en", "s1")]
    own = [(*r, 0, 777, "own", 3.5, True, r[0]) for r in rows]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines int, n_dropped string, x double, kept boolean, cell bigint"
    docs = spark.createDataFrame(own, schema)
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.dtypes == docs.dtypes, name
        found = out.collect()
        assert found and all((r.n_lines, r.n_dropped, r.x, r.kept, r.cell) == (777, "own", 3.5, True, r.doc_id) for r in found), name
        if name == "near_dedup":
            assert len({r.doc_id for r in found}) == len(found)
    packed = corpus_pipeline.STAGES[-1][1](spark, out, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in found}


def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
