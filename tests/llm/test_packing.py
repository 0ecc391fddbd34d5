"""Token ids and power-of-two packing against the tokenizers library itself."""

from __future__ import annotations

import zlib
from array import array

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changelake.llm.packing import lengths, pack
from changelake.llm.queries import QUERIES, packed_digest, vocabulary
from changelake.llm.tokens import Encoder

ODD = [
    "", " ", "  two  spaces ", "don't stop, it's 3.14!", "line\nline two\n\nline four", "\ttab nbsp", "Ünïcödé ﬁne ΣΑΣ İ",
    "á combining ́", "日本語 テキスト 🎉🎉", "word.\nNext |x| (y)", "<|endoftext|> in text", "x" * 5000, " \n a",
    "tail ", "\x1c\x85 odd   spaces", "ñandú Straße, ÀÉ;\nÖl. Zwölf", "a b c " * 2000,
]


def library(name, texts, end=1):
    tokenizer = Tokenizer.from_file(vocabulary(name))
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(spark, name):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    encode = Encoder(vocabulary(name), remembered=3000)  # forgets on the way
    for text, ids in zip([*ODD, *texts], library(name, [*ODD, *texts]), strict=True):
        assert encode.ids(text) == array("I", ids[:-1]).tobytes(), text[:80]


def test_lengths():
    assert lengths(2048 * 2 + 5, 2048) == [2048, 2048, 4, 1]
    for n in range(1, 5000, 7):
        out = lengths(n, 256)
        assert sum(out) == n and all(x & (x - 1) == 0 and x <= 256 for x in out)


def check_pieces(rows, texts):
    """Every id in one piece, sequences of a power of two, one piece in each."""
    want = dict(zip(texts, library("byte_bpe_50k.json", texts.values()), strict=True))
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(want)
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            ids = want[doc][r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(want[doc]) and r.ids_crc32 == crc(ids) and r.offset == 0
            assert r.length & (r.length - 1) == 0 and r.length <= 2048
            at += r.length
        assert at == len(want[doc])
    ids = sorted((r.sequence_id, r.length) for r in rows)
    assert [i for i, _ in ids] == list(range(len(rows)))
    assert [n for _, n in ids] == sorted((n for _, n in ids), reverse=True)  # a bucket is a range of ids


def test_query_packs_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").collect()
    check_pieces(rows, {r.doc_id: r.text for r in docs.collect()})


def test_odd_rows(spark):
    texts = dict(enumerate([*ODD, None]))
    docs = spark.createDataFrame([(i, t, 1, "p") for i, t in texts.items()], "doc_id bigint, text string, length int, part string")
    check_pieces(packed_digest(pack(docs.repartition(3), vocabulary("byte_bpe_50k.json"))).collect(), texts)


def test_repeated_null_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id bigint, text string")
    rows = pack(docs, vocabulary("byte_bpe_50k.json")).collect()
    assert sorted((r.doc_id is None, r.doc_tokens, r.length) for r in rows) == [
        (False, 1, 1), (True, 3, 1), (True, 3, 1), (True, 3, 2), (True, 3, 2)]
    assert len({r.sequence_id for r in rows}) == 5
    assert pack(docs.limit(0), vocabulary("byte_bpe_50k.json")).withColumn("x", F.crc32("ids")).collect() == []
