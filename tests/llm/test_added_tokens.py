"""Texts that hold added tokens, through the queries, against the plain library."""

from __future__ import annotations

from array import array

import pytest
from tokenizers import Tokenizer

from changelake.llm.queries import QUERIES, vocabulary
from changelake.llm.tokens import Encoder
from corpus_pipeline import packing
from tests.llm.test_packing import ODD, crc

TEXTS = [
    *ODD, "a doc <|endoftext|> next", "<|endoftext|>", "x<|endoftext|>y", "two  <|endoftext|><|endoftext|>\nÜber  <|startoftext|> A",
    "<|ENDOFTEXT|> <|endoftext|", "<|startoftext|>don't stop<|endoftext|> ", "word " * 3000 + "<|endoftext|>" + " word" * 3000,
]


def plain(name, texts):
    tokenizer = Tokenizer.from_file(vocabulary(name))
    return [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("added"))
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_plain_library(name):
    encode = Encoder(vocabulary(name), remembered=3000, added_tokens=True)
    for text, ids in zip(TEXTS, plain(name, TEXTS), strict=True):
        assert encode.ids(text) == array("I", ids).tobytes(), text[:80]


def test_packing(spark, folder):
    want = [[*ids, 1] for ids in plain("byte_bpe_50k.json", TEXTS)]
    staged = packing(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    for rows in (QUERIES["op7_packing"](spark, folder).collect(), staged):
        got = {(r.doc_id, r.start): (r.length, r.doc_tokens, r.ids_crc32) for r in rows}
        assert {doc for doc, _ in got} == set(range(len(TEXTS)))
        for (doc, start), (length, tokens, digest) in got.items():
            assert tokens == len(want[doc]) and digest == crc(want[doc][start : start + length]), TEXTS[doc][:80]


def test_token_files(spark, folder):
    at = 0
    rows = sorted(QUERIES["op8_token_files"](spark, folder).collect(), key=lambda r: r.doc_id)
    for r, ids in zip(rows, plain("word_bpe_49k.json", TEXTS), strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids) + 1, crc([*ids, 1])), TEXTS[r.doc_id][:80]
        at += len(ids) + 1
