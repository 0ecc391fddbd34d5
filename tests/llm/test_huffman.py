"""Token files: best code lengths, round trips, and the query against the tokenizers library."""

from __future__ import annotations

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm.huffman import Code, code_lengths, packed_bits, read_tokens, unpacked_ids, write_tokens
from changelake.llm.queries import QUERIES, vocabulary
from changelake.llm.storage import shared_folder
from tests.llm.test_packing import ODD, crc, library


def plain_huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def best_cost(counts, limit):
    """Least cost of a code of bounded length: the tree's levels from the leaves of least weight, by dynamic programming."""
    w = sorted(counts, reverse=True)
    best = {(0, 1): 0}  # symbols placed, free nodes at this depth
    for depth in range(1, limit + 1):
        step = {}
        for (placed, free), cost in best.items():
            for leaves in range(min(2 * free, len(w) - placed) + 1):
                key = (placed + leaves, min(2 * free - leaves, len(w)))
                c = cost + depth * sum(w[placed : placed + leaves])
                if c < step.get(key, 1 << 60):
                    step[key] = c
        best |= {k: min(v, best.get(k, 1 << 60)) for k, v in step.items()}
        best = {k: v for k, v in best.items() if k in step or k[0] == len(w)}
    return min(v for (placed, _), v in best.items() if placed == len(w))


@pytest.mark.parametrize("seed", range(6))
def test_lengths_are_best(seed):
    rng = np.random.default_rng(seed)
    counts = rng.zipf(1.3, 9) % 10_000 + 1
    for limit in (4, 5, 6):
        lengths = code_lengths(counts, limit)
        assert lengths.max() <= limit and (0.5**lengths).sum() <= 1
        assert int((lengths * counts).sum()) == best_cost(counts.tolist(), limit)
    many = rng.zipf(1.2, 3000) % 100_000 + 1
    assert int((code_lengths(many, 40) * many).sum()) == plain_huffman_cost(many.tolist())


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 70_001])
@pytest.mark.parametrize("kinds", [1, 2, 300])
def test_bits_round_trip(n, kinds):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.5, n) % kinds * 7
    seen, counts = np.unique(ids, return_counts=True)
    code = Code(seen, code_lengths(counts, 12))
    data, checkpoints = packed_bits(ids, *code.by_id())
    assert (unpacked_ids(data, n, checkpoints, *code.by_bits(), code.limit) == ids).all()


def expected(docs):
    docs = sorted(docs.items())
    out, start = {}, 0
    for (doc, _), ids in zip(docs, library("word_bpe_49k.json", [t for _, t in docs]), strict=True):
        out[doc] = (start, len(ids), crc(ids))
        start += len(ids)
    return out


def test_query_reads_back_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = QUERIES["op8_token_files"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected({r.doc_id: r.text for r in docs.collect()})


def test_odd_rows_and_small_segments(spark):
    texts = {i * 3 - 20: t for i, t in enumerate([*ODD, None, *ODD])}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id bigint, text string, start string")
    folder = shared_folder(spark, "tokens")
    write_tokens(docs.repartition(5), folder, vocabulary("word_bpe_49k.json"), segment=50)
    rows = read_tokens(spark, folder).withColumn("crc", F.crc32("ids")).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.crc) for r in rows} == expected(texts)


def test_repeated_null_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id bigint, text string")
    for rows, n in ((docs, 3), (docs.limit(0), 0)):
        folder = shared_folder(spark, "tokens")
        write_tokens(rows, folder, vocabulary("word_bpe_49k.json"))
        out = sorted((r.start, r.doc_id, r.n_tokens) for r in read_tokens(spark, folder).collect())
        assert out == [(0, None, 3), (3, None, 3), (6, 3, 1)][:n]
