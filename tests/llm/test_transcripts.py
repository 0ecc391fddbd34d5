"""Transcripts: blocks against one Viterbi over all, roles against held-out labels."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest

from changelake.llm.queries import QUERIES
from changelake.llm.transcripts import ROLES, Roles, _observed, parsed, pieces, train

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))


def test_pieces():
    assert pieces(None) == [(0, "")] and pieces("plain\ntext") == [(0, "plain\ntext")]
    assert pieces("User: hi\nmore\n\nAssistant: yes\n**Bot:** no\n<|system|> be kind") == [
        (2, "hi\nmore\n"), (3, "yes"), (3, "no"), (1, "be kind")]
    assert pieces("intro\nHuman: q\n### Assistant: a") == [(0, "intro"), (2, "q"), (3, "a")]
    assert pieces("username: x\nA is b") == [(0, "username: x\nA is b")]


def test_viterbi_is_best(model):
    observed = _observed(["hi?", "long " * 30, "ok", "User: x", "yes"])[2]
    scores = model.scores(observed)

    def score(path):
        return model.start[path[0]] + sum(model.move[a, b] for a, b in itertools.pairwise(path)) + sum(scores[i, s] for i, s in enumerate(path))

    best = max(itertools.product(range(3), repeat=5), key=score)
    assert tuple(model.path(observed, None, None)) == best
    assert model.matrix(observed)[3].max() == pytest.approx(score(best))


def whole(rows, model):
    """``(conv, turn, piece, role)`` in order and the rendered conversations, each decoded at once."""
    out, rendered = [], {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        at, parts, observed = _observed([r[3] for r in own])
        states = model.path(observed, None, None)
        text, before, nth = "", None, {}
        for row, part, state in zip(at, parts, states, strict=True):
            if state == before:
                text += "\n" + part
            else:
                text += ("" if before is None else "<|end|>\n") + f"<|{ROLES[state]}|>\n{part}"
            before = state
            nth[row] = nth.get(row, -1) + 1
            out.append((conv, own[row][1], nth[row], ROLES[state]))
        rendered[conv] = text + "<|end|>\n"
    return out, rendered


def test_long_and_odd_conversations(spark, model):
    rng = np.random.default_rng(2)
    rows = [(1, i, None, ("why? " if rng.random() < 0.3 else "so ") * int(rng.integers(1, 60))) for i in range(1500)]
    rows += [(2, 0, "user", None), (3, 0, "odd", ""), (None, 0, None, "no id"), (None, None, None, "no turn"), (4, 0, None, "User: a\nBot: b\n\nUser: c")]
    rows += [(c, t, None, "x" * (c + t)) for c in range(5, 60) for t in range(c % 7 + 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn int, role string, text string, seq string")
    got = parsed(table.repartition(6), model, block=100).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))
    want, rendered = whole(order, model)
    key = lambda r: tuple((x is not None, x or 0) for x in r[:3])
    assert sorted(((r.conv_id, r.turn, r.piece, r.role) for r in got), key=key) == sorted(want, key=key)
    texts: dict = {}
    for r in sorted(got, key=key):
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.rendered
    assert texts == rendered


def test_no_rows_and_no_labels(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert parsed(empty).collect() == []
    assert len(parsed(spark.createDataFrame([(1, 0, None, "hi")], "conv_id bigint, turn int, role string, text string")).collect()) == 1


def test_equal_turns_are_kept(spark):
    rows = [(1, 0, "user", "same")] * 40
    assert len(parsed(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"), block=7).collect()) == 40


def test_query_on_held_out_labels(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    truth = rows.toPandas().set_index(["conv_id", "turn"])["role"]
    got = pd.DataFrame([r.asDict() for r in QUERIES["op9_transcripts"](spark, SF).collect()])
    assert len(got) == len(truth)

    def accuracy(found):
        found = found.set_index(["conv_id", "turn"])["role"]
        return (found == truth.loc[found.index]).mean()

    truth = truth.sort_index()
    assert accuracy(got.sort_values(["conv_id", "turn"])) > 0.9
    small = rows.where("conv_id % 5 = 0")
    fitted = train(small, train_rows=500)  # whole conversations of one fifth
    assert isinstance(fitted, Roles)
    held = parsed(rows.where("conv_id % 5 <> 0"), fitted).select("conv_id", "turn", "role").toPandas()
    assert accuracy(held.sort_values(["conv_id", "turn"])) > 0.85
