"""Transcript parsing: roles by a hidden Markov model, then canonical turns.

A row of a conversation is cut at lines that begin with a speaker marker; each piece is an observation with features of
its lines: the kind of its marker, its length, its number of lines, questions, and whether it begins a row. The hidden
states are the roles. The model is counted from a bounded sample of labelled rows, ``TRAIN_ROWS``, whole conversations by
a hash of their id as long as they fit; everything else covers all rows, and labels of other rows are never looked at.

Rows are sorted by range over conversation, turn and text and packed into *blocks* of consecutive rows, so a long
conversation is many blocks in many tasks. A block's matrix says how well it leads from one role before it to another at
its end; Viterbi over the matrices of a conversation, a few numbers for each block, gives the roles at the borders, and
each block is then decoded by itself. This gives the best path of the whole conversation.

Pieces are rendered as ``<|role|>`` and a line feed before the first of a turn, ``<|end|>`` and a line feed behind its
last; neighbours of one role are one turn. Concatenated in order, pieces are the conversation.

Null texts are empty. A null conversation is a conversation of its own, null turns come first, equal turns are in order
of a hash of their text. Null or unknown roles are left out of training. Without labels all roles are alike. Extra
columns are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.storage import ship, written

ROLES = ("system", "user", "assistant")
TRAIN_ROWS = 20_000
BLOCK = 2048
_MARKERS = {
    "system": "system|instructions?|context", "user": "user|human|prompt|customer|question|q|me",
    "assistant": "assistant|bot|ai|gpt|model|agent|answer|a",
}
_MARKER = re.compile(
    r"[ \t]*(?:<\|im_start\|>|<\||\*\*|\[|#{1,4}[ \t]*)?(?:"
    + "|".join(f"(?P<{role}>{words})" for role, words in _MARKERS.items())
    + r")(?:\|>|\]|\*\*)?[ \t]*(?::(?:\*\*)?|>|(?<=\|>)|(?<=\]))[ \t]*",
    re.IGNORECASE,
)
#: Number of values of each feature.
SIZES = (4, 14, 6, 2, 2)


def pieces(text: str | None) -> list[tuple[int, str]]:
    """Kind of marker (0 for none, else 1 and the place of its role) and text, without the marker, of each piece."""
    out: list[tuple[int, list[str]]] = []
    for line in (text or "").split("\n"):
        found = _MARKER.match(line)
        if found:
            out.append((1 + ROLES.index(found.lastgroup), [line[found.end() :]]))
        elif out:
            out[-1][1].append(line)
        else:
            out.append((0, [line]))
    return [(kind, "\n".join(lines)) for kind, lines in out]


def features(kind: int, text: str, begins: bool) -> tuple[int, ...]:
    return (kind, min(len(text).bit_length(), 13), min(text.count("\n"), 5), int("?" in text), int(begins))


class Roles:
    """A hidden Markov model over ``ROLES``; logarithms of counts with one added."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: Sequence[np.ndarray]) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def fitted(cls, rows: pd.DataFrame) -> Roles:
        """From labelled rows ``conv_id``, ``role`` and ``text`` in order."""
        n = len(ROLES)
        start, move, emit = np.ones(n), np.ones((n, n)), [np.ones((n, k)) for k in SIZES]
        for kind in range(1, n + 1):
            emit[0][kind - 1, kind] += 100  # markers mean what they say, also where the sample has none
        last_conv, before = object(), None
        for conv, role, text in zip(rows["conv_id"], rows["role"], rows["text"], strict=True):
            conv = None if conv is None or conv != conv else conv
            state = ROLES.index(role) if role in ROLES else None
            if state is not None:
                if conv != last_conv:
                    start[state] += 1
                elif before is not None:
                    move[before, state] += 1
                for i, (kind, piece) in enumerate(pieces(text)[:1]):
                    for counts, value in zip(emit, features(kind, piece, i == 0), strict=True):
                        counts[state, value] += 1
            last_conv, before = conv, state
        log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
        return cls(log(start), log(move), [log(x) for x in emit])

    def scores(self, observed: np.ndarray) -> np.ndarray:
        """Of each observation in each state."""
        return sum(table[:, observed[:, i]].T for i, table in enumerate(self.emit))

    def matrix(self, observed: np.ndarray) -> np.ndarray:
        """Best score from a state before the observations to one at their end; in the last row, from the start."""
        scores = self.scores(observed)
        out = np.vstack([self.move, self.start]) + scores[0]
        for score in scores[1:]:
            out = (out[:, :, None] + self.move[None]).max(axis=1) + score
        return out

    def path(self, observed: np.ndarray, before: int | None, last: int | None) -> np.ndarray:
        """Best states, given the one before and the one at the end where they are known."""
        scores = self.scores(observed)
        best = (self.start if before is None else self.move[before]) + scores[0]
        back = np.zeros((len(scores), len(ROLES)), np.int64)
        for i, score in enumerate(scores[1:], 1):
            steps = best[:, None] + self.move
            back[i] = steps.argmax(axis=0)
            best = steps.max(axis=0) + score
        out = np.empty(len(scores), np.int64)
        out[-1] = best.argmax() if last is None else last
        for i in range(len(scores) - 1, 0, -1):
            out[i - 1] = back[i, out[i]]
        return out


def _packed(block: int):
    """Consecutive rows of a conversation as one row, ``alone`` if the whole conversation is in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, conv, whole, first = TaskContext.get().partitionId(), 0, [], None, True, True

        def flush(alone: bool) -> pa.RecordBatch:
            nonlocal seq
            seq += 1
            columns = [
                pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([conv], kinds[0]), pa.array([alone]),
                pa.array([[x[0] for x in held]], pa.list_(kinds[1])), pa.array([[x[1] for x in held]], pa.list_(pa.string())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["part", "seq", "conv_id", "alone", "turns", "texts"])

        kinds = (pa.int64(), pa.int64())
        for batch in batches:
            kinds = (batch.column(0).type, batch.column(1).type)
            for c, turn, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if held and (c != conv or len(held) >= block):
                    # the first conversation of a partition may have begun in the one before
                    yield flush(whole and c != conv and not first)
                    whole, first = c != conv, first and c == conv
                    held = []
                conv = c
                held.append((turn, text))
        if held:
            yield flush(False)  # and the last may go on

    return run


def _observed(texts: Sequence[str | None]) -> tuple[list[int], list[str], np.ndarray]:
    rows, parts, seen = [], [], []
    for row, text in enumerate(texts):
        for i, (kind, piece) in enumerate(pieces(text)):
            rows.append(row)
            parts.append(piece)
            seen.append(features(kind, piece, i == 0))
    return rows, parts, np.array(seen, np.int64)


def _matrices(model: Roles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.matrix(_observed(texts)[2]).ravel().tolist() for texts in batch.column(3).to_pylist()]
            columns = [*[batch.column(i) for i in range(3)], pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "conv_id", "matrix"])

    return run


def _chained(table: pa.Table) -> pa.Table:
    """Roles before and at the end of each block of a conversation, by Viterbi over their matrices."""
    table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
    n, matrices = len(ROLES), [np.array(x).reshape(-1, len(ROLES)) for x in table.column("matrix").to_pylist()]
    best, back = matrices[0][n], [np.zeros(n, np.int64)]
    for matrix in matrices[1:]:
        steps = best[:, None] + matrix[:n]
        back.append(steps.argmax(axis=0))
        best = steps.max(axis=0)
    ends = [int(best.argmax())]
    for i in range(len(matrices) - 1, 0, -1):
        ends.append(int(back[i][ends[-1]]))
    ends.reverse()
    return pa.table({
        "part": table.column("part").cast(pa.int32()), "seq": table.column("seq"), "before": pa.array([-1, *ends[:-1]], pa.int32()),
        "last": pa.array(ends, pa.int32()), "final": pa.array([*[False] * (len(ends) - 1), True]),
    })


def _rendered(model: Roles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, alone, turns, texts, before, last, final in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows, parts, observed = _observed(texts)
                known = None if before is None or before < 0 else before
                states = model.path(observed, known, last).tolist()
                out, previous = [], known
                for part, state in zip(parts, states, strict=True):
                    head = f"<|{ROLES[state]}|>\n"
                    out.append(("\n" if state == previous else head if previous is None else f"<|end|>\n{head}") + part)
                    previous = state
                if alone or final:
                    out[-1] += "<|end|>\n"
                order, begun = [], {}
                for row in rows:
                    begun[row] = begun.get(row, -1) + 1
                    order.append(begun[row])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv] * len(rows), batch.column(0).type), pa.array([turns[r] for r in rows], batch.column(2).type.value_type),
                        pa.array(order, pa.int32()), pa.array([ROLES[s] for s in states]), pa.array(out, pa.string()),
                    ],
                    names=["conv_id", "turn", "piece", "role", "rendered"],
                )

    return run


def train(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Roles:
    """A model from at most ``train_rows`` labelled rows, whole conversations in order of a hash while they last."""
    labelled = rows.where(F.col("role").isin(*ROLES))
    n = labelled.count()
    sample = labelled.where(F.pmod(F.xxhash64(F.lit(7), "conv_id"), F.lit(max(1, -(-n // train_rows)))) == 0)
    ordered = sample.select("conv_id", "role", "text", "turn").orderBy("conv_id", "turn", F.xxhash64("text")).limit(train_rows)
    return Roles.fitted(ordered.toPandas())  # bounded by train_rows


def parsed(rows: DataFrame, model: Roles | None = None, block: int = BLOCK) -> DataFrame:
    """A row for each piece: ``conv_id``, ``turn``, ``piece`` (its place in the row), ``role`` and ``rendered``."""
    spark = rows.sparkSession
    ship(spark)
    model = model or train(rows)
    order = ["conv_id", "turn", F.xxhash64("text")]
    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("conv_id", "turn", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = f"part int, seq bigint, conv_id {kinds[0]}, alone boolean, turns array<{kinds[1]}>, texts array<string>"
    blocks = written(ranged.mapInArrow(_packed(block), schema), "transcript-blocks")
    open_blocks = blocks.where(~F.col("alone")).select("part", "seq", "conv_id", "texts")
    matrices = open_blocks.mapInArrow(_matrices(model), f"part int, seq bigint, conv_id {kinds[0]}, matrix array<double>")
    borders = matrices.groupBy("conv_id").applyInArrow(_chained, "part int, seq bigint, before int, last int, final boolean")
    joined = blocks.join(borders, ["part", "seq"], "left")
    chosen = joined.select("conv_id", "alone", "turns", "texts", "before", "last", "final")
    return chosen.mapInArrow(
        _rendered(model), f"conv_id {kinds[0]}, turn {kinds[1]}, piece int, role string, rendered string"
    )
