"""Whole texts to token ids with the ``tokenizers`` library, each distinct piece of text encoded once.

The library spends most of its time on words it has seen before. Here a text is cut at single spaces, where the
pre-tokenisers of both kinds cut as well, and the ids of a chunk are remembered. A chunk of plain letters and marks
goes to the library's merge model directly, any other through the whole library, so the ids are the library's.

Names of the vocabulary's added tokens (``<|endoftext|>``) are plain text unless ``added_tokens`` is set; then they get
their own ids, as by the library's default, and a text that holds one goes through the whole library uncut.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?|()%*&$#"
_LATIN = re.compile(f"[{_LETTERS}]+")
_PLAIN = re.compile(rf"[{_LETTERS}]+[{_MARKS}]*(?:\n[{_LETTERS}]+[{_MARKS}]*)*")
_PIECES = re.compile(rf"[{_LETTERS}]+|[{_MARKS}]+|\n")
_SAFE_SPACE = re.compile(r"(?<=\S)\x20(?=\S)")
#: Chunks remembered in a worker; beyond it the older half is forgotten.
REMEMBERED = 800_000


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Unsafe(Exception):
    """A space that doesn't stand alone between two other characters."""


class Encoder(dict):
    """Ids as little-endian unsigned 32-bit bytes; as a dict, of the chunk behind a space."""

    def __init__(self, path: str, remembered: int = REMEMBERED, added_tokens: bool = False) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        known = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in known if added_tokens or not token.special]
        self.model, self.alphabet = self.tokenizer.model, _byte_alphabet()
        self.spaced = self.model.end_of_word_suffix is None  # a space belongs to the word behind it
        self.half, self.older = remembered // 2, {}
        self.space = self.alphabet[0x20] if self.spaced else ""
        self.marks = {mark: self._library(mark) for mark in _MARKS}
        # a letter of Latin-1 as the characters of its two bytes
        self.latin = {c: "".join(self.alphabet[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.tokenize = self.model.tokenize
        self.runs: dict[str, bytes] = {}
        self.newline = self._library("\n") if self.spaced else b""

    def _library(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def _bytes(ids: Iterable[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _piece(self, piece: str, before: str = "") -> bytes:
        """Ids of one pre-token, by the merge model alone."""
        if not piece.isascii() or not piece.isalpha():
            piece = piece.encode().decode("latin-1").translate(self.alphabet)
        return self._bytes([token.id for token in self.model.tokenize(before + piece)])

    def _word(self, word: str) -> bytes:
        """Ids of a word of Latin letters behind a space."""
        if not self.spaced and not word.islower():
            return self[word.lower()]
        shown = word if word.isascii() else word.translate(self.latin)
        return self._bytes([token.id for token in self.tokenize(self.space + shown)])

    def _run(self, marks: str) -> bytes:
        """Ids of a run of marks, none for an empty one."""
        ids = self.runs.get(marks)
        if ids is None:
            ids = self._piece(marks) if marks else b""
            if len(marks) < 9:  # no more than fit
                if len(self.runs) > 50_000:
                    self.runs.clear()
                self.runs[marks] = ids
        return ids

    def _line(self, line: str) -> bytes:
        """Ids of a plain word and its marks behind a line feed; remembered under a key of their own."""
        if not self.spaced:
            return self[line]
        key = f"\n{line}"
        ids = self.get(key) or self.older.get(key)
        if ids is None:
            word = line.rstrip(_MARKS)
            ids = self[key] = self.newline + self._piece(word) + self._run(line[len(word) :])
        return ids

    def _plain(self, chunk: str) -> bytes:
        """Ids of plain lines behind a space, each a word with marks; of several lines, only these are remembered."""
        first, *more = chunk.split("\n")
        if more:
            return self[first] + b"".join([self._line(line) for line in more])
        word = chunk.rstrip(_MARKS)
        return self[word] + self._run(chunk[len(word) :])

    def _chunk(self, chunk: str, spaced: bool) -> bytes:
        if not _PLAIN.fullmatch(chunk):
            return self._library(f" {chunk}" if spaced else chunk)
        if self.spaced:
            first, *rest = _PIECES.findall(chunk)
            return b"".join([self._piece(first, self.space if spaced else ""), *map(self._piece, rest)])
        return b"".join([self._piece(piece) for piece in _PIECES.findall(chunk.lower()) if piece != "\n"])

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            word, mark = (chunk, b"") if chunk.isalpha() else (chunk[:-1], self.marks.get(chunk[-1:]))
            if mark is not None and word.isalpha() and (word.isascii() or _LATIN.fullmatch(word)):
                # a word that only comes with a mark isn't remembered without it
                ids = (self.get(word) or self.older.get(word) or self._word(word)) + mark
            else:
                if self.spaced and (not chunk or chunk[0].isspace() or chunk[-1].isspace()):
                    raise _Unsafe
                if _PLAIN.fullmatch(chunk):
                    ids = self._plain(chunk)
                    if "\n" in chunk:
                        return ids
                else:
                    ids = self._chunk(chunk, self.spaced)
        self[chunk] = ids
        return ids

    def _joined(self, chunks: list[str]) -> bytes:
        return b"".join(itemgetter(*chunks)(self)) if len(chunks) > 1 else b"".join([self[chunk] for chunk in chunks])

    def ids(self, text: str) -> bytes:
        """Ids of a whole text."""
        if any(name in text for name in self.added):
            return self._library(text)
        if len(self) > self.half:
            self.older = dict(self)
            self.clear()
        chunks = text.split(" ")
        if not self.spaced:
            return self._joined(chunks)
        try:
            if not chunks[0] or chunks[0][-1].isspace():
                raise _Unsafe
            return self._chunk(chunks[0], False) + self._joined(chunks[1:])
        except _Unsafe:
            first, *rest = _SAFE_SPACE.split(text)
            return self._library(first) + b"".join([self._library(f" {chunk}") for chunk in rest])


@lru_cache(maxsize=2)
def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file; tasks in the same worker share it."""
    return Encoder(path, added_tokens=added_tokens)


Batches = Iterator[pa.RecordBatch]


def encoded(
    docs: DataFrame, path: str, end_id: int, then: Callable[[Batches], Batches] | None = None, schema: str | None = None,
    added_tokens: bool = False,
) -> DataFrame:
    """Documents as ``part``, ``idx`` (position of a row in its partition), the id column, ``n_tokens``, ``ids`` and
    ``before`` (ids of the partition's rows above).

    ``ids`` are little-endian unsigned 32-bit ids of the whole text, ``end_id`` last; a null text is empty.
    ``then`` goes on with these batches in the same task, to rows of ``schema``.
    """
    end = array("I", [end_id]).tobytes()

    def run(batches: Batches) -> Batches:
        encode, part, at, total = encoder(path, added_tokens).ids, TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece = batch.slice(lo, 512)
                ids = [encode((t or b"").decode("utf-8", "replace")) + end for t in piece.column(1).to_pylist()]
                n, sizes = len(ids), [len(x) // 4 for x in ids]
                before = list(accumulate(sizes, initial=total))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), piece.column(0),
                        pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(before[:-1], pa.int64()),
                    ],
                    names=["part", "idx", "doc_id", "n_tokens", "ids", "before"],
                )
                at, total = at + n, before[-1]

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary"))
    if then is not None:
        return rows.mapInArrow(lambda batches: then(run(batches)), schema)
    return rows.mapInArrow(run, f"part int, idx bigint, doc_id {kind}, n_tokens bigint, ids binary, before bigint")
