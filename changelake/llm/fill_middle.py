"""Fill-in-middle documents: prefix, middle and suffix change places, so that a model learns to fill gaps.

Cuts are chosen in code points and made in bytes. A text's *exceptions* are its characters of several bytes: their
positions and the bytes each has beyond the first. Both kinds of cut are converted by a binary search among these; what
lies between exceptions is ASCII, where positions differ by a constant. A text of plain ASCII has no exceptions, and no
text is turned into characters.

Null texts are empty, and an empty text stays plain; so does one that holds a marker, so that the text can be read back
from its output. A null id is hashed like an empty one. Repeated rows are cut alike, other columns are dropped, and an
empty table gives no rows. Texts of any length are cut whole, each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.storage import ship

#: Markers of the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Bytes of output after which a batch is handed on.
BATCH_BYTES = 8 << 20


class Exceptions:
    """The characters of several bytes in a UTF-8 text: ``chars`` and ``bytes`` are their positions counted in either
    unit, ``excess`` the bytes beyond one for each character in front of an exception (and, last, in the whole text)."""

    def __init__(self, text: bytes) -> None:
        self.n_bytes = len(text)
        if text.isascii():
            self.bytes = self.chars = np.zeros(0, np.int64)
            self.excess = np.zeros(1, np.int64)
        else:
            raw = np.frombuffer(text, np.uint8)
            self.bytes = np.flatnonzero(raw >= 0xC0)
            lead = raw[self.bytes]
            beyond = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
            self.excess = np.concatenate([[0], np.cumsum(beyond)])
            self.chars = self.bytes - self.excess[:-1]
        self.n_chars = self.n_bytes - int(self.excess[-1])

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Byte offsets of cuts in front of the given code points."""
        return cuts + self.excess[np.searchsorted(self.chars, cuts)]

    def to_chars(self, offsets: np.ndarray) -> np.ndarray:
        """Code points in front of byte offsets, which lie between characters."""
        return offsets - self.excess[np.searchsorted(self.bytes, offsets)]


def rearranged(text: bytes, cuts: np.ndarray, spm: bool, markers: tuple[bytes, ...]) -> bytes:
    """The text with its parts marked, cut at two byte offsets."""
    low, high = cuts.tolist()
    prefix, middle, suffix = markers[0] + text[:low], markers[2] + text[low:high], markers[1] + text[high:]
    return (suffix + prefix if spm else prefix + suffix) + middle


def _cut(percent: int, spm_percent: int, markers: tuple[bytes, ...]):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "cuts", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            first, size = 0, 0
            numbers = np.stack([batch.column(i).to_numpy() for i in range(2, 6)], axis=1) if batch.num_rows else ()

            def flush(first: int, rows: list[tuple], batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), *columns], names=names)

            for i, h in enumerate(numbers):
                text = batch.column(1)[i].as_py() or b""
                at = Exceptions(text)
                if not text or h[2] % 100 >= percent or any(mark in text for mark in markers):
                    rows.append((at.n_chars, "plain", None, None, None, text))
                else:
                    cuts = np.sort(h[:2] % (at.n_chars + 1))
                    offsets, spm = at.to_bytes(cuts), bool(h[3] % 100 < spm_percent)
                    chars = at.to_chars(offsets).tolist()
                    output = rearranged(text, offsets, spm, markers)
                    rows.append((at.n_chars, "spm" if spm else "psm", chars[0], chars[1] - chars[0], offsets.tolist(), output))
                size += len(rows[-1][-1])
                if size > BATCH_BYTES:
                    yield flush(first, rows)
                    first, rows, size = i + 1, [], 0
            if rows:
                yield flush(first, rows)

    return run


def fill_in_middle(
    docs: DataFrame, percent: int = 90, spm_percent: int = 20, seed: int = 1, markers: tuple[str, str, str] = MARKERS
) -> DataFrame:
    """``doc_id``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars``, ``cuts`` (byte offsets) and ``output``.

    Of each hundred documents, ``percent`` are rearranged, ``spm_percent`` of these with the suffix first. Cuts and forms
    come from the SHA-256 of seed and id, so reruns agree. ``form`` is ``psm``, ``spm`` or ``plain``; plain documents have
    no cuts and their text as output.
    """
    ship(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), *numbers)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, cuts array<bigint>, output binary"
    out = rows.mapInArrow(_cut(percent, spm_percent, tuple(mark.encode() for mark in markers)), schema)
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text behind an output: the parts between markers, in their first order."""

    def behind(mark: str, upto: str | None) -> Column:
        part = F.substring_index(output, mark, -1)
        return part if upto is None else F.substring_index(part, upto, 1)

    prefix, suffix, middle = markers
    psm = [behind(prefix, suffix), behind(middle, None), behind(suffix, middle)]
    spm = [behind(prefix, middle), behind(middle, None), behind(suffix, prefix)]
    joined = reduce(lambda out, case: out.when(form == case[0], F.concat(*case[1])), (("psm", psm), ("spm", spm)), F.when(F.lit(False), ""))
    return joined.otherwise(output)
