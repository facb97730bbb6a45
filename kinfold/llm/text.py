"""Bytes, words and hashes of whole Arrow batches in numpy, without a Python step per word."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from kinfold.llm.ship import ship

#: Bytes that one numpy step works on; a longer single text is a step of its own.
STEP_BYTES = 1 << 20


def bounded_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """Rows of an Arrow batch, so that a batch of long texts stays small beside a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the SplitMix generator: a bijection that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _byte_codes() -> np.ndarray:
    return _point_codes(np.arange(256))


def _point_codes(points: np.ndarray) -> np.ndarray:
    return splitmix((points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x632BE59BD9B4E019))


def _codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit code per byte or code point; the same for ASCII in both."""
    return _byte_codes()[data] if data.dtype == np.uint8 else _point_codes(data)


@lru_cache(maxsize=2)
def _powers(base: int) -> np.ndarray:
    """Powers of the base for the places of one step."""
    steps = np.full(STEP_BYTES + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _long_sum(data: np.ndarray) -> int:
    """Bytes times powers of a word longer than a step, step by step."""
    total, scale = 0, 1
    for at in range(0, len(data), STEP_BYTES):
        part = _codes(data[at : at + STEP_BYTES])
        total += scale * int((part * _powers(_BASE)[: len(part)]).sum(dtype=np.uint64))
        scale = scale * pow(_BASE, len(part), 1 << 64) % (1 << 64)
    return total % (1 << 64)


class Texts(NamedTuple):
    """UTF-8 bytes of some rows; row i holds ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def rows(self) -> int:
        return len(self.offsets) - 1

    def steps(self, limit: int = STEP_BYTES) -> Iterator[tuple[int, Texts]]:
        """(first row, rows) in turn, about ``limit`` bytes or one row each."""
        lo, n = 0, self.rows()
        while lo < n:
            hi = int(np.searchsorted(self.offsets, self.offsets[lo] + limit, "right")) - 1
            hi = min(n, max(hi, lo + 1))
            a, b = self.offsets[lo], self.offsets[hi]
            yield lo, Texts(self.data[a:b], self.offsets[lo : hi + 1] - a)
            lo = hi

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows(), dtype=np.int64), np.diff(self.offsets))


def texts_of(column: pa.Array | pa.ChunkedArray, lower: str | None = None) -> Texts:
    """Null texts are empty. lower: "ascii" for A-Z only, "unicode" for all letters."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower == "unicode":
        column = pc.utf8_lower(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower == "ascii":
        data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    return Texts(data, offsets)


def white(data: np.ndarray) -> np.ndarray:
    """Space and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def not_letters(data: np.ndarray) -> np.ndarray:
    """ASCII bytes that are neither letters nor digits."""
    alnum = ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    return ~alnum


class Words(NamedTuple):
    """Words in order; start and end are places in ``data``, bytes or code points, row is the text's place."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    data: np.ndarray

    def hashes(self, first_bytes: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first bytes. Sums and powers start anew every step, so a long text takes no more room."""
        end = self.end if first_bytes is None else np.minimum(self.end, self.start + first_bytes)
        out = np.zeros(len(self.start), np.uint64)
        lo = 0
        while lo < len(out):
            a = int(self.start[lo])
            hi = int(np.searchsorted(end, a + STEP_BYTES, "right"))
            if hi <= lo:
                out[lo] = _long_sum(self.data[a : end[lo]])
                lo += 1
                continue
            part = self.data[a : end[hi - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_codes(part) * _powers(_BASE)[: len(part)], out=sums[1:])
            out[lo:hi] = (sums[end[lo:hi] - a] - sums[self.start[lo:hi] - a]) * _powers(_INVERSE)[self.start[lo:hi] - a]
            lo = hi
        return splitmix(out + np.uint64(1))

    def counts(self, rows: int) -> np.ndarray:
        return np.bincount(self.row, minlength=rows)


def words_of(texts: Texts, gaps: Callable[[np.ndarray], np.ndarray] = white) -> Words:
    """Split at gap bytes and at the ends of texts; hashes come from running sums of bytes times powers."""
    data, offsets = texts
    n = len(data)
    inside = ~gaps(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, row, data)


#: Scripts written without spaces: first and last code points. Each of their characters is a word of its own.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF), (0x20000, 0x323AF),
)


@lru_cache(maxsize=1)
def _letter_classes() -> np.ndarray:
    """By code point: 0 gap, 1 letter, digit or mark, 2 character of an unspaced script."""
    import unicodedata

    last = UNSPACED[-1][1] + 1
    out = np.fromiter((unicodedata.category(chr(c))[0] in "LNM" for c in range(last)), np.uint8, last)
    for a, b in UNSPACED:
        out[a : b + 1] *= 2
    return np.append(out, np.uint8(0))


def letter_words(texts: Texts) -> Words:
    """Words of letters and digits by Unicode classes; the hash of a word depends on its characters alone."""
    data, offsets = texts
    if not len(data) or data.max() < 128:
        return words_of(texts, not_letters)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    offsets = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
    classes = _letter_classes()
    kind = classes[np.minimum(points, len(classes) - 1)]
    n = len(points)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    alone = kind == 2
    inside = kind == 1
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first | alone), np.flatnonzero(last | alone) + 1
    return Words(start, end, np.searchsorted(offsets, start, "right") - 1, points)


def within(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run`` maps record batches of a partition to tables or batches of the schema's columns."""

    ship(df.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(source):
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out.combine_chunks().to_batches()

    return df.mapInArrow(batches, schema)


def doc_hash(ids: pa.Array) -> np.ndarray:
    """crc32 of each id as decimal text; a null id counts as empty text."""
    import zlib

    return np.fromiter((zlib.crc32(str(i).encode() if i is not None else b"") for i in ids.to_pylist()), np.uint32, len(ids))


def schema_with(df: DataFrame, name: str, kind) -> StructType:
    """The frame's schema and one more column."""
    return StructType([*df.schema.fields, StructField(name, kind)])
