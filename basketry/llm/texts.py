"""Whole texts of an Arrow column as one byte buffer, and their words by array operations.

A batch is worked on in slices of about a megabyte, so that the memory of a task does not
follow the batch size; a longer text is a slice of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from basketry.session import ensure_checkpoint_dir, tune

SLICE_BYTES = 1 << 20
ROWS_PER_BATCH = 500

# [^\x20\x09-\x0D]: every byte but ASCII white space (bytes above 0x7F belong to words).
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z became a-z: digits, letters and all beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_LONG_WORD = 256
_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators: tuned plans, small Arrow batches, checkpoints."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    ensure_checkpoint_dir(spark)
    return spark


def mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One step of a 64-bit hash: ``x`` into ``h``."""
    h = (h ^ x) * _M1
    h ^= h >> _S32
    h *= _M2
    h ^= h >> _S32
    return h


class Texts:
    """Texts laid end to end: ``data`` (eight zero bytes follow), ``offsets`` of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.size = len(data)
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.offsets = offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        return Texts(_LOWER[self.data[: self.size]], self.offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many positions of each text are set."""
        upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return upto[self.offsets[1:]] - upto[self.offsets[:-1]]

    def words(self, letters: np.ndarray = NOT_SPACE) -> Words:
        inside = letters[self.data[: self.size]]
        fresh = np.empty(self.size + 1, dtype=bool)
        fresh[0] = True
        np.logical_not(inside, out=fresh[1:])
        fresh[self.offsets] = True  # a word ends with its text
        starts = np.flatnonzero(inside & fresh[:-1])
        after = np.empty(self.size, dtype=bool)
        after[:-1] = ~inside[1:]
        after[-1:] = True
        last = self.offsets[self.offsets > 0] - 1
        after[last] = True
        ends = np.flatnonzero(inside & after) + 1
        return Words(self, starts, ends)


class Words:
    """Words of all texts in order; those of text i are ``at[i]:at[i + 1]``."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray):
        self.texts, self.starts, self.ends = texts, starts, ends
        self.at = np.searchsorted(starts, texts.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        lanes = np.ndarray((self.texts.size + 1,), "<u8", self.texts.data, strides=(1,))
        length = self.ends - self.starts
        h = length.astype(np.uint64) * _M2
        todo = np.arange(len(length))
        for k in range(0, _LONG_WORD, 8):
            if not len(todo):
                return h
            x = lanes[self.starts[todo] + k] & _KEEP[np.minimum(length[todo] - k, 8)]
            h[todo] = mix(h[todo], x)
            todo = todo[length[todo] > k + 8]
        for i in todo:  # very long words, each in a few large pieces
            word = self.texts.data[self.starts[i] : self.ends[i]]
            padded = np.concatenate([word, np.zeros(-len(word) % 8, np.uint8)]).view("<u8")
            weights = mix(np.arange(1, len(padded) + 1, dtype=np.uint64), _M2)
            h[i] = mix(h[i], np.bitwise_xor.reduce(mix(padded.copy(), weights)))
        return h


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string or binary column as one buffer; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    if not n:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, texts) of about ``limit`` bytes each."""
    whole = texts_of(column)
    first = 0
    while first < len(whole):
        stop = int(np.searchsorted(whole.offsets, whole.offsets[first] + limit, side="right")) - 1
        stop = min(max(stop, first + 1), len(whole))
        low, high = whole.offsets[first], whole.offsets[stop]
        yield first, stop, Texts(whole.data[low:high], whole.offsets[first : stop + 1] - low)
        first = stop
