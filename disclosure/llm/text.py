"""Vectorised word handling over Arrow string columns, shared by the operators.

Words are the maximal runs of characters outside space, tab, LF, VT, FF and CR. Those six are
single bytes in UTF-8 and never part of a longer sequence, so words are found on raw bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
# Bytes of terms: ASCII letters and digits, and all bytes of characters above ASCII.
IS_TERM = np.arange(256) >= 128
IS_TERM[48:58] = IS_TERM[65:91] = IS_TERM[97:123] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only

# Text bytes worked on at once in a task: bounds the size of every temporary array. A single
# longer document is a block of its own.
BLOCK_BYTES = 1 << 21

_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept between calls up to 4 million entries."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if len(have) <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (every output bit depends on every input bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` per span, from one pass of polynomial prefix sums."""
    base = _BASES[lane]
    inverse = pow(base, -1, 1 << 64)
    prefix = np.zeros(len(values) + 1, dtype=np.uint64)
    term = values.astype(np.uint64)
    term += np.uint64(1)
    term *= powers(base, len(values) + 1)[: len(values)]
    np.cumsum(term, out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * powers(inverse, len(values) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(_BASES[1 - lane]))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; a null is an empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], dtype=np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _valid(batch: pa.RecordBatch, column: str) -> pa.RecordBatch:
    """The batch with U+FFFD for every byte sequence of ``column`` that is not UTF-8 (Spark's strings may
    hold any bytes)."""
    data, _ = utf8(batch.column(column))
    if not len(data) or data.max() < 128:
        return batch
    try:
        data.tobytes().decode("utf-8")
        return batch
    except UnicodeDecodeError:
        raw = batch.column(column).cast(pa.binary()).to_pylist()
        texts = pa.array([None if x is None else x.decode("utf-8", errors="replace") for x in raw], pa.string())
        return batch.set_column(batch.schema.get_field_index(column), column, texts)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about :data:`BLOCK_BYTES` of ``column`` (whole rows), with
    invalid UTF-8 replaced. A longer text is a slice of its own."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < n:
            to = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1
            to = min(max(to, at + 1), n)
            yield _valid(batch.slice(at, to - at), column)
            at = to


class Words:
    """Words of a block of texts: byte spans, row of each word, and words per row.

    ``inside`` marks the bytes that words are made of; without it, all but the six spaces.
    """

    def __init__(self, column: pa.Array, lower: bool = False, inside: np.ndarray | None = None):
        data, self.offsets = utf8(column)
        self.data = LOWER[data] if lower else data
        n = len(data)
        solid = np.zeros(n + 2, dtype=bool)
        solid[1 : n + 1] = ~IS_SPACE[data] if inside is None else inside[data]
        cut = np.zeros(n + 1, dtype=bool)  # a text begins (or the last one ends) here
        cut[self.offsets] = True
        inner = solid[1:-1]
        self.starts = np.flatnonzero(inner & (~solid[:n] | cut[:n]))
        self.ends = np.flatnonzero(inner & (~solid[2:] | cut[1:])) + 1
        self.rows = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.rows, minlength=len(column)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])  # first word of each row

    def hashes(self, lane: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, lane)

    def windows(self, hashes: np.ndarray, size: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every ``size``-word window inside one row."""
        at = np.arange(max(0, len(hashes) - size + 1))
        at = at[self.rows[at] == self.rows[at + size - 1]] if len(at) else at
        return at, span_hashes(hashes, at, at + size, lane)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from flat values and list lengths."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
