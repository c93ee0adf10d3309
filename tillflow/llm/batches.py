"""Words and hashes of whole Arrow text columns, computed with array operations.

Python workers see text as UTF-8 buffers; a slice of a few megabytes is hashed at a time, so
memory does not grow with the batch. One row is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_U64 = np.uint64
# The white space that ends a word, \x20 and \x09 to \x0D.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Letters, capitals and digits alike; other characters stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("9")

_RNG = np.random.default_rng(20240229)
_BYTE_CODE = _RNG.integers(1 << 62, size=256, dtype=np.uint64) | _U64(1)
_PLACE = _RNG.integers(1 << 62, size=64, dtype=np.uint64) | _U64(1)
_BASE = _U64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every bit."""
    x = values ^ (values >> _U64(30))
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def unit(values: np.ndarray) -> np.ndarray:
    """Uniform doubles in [0, 1) from 64-bit hashes."""
    return (values >> _U64(11)).astype(np.float64) * (1.0 / (1 << 53))


def slices(text: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `size` bytes of text each, or of one row."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
    start, base = 0, 0
    while start < len(text):
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and the place where each row starts, with the end; null is empty."""
    text = pc.fill_null(text, "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    wide = pa.types.is_large_string(text.type)
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[text.offset : text.offset + len(text) + 1].astype(np.int64)
    if not len(text) or data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(text) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def word_hashes(text: pa.Array, shape: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of each row, in order, and the number of words of each row.

    shape: words whose kinds of characters follow one another alike have equal hashes.
    """
    raw, offsets = text_bytes(text)
    if not len(raw):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets) - 1, dtype=np.int64)
    inside = ~_IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    firsts = np.flatnonzero(starts)
    counts = np.diff(np.searchsorted(firsts, offsets))
    if not len(firsts):
        return np.zeros(0, dtype=np.uint64), counts
    if shape:
        raw = _SHAPE[raw]
        inside[1:] &= starts[1:] | (raw[1:] != raw[:-1])
    places = np.flatnonzero(inside)
    heads = np.searchsorted(places, firsts)
    depth = np.arange(len(places)) - np.repeat(heads, np.diff(np.append(heads, len(places))))
    power = np.multiply.accumulate(np.full(int(depth.max()) + 1, _BASE, dtype=np.uint64))
    codes = _BYTE_CODE[raw[places]] * power[depth]
    return mix(np.add.reduceat(codes, heads)), counts


def shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words and the row of each.

    A row of fewer words, but at least one, has one shingle of all its words.
    """
    rows = np.repeat(np.arange(len(counts)), counts)
    full = len(words) - size + 1
    if full > 0:
        codes = words[:full] * _PLACE[0]
        for k in range(1, size):
            codes += words[k : k + full] * _PLACE[k]
        whole = rows[:full] == rows[size - 1 :]
        codes, of = mix(codes[whole]), rows[:full][whole]
    else:
        codes, of = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        at = np.concatenate([[0], np.cumsum(counts)])
        extra = [(words[at[r] : at[r + 1]] * _PLACE[: counts[r]]).sum(dtype=np.uint64) for r in short]
        codes = np.concatenate([codes, mix(np.array(extra, dtype=np.uint64))])
        of = np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        codes, of = codes[order], of[order]
    return codes, of


def weighted(codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, code) pairs in order of the rows: codes, rows and how often each occurs."""
    if not len(codes):
        return codes, of, np.zeros(0, dtype=np.int64)
    order = np.lexsort((codes, of))
    codes, of = codes[order], of[order]
    new = np.ones(len(codes), dtype=bool)
    new[1:] = (codes[1:] != codes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return codes[at], of[at], np.diff(np.append(at, len(codes)))
