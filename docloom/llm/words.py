"""Word and shingle hashes of Arrow text columns, computed with numpy over the raw UTF-8 bytes.

A word is a run of bytes outside space and \\t \\n \\v \\f \\r; A-Z are lower-cased.  A word's hash is a polynomial over
random byte values modulo 2^64, taken from one cumulative sum, and then mixed; equal words have equal hashes in every
process and at every position.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E6C63D0876A9A63)
_INVERSE = np.uint64(pow(0x9E6C63D0876A9A63, -1, 1 << 64))


class Local(dict):
    """A process's own tables: travels to the tasks empty, as each process makes its own."""

    def __reduce__(self):
        return (Local, ())


_state = Local()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables():
    if "space" not in _state:
        space = np.zeros(256, bool)
        space[list(_SPACES)] = True
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        values[65:91] = values[97:123]
        letters = np.zeros(256, bool)
        letters[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
        _state.update(space=space, parted=~letters, values=values, power=np.ones(1, np.uint64), inverse=np.ones(1, np.uint64))
    return _state


def _powers(n: int):
    t = _tables()
    if len(t["power"]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for name, base in (("power", _BASE), ("inverse", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            t[name] = np.multiply.accumulate(steps)
    return t["power"], t["inverse"]


@dataclass
class Block:
    """Words of the rows ``first`` to ``first + len(bounds) - 1``: row i has words bounds[i] to bounds[i + 1]."""

    first: int
    words: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets (one more than rows) and the bytes of a string column; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    kind = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes each (one row at least)."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(stop, rows)
        row = min(stop, rows)


def word_blocks(texts: pa.Array, parted: bool = False) -> Iterator[Block]:
    """Hashes of every word of every row, slice by slice.  ``parted``: ASCII punctuation and symbols part words too."""
    offsets, data = _buffers(texts)
    t = _tables()
    for lo, hi in slices(offsets):
        at = offsets[lo : hi + 1] - offsets[lo]
        part = data[offsets[lo] : offsets[hi]]
        n = len(part)
        if n == 0:
            empty = np.zeros(0, np.int64)
            yield Block(lo, np.zeros(0, np.uint64), np.zeros(hi - lo + 1, np.int64), empty, empty, part)
            continue
        word = ~t["parted" if parted else "space"][part]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | edge[1:n]
        last[:-1] &= ~word[1:] | edge[1:n]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, inverse = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(t["values"][part] * power[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
        yield Block(lo, hashes, np.searchsorted(starts, at), starts, ends, part)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a row, and the row bounds in them.

    A row with fewer words, but at least one, has its whole sequence as its one shingle.
    """
    counts = np.diff(bounds)
    have = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(have)])
    out = np.empty(int(out_bounds[-1]), np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    if len(words) >= size:
        rolled = words[: len(words) - size + 1].copy()
        for j in range(1, size):
            rolled = rolled * factor + words[j : len(words) - size + 1 + j]
        row = np.repeat(np.arange(len(counts)), np.where(counts >= size, have, 0))
        step = np.arange(len(row)) - np.repeat(np.cumsum(np.where(counts >= size, have, 0)) - np.where(counts >= size, have, 0), np.where(counts >= size, have, 0))
        out[out_bounds[row] + step] = mix(rolled[bounds[row] + step])
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.uint64(counts[row])
        with np.errstate(over="ignore"):
            for w in words[bounds[row] : bounds[row + 1]]:
                value = value * factor + w
        out[out_bounds[row]] = mix(np.array([value]) ^ np.uint64(0x5851F42D4C957F2D))[0]
    return out, out_bounds


def distinct_per_row(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row, and the new bounds."""
    rows = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = np.fromiter((len(r) for r in rows), np.int64, len(rows))
    return (np.concatenate(rows) if rows else np.zeros(0, values.dtype)), np.concatenate([[0], np.cumsum(sizes)])
