"""Vectorised hashing of words, shingles and fixed windows over Arrow text.

Everything works on the flat byte buffer of an Arrow string column, in slices
of bounded size, so no Python loop runs over words or bytes.

Words are runs of bytes other than 0x20 and 0x09-0x0D.  Multi-byte UTF-8
sequences hold only bytes of 0x80 and more, so byte-wise splitting is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Symbols handled at once; bounds the memory of a worker whatever the texts are.
SLICE = 1 << 19
_POS_BITS = U64(20)
_POS_MASK = U64((1 << 20) - 1)
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _splitmix(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, elementwise."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUE = _splitmix(256, 0x5851F42D4C957F2D)
#: Words longer than this are hashed by the library, one by one.
LONG_WORD = 64
#: The low bytes of a 64-bit number, by how many.
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)
#: The field that decides on long strings: whole numbers modulo a prime.
PRIME = (1 << 61) - 1
_P = U64(PRIME)
_BASE = 0x0F2D4C957F2D5851 % PRIME
_FIELD_BLOCK = 1 << 13


class _Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _R), ("down", _RINV)):
                steps = np.full(size, base, dtype=U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Rolling:
    """Hashes of any substring of a symbol sequence in O(1) each."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        up, self.down = _POWERS.get(n + 1)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(symbols * up[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U64))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:n] + U64(k))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> U64(61))
    # x - PRIME wraps around where x is below it.
    return np.minimum(x, x - _P)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, elementwise; b is below PRIME."""
    a = (a & _P) + (a >> U64(61))
    ah, al, bh, bl = a >> U64(31), a & U64(0x7FFFFFFF), b >> U64(31), b & U64(0x7FFFFFFF)
    mid = ah * bl + al * bh
    return _reduced(((ah * bh) << U64(1)) + (mid >> U64(30)) + ((mid & U64(0x3FFFFFFF)) << U64(31)) + al * bl)


class _FieldPowers:
    def __init__(self) -> None:
        self.up, self.down = (np.ones(1, dtype=U64) for _ in range(2))

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, PRIME))):
                mine = getattr(self, name)
                setattr(self, name, np.concatenate([mine, times(mine, np.full(size, pow(base, size, PRIME), dtype=U64))]))
        return self.up[:n], self.down[:n]


_FIELD_POWERS = _FieldPowers()


class Field:
    """Hashes of any substring of a sequence of symbols (any 64-bit numbers; those
    that agree modulo PRIME are one symbol), as polynomials over the field: two different strings of n symbols agree with a chance of n / PRIME, and
    no structure of theirs (such as Thue-Morse) makes them agree."""

    def __init__(self, symbols: np.ndarray) -> None:
        up, self.down = _FIELD_POWERS.get(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, dtype=U64)
        last = U64(0)
        # Block by block, as what a block needs stays in the processor's cache.
        for at in range(0, len(symbols), _FIELD_BLOCK):
            part = symbols[at : at + _FIELD_BLOCK]
            terms = times(part, up[at : at + len(part)])
            high, low = np.cumsum(terms >> U64(31)), np.cumsum(terms & U64(0x7FFFFFFF))
            # high * 2**31 + low, without leaving 64 bits.
            sums = (high >> U64(30)) + ((high & U64(0x3FFFFFFF)) << U64(31))
            sums += low
            sums += last
            self.sums[at + 1 : at + 1 + len(part)] = sums = _reduced(sums)
            last = sums[-1]

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        part = _reduced(self.sums[end] + (_P - self.sums[start]))
        return mix(times(part, self.down[start]) ^ mix((end - start).astype(U64)))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; nulls are empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    base = int(offsets[0]) if len(offsets) else 0
    return flat[base : int(offsets[-1]) if len(offsets) else 0], offsets - base


def row_slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about `limit` bytes; one row at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, stop
        row = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of words before each row."""
    inside = np.empty(len(data) + 1, dtype=bool)
    np.logical_not(SPACE[data], out=inside[:-1])
    inside[-1] = False
    edge = inside.copy()
    edge[1:] ^= inside[:-1]
    # A row's end cuts a word even where no space stands between two rows.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
    marks = np.flatnonzero(edge)
    starts, ends = marks[::2], marks[1::2]
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: eight bytes after eight go through the mixer,
    which isn't linear, so no kind of word collides by its structure."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    sizes = ends - starts
    out = mix(sizes.astype(U64) + U64(0x9E3779B97F4A7C15))
    at = np.arange(len(starts))
    for done in range(0, LONG_WORD, 8):
        left = np.minimum(sizes[at] - done, 8).astype(U64)
        piece = eight[starts[at] + done] & _BYTES[left]
        out[at] = mix(out[at] ^ mix(piece + U64(0xD1B54A32D192ED03)))
        at = at[sizes[at] > done + 8]
        if not len(at):
            return out
    for k in at.tolist():
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words within each row, and the row offsets of
    them.  A row with fewer than k words, but one at least, gives its whole
    sequence as one shingle."""
    counts = np.diff(offsets)
    n_out = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(n_out)])
    if not len(words):
        return np.zeros(0, dtype=U64), out_offsets
    row = np.repeat(np.arange(len(counts)), n_out)
    start = offsets[:-1][row] + (np.arange(out_offsets[-1]) - out_offsets[:-1][row])
    end = np.minimum(start + k, offsets[1:][row])
    return Rolling(words).hash(start, end), out_offsets


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[: len(values) - (width - span)], values[width - span :])
    return values


def window_runs(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Group the windows of `window` symbols in each row by their anchor.

    The anchor of a window is the start of its smallest gram (by hash, then
    leftmost).  Equal windows have their anchors at the same place, so windows
    can only be equal where their anchor grams are.  Windows with one anchor
    stand side by side; each run of them is one result: row, anchor, first and
    last start (in the row), gram hash, and hash of the whole run."""
    names = ("row", "anchor", "lo", "hi", "gram", "full")
    n = len(symbols)
    if n < window:
        return {x: np.zeros(0, dtype=U64 if x in ("gram", "full") else np.int64) for x in names}
    if n >= 1 << 20:
        raise ValueError("slices of at most 2**20 - 1 symbols")
    rolling = Rolling(symbols)
    grams = rolling.grams(gram)
    order = (grams & ~_POS_MASK) | np.arange(len(grams), dtype=U64)
    anchor = (sliding_min(order, window - gram + 1) & _POS_MASK).astype(np.int64)
    counts = np.diff(offsets)
    valid = np.maximum(counts - window + 1, 0)
    before = np.cumsum(valid) - valid
    row = np.repeat(np.arange(len(counts)), valid)
    start = offsets[:-1][row] + (np.arange(len(row)) - before[row])
    anchor = anchor[start]
    if not len(anchor):
        return window_runs(symbols[:0], offsets, window, gram)
    first = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    lo = np.flatnonzero(first)
    hi = np.concatenate([lo[1:], [len(anchor)]]) - 1
    base = offsets[:-1][row[lo]]
    s, e, a = start[lo], start[hi], anchor[lo]
    shape = ((a - s) * (window + 1) + (a - e)).astype(U64)
    return {"row": row[lo], "anchor": a - base, "lo": s - base, "hi": e - base, "gram": grams[a], "full": mix(Field(symbols).hash(s, e + window) ^ mix(shape))}
