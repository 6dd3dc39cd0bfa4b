"""Vectorised numpy kernels over the text column of Arrow batches: words, word hashes, n-gram hashes.

A word is a maximal run of bytes other than space and 09-0D, as UTF-8 these are the words
``[^\\x20\\x09-\\x0D]+`` of the text. A word's 64-bit hash is a chain over its lanes of eight bytes, each
step a bijective multiply-xorshift mix, from its length on; words over ``LONG`` bytes take BLAKE2b. No sum
or product of bytes decides, so no arrangement of repeated parts cancels out. They depend on nothing but the words.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_WORD_BASE = U(0xD6E8FEB86659FD93 | 1)
#: Bytes beyond which a word is hashed by BLAKE2b.
LONG = 512
#: Bytes of text that one pass works on; numpy's temporaries take about 15 times as much.
CHUNK_BYTES = 600_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 arrays."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_TAIL = (U(1) << (U(8) * np.arange(8, dtype=U))) - U(1)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges start..end of data."""
    size = end - start
    lanes = np.ndarray(len(data) + 1, "<u8", np.concatenate((data, np.zeros(8, np.uint8))), 0, (1,))  # eight bytes from each byte on
    out = mix(size.astype(U) + U(0x2545F4914F6CDD1D))
    rows = np.flatnonzero(size <= LONG)
    at, left = start[rows], size[rows]
    while len(rows):
        lane = lanes[at]
        short = np.flatnonzero(left < 8)
        lane[short] &= _TAIL[left[short]]
        out[rows] = mix((out[rows] ^ lane) * U(0x9E3779B97F4A7C15))
        more = np.flatnonzero(left > 8)
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: U, n: int) -> np.ndarray:
    """base**0..n (wrapping); grown by doubling and kept a process."""
    have = _POWERS.get(int(base))
    if have is None or len(have) <= n:
        steps = np.full(max(1 << 16, 1 << int(n + 1).bit_length()), base, dtype=U)
        steps[0] = U(1)
        have = _POWERS[int(base)] = np.multiply.accumulate(steps)
    return have[: n + 1]


def _inverse(base: U) -> U:
    return U(pow(int(base), -1, 1 << 64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type) and not pa.types.is_binary(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), at


def pieces(at: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most about ``size`` bytes each (one row at least)."""
    n, lo = len(at) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, side="right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """Words of some rows: ``start``/``end`` byte positions in ``data``, ``of`` row bounds as word indices, ``hash``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, fold: bool, breaks: np.ndarray | None = None):
        at = at - at[0]
        space = (data == 32) | ((data >= 9) & (data <= 13)) if breaks is None else breaks[data]
        word = ~space
        first, last = word.copy(), word.copy()
        first[1:] &= space[:-1]
        last[:-1] &= space[1:]
        edge = at[:-1][at[:-1] < at[1:]]
        first[edge] = word[edge]
        edge = at[1:][at[:-1] < at[1:]] - 1
        last[edge] = word[edge]
        self.data, self.at = data, at
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.of = np.searchsorted(self.start, at)
        del space, word, first, last
        self.hash = word_hashes(LOWER[data] if fold else data, self.start, self.end)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and the row bounds of those whose n words lie in one row.

        A row with fewer than n words, but one at least, has its whole sequence as its only gram.
        """
        of = self.of
        counts = self.counts
        made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
        bounds = np.concatenate([[0], np.cumsum(made)])
        begin = np.arange(bounds[-1]) + np.repeat(of[:-1] - bounds[:-1], made)
        length = np.repeat(np.minimum(counts, n), made)
        out = mix(length.astype(U))
        for k in range(n if len(begin) else 0):
            own = np.flatnonzero(length > k)
            if len(own) == len(out):
                out = mix(out ^ self.hash[begin + k])
            else:
                out[own] = mix(out[own] ^ self.hash[begin[own] + k])
        return out, bounds

    def spans(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the full n-word windows only, the first word of each (index in its row) and row bounds.

        Sums of word hashes by powers of a base: for finding candidates, not for deciding.
        """
        m, of = len(self.hash), self.of
        total = np.zeros(m + 1, U)
        np.cumsum(self.hash * _powers(_WORD_BASE, m)[:m], out=total[1:])
        back = _powers(_inverse(_WORD_BASE), m)
        made = np.maximum(self.counts - n + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(made)])
        inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], made)
        begin = inside + np.repeat(of[:-1], made)
        return mix((total[begin + n] - total[begin]) * back[begin] + U(n)), inside, bounds


#: What a worker that turns to other work may forget; modules with large tables add theirs.
FORGET: list = [_POWERS.clear]


def forget() -> None:
    """Drops the tables that earlier tasks of other operators left in this worker and gives free memory back."""
    for drop in FORGET:
        drop()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def chunks(batch: pa.RecordBatch, fold: bool, text: int = 1, size: int = CHUNK_BYTES, breaks: np.ndarray | None = None) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, Words) over an Arrow batch whose column ``text`` holds the texts.

    breaks: the bytes between words as 256 flags, where they aren't space and 09-0D.
    """
    forget()
    data, at = buffers(batch.column(text))
    for lo, hi in pieces(at, size):
        yield lo, hi, Words(data[at[lo] : at[hi]], at[lo : hi + 1], fold, breaks)
