"""Vectorised word views of Arrow string batches.

Helpers for code that runs inside tasks: a batch of texts becomes one byte
array with word boundaries, 64-bit word hashes and hashes of word windows, in
numpy, without a Python string per word. Words are runs of bytes outside
``\\x20\\x09-\\x0D``; a word never crosses a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: lower case, and every ASCII character that is neither letter nor digit a space
PLAIN = LOWER.copy()
PLAIN[[i for i in range(128) if not chr(i).isalnum()]] = 0x20

_R, _Q = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)  # odd, so invertible mod 2^64
_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)  # the first i bytes of a number
_LONG = 64
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: np.uint64, n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64, or of its inverse; grown when needed."""
    key = (int(base), int(inverse))
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        b = pow(int(base), -1, 1 << 64) if inverse else int(base)
        size = max(n, 1 << 16)
        p = np.full(size, b, U64)
        p[0] = 1
        with np.errstate(over="ignore"):
            have = _POWERS[key] = np.cumprod(p)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x = x * U64(0xFF51AFD7ED558CCD)
        x ^= x >> U64(33)
        x *= U64(0xC4CEB9FE1A85EC53)
        x ^= x >> U64(33)
    return x


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64, n + 1, col.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[o[0]:o[-1]], o - o[0]


@dataclass
class Words:
    """Words of a run of texts: byte ranges and the first word of each text."""
    buf: np.ndarray      # bytes, after the byte table
    start: np.ndarray    # first byte of each word
    end: np.ndarray      # byte after each word
    first: np.ndarray    # texts + 1: index of each text's first word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes: a polynomial over them mod 2^64,
        from prefix sums, then mixed with the length."""
        n = len(self.buf)
        if not len(self.start):
            return np.zeros(0, U64)
        with np.errstate(over="ignore"):
            p = np.empty(n + 1, U64)
            p[0] = 0
            np.cumsum((self.buf.astype(U64) + U64(1)) * _powers(_R, n), out=p[1:])
            h = (p[self.end] - p[self.start]) * _powers(_R, n, True)[self.start]
            return mix(h + (self.end - self.start).astype(U64) * U64(0x2545F4914F6CDD1D))


    def lanes(self) -> np.ndarray:
        """The 8 bytes from each byte on, as one number (zeros after the end)."""
        return np.ndarray((len(self.buf) + 1,), "<u8", np.concatenate([self.buf, np.zeros(8, np.uint8)]), strides=(1,))

    def lane(self, lanes: np.ndarray, which: np.ndarray, k: int) -> np.ndarray:
        """The k-th 8 bytes of some words, all longer than 8 k bytes; zeros after a word's end."""
        left = np.minimum(self.end[which] - self.start[which] - 8 * k, 8)
        return lanes[self.start[which] + 8 * k] & _LOW[left]

    def strong_hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes for comparing words: no two words of up to 8
        bytes share it. Eight bytes at a time through a bijective mixer; words of over
        ``_LONG`` bytes by XXH64."""
        size = self.end - self.start
        h = mix(size.astype(U64) + U64(1))
        lanes, rest, k = self.lanes(), np.flatnonzero(size <= _LONG), 0
        for i in np.flatnonzero(size > _LONG):
            h[i] = xxhash.xxh64_intdigest(self.buf[self.start[i]:self.end[i]].tobytes(), 42)
        while len(rest):
            with np.errstate(over="ignore"):
                h[rest] = mix(h[rest] * _R ^ self.lane(lanes, rest, k))
            k += 1
            rest = rest[size[rest] > 8 * k]
        return h

    def equal(self, mine: np.ndarray, other: "Words", theirs: np.ndarray) -> np.ndarray:
        """Whether word mine[i] has the bytes of other's word theirs[i]."""
        size = self.end[mine] - self.start[mine]
        same = size == other.end[theirs] - other.start[theirs]
        for i in np.flatnonzero(same & (size > _LONG)):
            a, b = mine[i], theirs[i]
            same[i] = bool((self.buf[self.start[a]:self.end[a]] == other.buf[other.start[b]:other.end[b]]).all())
        rest, k, x, y = np.flatnonzero(same & (size <= _LONG)), 0, self.lanes(), other.lanes()
        while len(rest):
            ok = self.lane(x, mine[rest], k) == other.lane(y, theirs[rest], k)
            same[rest[~ok]] = False
            k += 1
            rest = rest[ok]
            rest = rest[size[rest] > 8 * k]
        return same


def split_words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray | None = None) -> Words:
    if table is not None:
        buf = table[buf]
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(buf, z, z, np.zeros(len(offs), np.int64))
    non = ~_WS[buf]
    st = non.copy()
    st[1:] &= ~non[:-1]
    cut = offs[:-1]
    cut = cut[cut < n]
    st[cut] = non[cut]
    en = non.copy()
    en[:-1] &= ~non[1:]
    last = offs[1:] - 1
    last = last[last >= 0]
    en[last] = non[last]
    start = np.flatnonzero(st)
    return Words(buf, start, np.flatnonzero(en) + 1, np.searchsorted(start, offs))


def slices(offs: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``max_bytes`` together; a longer text
    stands alone and whole."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def window_sums(h: np.ndarray) -> np.ndarray:
    """Prefix sums for ``window_hash``."""
    p = np.empty(len(h) + 1, U64)
    p[0] = 0
    with np.errstate(over="ignore"):
        np.cumsum(h * _powers(_Q, len(h)), out=p[1:])
    return p


def window_hash(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the word sequence [lo, hi) for each pair, from prefix sums."""
    with np.errstate(over="ignore"):
        return mix((p[hi] - p[lo]) * _powers(_Q, len(p), True)[lo] + (hi - lo).astype(U64))


def ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Concatenation of arange(lo[i], lo[i] + n[i])."""
    total = int(n.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(n)
    return np.arange(total) - np.repeat(ends - n - lo, n)
