"""Words and their hashes for whole Arrow batches, in a few numpy passes over the UTF-8 bytes.

A word is a run of bytes other than space and \\t..\\r; all of those are ASCII, so bytes give the same
words as code points. Word hashes are polynomials over the bytes modulo 2**64, mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multipliers of the polynomial, the mixer and the n-gram combination.
BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 19
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 65536)
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0][:n], _powers[1][:n]


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of about limit bytes, a longer text alone; null counts as empty."""
    for at in range(0, len(texts), 1024):  # little is copied at a time
        part = pc.fill_null(texts.slice(at, 1024).cast(pa.large_string()), "")
        _, off, data = part.buffers()
        n = len(part)
        offs = np.frombuffer(off, np.int64, n + 1 + part.offset)[part.offset :]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1))
            yield at + lo, at + hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            lo = hi


def lowered(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each word, and for each text the index of its first word (with one more at the end)."""
    solid = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    first = np.zeros(len(buf) + 1, bool)
    first[offs] = True
    before = np.empty(len(buf), bool)
    if len(buf):
        before[0] = False
        before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.zeros(len(buf), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on, without regard to where texts end; empty with fewer words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(m, n, np.uint64)
    for i in range(n):
        total *= np.uint64(BASE)
        total += h[i : i + m]
        total ^= total >> np.uint64(29)
    return mix(total)
