"""Words and shingles of whole Arrow text columns, vectorised with numpy.

Texts are handled as UTF-8 bytes.  Every word class used here contains all
non-ASCII code points, whose UTF-8 bytes are all >= 0x80, so that a word is a
run of bytes of a 256-entry table.  A word's hash is a polynomial over its
bytes, read off prefix sums modulo 2**64, then mixed.  Long texts are never
cut: a chunk holds whole texts, and a single text larger than ``CHUNK_BYTES``
forms a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_M = 1 << 64
_P = 0x9E3779B97F4A7C15 | 1  # odd, so invertible modulo 2**64
_Q = 0xC2B2AE3D27D4EB4F | 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Fixed word classes (after A-Z were lower-cased), as tables over bytes.
WORD = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]
WORD[0x30:0x3A] = True
WORD[0x61:0x7B] = True
WORD[0x80:] = True
NONSPACE = np.ones(256, bool)  # [^\x20\x09-\x0D]
NONSPACE[[0x20, 9, 10, 11, 12, 13]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the largest n so far."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = 1 << max(12, (n - 1).bit_length())
        got = np.full(size, base, np.uint64)
        got[0] = 1
        np.multiply.accumulate(got, out=got)
        _powers[base] = got
    return got[:n]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about
    ``limit`` bytes; null texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Words of a chunk: byte ranges, the text each belongs to, and
    ``first``: the index of each text's first word (one more at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data = LOWER[data]
        mask = np.zeros(len(data) + 1, bool)
        mask[:-1] = table[self.data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = mask[:-1]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        self.start = np.flatnonzero(mask & (~before | cut))
        self.end = np.flatnonzero(before & (~mask | cut))
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def prefix_sums(self) -> np.ndarray:
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[self.data] * powers(_P, n), out=sums[1:])
        return sums

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        if not len(self):
            return np.zeros(0, np.uint64)
        sums = self.prefix_sums()
        back = powers(pow(_P, -1, _M), len(self.data))
        return mix((sums[self.end] - sums[self.start]) * back[self.start]
                   + (self.end - self.start).astype(np.uint64))

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


def shingles(hashes: np.ndarray, text: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words that lie in one text, and the index of
    the first word of each."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(text[:n] == text[k - 1:])
    total = np.full(n, (salt * 0xD6E8FEB86659FD93 + k) % _M, np.uint64)
    for j, q in enumerate(powers(_Q, k + 1)[1:]):
        total += hashes[j:j + n] * q
    return mix(total[at]), at


def whole(hashes: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One hash for the whole (short) word sequence of each of ``rows``."""
    out = np.zeros(len(rows), np.uint64)
    for x, r in enumerate(rows):
        h = hashes[first[r]:first[r + 1]]
        total = (int((h * powers(_Q, len(h) + 1)[1:]).sum(dtype=np.uint64)) + len(h)) % _M
        out[x] = total
    return mix(out)
