"""Vectorised text kernels for Arrow batches: words, word hashes, shingles.

Each function takes the UTF-8 bytes of many texts at once, so the per-row Python work stays small.
A word is ``[^\\x20\\x09-\\x0D]+``; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
#: Bytes of text handled in one numpy step; one longer text is a step of its own.
STEP_BYTES = 1 << 20
#: Rows that one step has at most.
STEP_ROWS = 1024

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, STEP_BYTES + 1)
        have = np.full(size, np.uint64(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def steps(column: pa.Array | pa.ChunkedArray, size: int = STEP_BYTES, most: int = STEP_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of a string column, in steps of about size bytes and at most so many rows.

    Null texts count as empty.
    """
    for start in range(0, len(column), most):
        part = column.slice(start, most)
        if isinstance(part, pa.ChunkedArray):
            part = part.combine_chunks()
        part = pa.array(part).cast(pa.large_string()).fill_null("")
        _, offs, data = part.buffers()
        offsets = np.frombuffer(offs, np.int64)[part.offset : part.offset + len(part) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        a = 0
        while a < len(part):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
            b = min(b, len(part))
            yield start + a, start + b, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            a = b


def words(buf: np.ndarray, rows: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words (runs of bytes of is_word), and each row's first word (len(rows) entries)."""
    n = len(buf)
    inside = is_word[buf]
    brk = np.zeros(n + 1, bool)
    brk[rows] = True
    brk[n] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (brk[:n] | ~before))
    after = np.zeros(n, bool)
    after[: n - 1] = inside[1:]
    ends = np.flatnonzero(inside & (brk[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, rows)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: differences of a polynomial prefix sum, then mixed."""
    n = len(buf)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power_table(_INV, n + 1)[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def windows(h: np.ndarray, first: np.ndarray, k: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's k-word windows and each row's first window.

    whole: a row of 1 to k-1 words gives its whole sequence as one window.
    """
    count = np.diff(first)
    per = np.maximum(count - k + 1, 0)
    short = np.flatnonzero((count > 0) & (count < k)) if whole else np.zeros(0, np.int64)
    per[short] = 1
    out = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=out[1:])
    at = np.arange(out[-1]) + np.repeat(first[:-1] - out[:-1], per)
    g = np.zeros(len(at), np.uint64)
    top = len(h) - 1
    factor = np.uint64(0xA0761D6478BD642F)
    for j in range(k):
        g = g * factor + h[np.minimum(at + j, top)]
    for r in short:
        x = np.uint64(count[r])
        with np.errstate(over="ignore"):
            for w in h[first[r] : first[r + 1]]:
                x = x * np.uint64(0xE7037ED1A0B428DB) + w
        g[out[r]] = x
    return mix(g), out


def shingles(buf: np.ndarray, rows: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of A-Z-lowered texts, with repeats, and each row's first."""
    low = LOWER[buf]
    s, e, first = words(low, rows)
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    return windows(word_hashes(low, s, e), first, k, whole=True)


def distinct(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's sorted distinct hashes, and each row's first."""
    parts = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    out = np.zeros(len(first), np.int64)
    np.cumsum([len(p) for p in parts], out=out[1:])
    return (np.concatenate(parts) if parts else h[:0]), out


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    buf = np.frombuffer((text or "").encode(), np.uint8)
    h, _ = shingles(buf, np.array([0, len(buf)]), k)
    return np.unique(h)
