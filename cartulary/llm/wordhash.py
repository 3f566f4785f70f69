"""Words of a block of UTF-8 bytes and their 64-bit hashes, by array operations on the bytes."""

from __future__ import annotations

import functools

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 20


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for out, base in ((up, BASE), (down, inverse)):
        out[0] = 1
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return up, down


@functools.lru_cache(maxsize=4)
def letter_table(digits: bool) -> np.ndarray:
    """Byte to lower-case byte for letters (A-Z folded, bytes from 0x80 as they are), 0 for the rest."""
    t = np.zeros(256, np.uint8)
    t[0x80:] = np.arange(0x80, 0x100)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    if digits:
        t[0x30:0x3A] = np.arange(0x30, 0x3A)
    return t


def _mixed(h: np.ndarray, length: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h += length.astype(np.uint64)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def word_hashes(raw: np.ndarray, offsets: np.ndarray, digits: bool = False, lead: int = 0) -> tuple[np.ndarray, ...]:
    """Hashes, rows, first bytes and ends of the runs of letters in rows ``offsets`` of ``raw``,
    and hashes of the first ``lead`` bytes of each (none if 0).

    A run that spans two rows is cut at the border.  ``offsets`` are positions in ``raw``.
    """
    base, end = int(offsets[0]), int(offsets[-1])
    low = letter_table(digits)[raw[base:end]]
    n = len(low)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    inside = low != 0
    cut = np.zeros(n + 1, bool)
    cut[offsets - base] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(max(BLOCK, 1 << (n - 1).bit_length()) + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(low.astype(np.uint64) * up[:n], out=prefix[1:])
    h = _mixed((prefix[e] - prefix[s]) * down[s], e - s)
    short = np.minimum(e, s + lead)
    first_bytes = _mixed((prefix[short] - prefix[s]) * down[s] + np.uint64(lead), short - s) if lead else h[:0]
    return h, np.searchsorted(offsets - base, s, side="right") - 1, s + base, e + base, first_bytes
