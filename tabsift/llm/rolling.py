"""Rolling hashes over bytes and content-defined chunk boundaries, vectorised."""

from __future__ import annotations

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers are invertible modulo 2**64
_TABLE = np.random.Generator(np.random.PCG64(42)).integers(1, 2**63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit hashes so that every bit is usable (murmur finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def window_hashes(buf: np.ndarray, width: int, table: np.ndarray = _TABLE, mult: np.uint64 = _MULT) -> np.ndarray:
    """Hash of every ``width``-byte window (polynomial modulo 2**64 over a random byte table, then mixed).

    Built by doubling: the hash of 2n bytes is two hashes of n bytes; other widths join overlapping halves.
    """
    if len(buf) < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h, n, m = table[buf], 1, mult
        while n * 2 <= width:
            h = h[:-n] * m + h[n:]
            m, n = m * m, n * 2
        if n < width:
            extra = width - n
            h = h[: len(h) - extra] * (m + np.uint64(2)) + h[extra:]
        return mix(h)


def chunk_ends(data: bytes, average: int, smallest: int, largest: int, width: int = 32) -> list[int]:
    """End offsets of content-defined chunks (the last is ``len(data)``; empty input has none).

    A cut follows a byte whose ``width``-byte window hash falls into one part in ``average``, at least
    ``smallest`` and at most ``largest`` bytes after the previous cut, and never inside a UTF-8 character.
    """
    n = len(data)
    if n <= smallest:
        return [n] if n else []
    buf = np.frombuffer(data, np.uint8)
    h = window_hashes(buf, width)
    cand = np.flatnonzero(h < np.uint64(2**64 // average)) + width
    cand = cand[cand < n]
    cand = cand[(buf[cand] & 0xC0) != 0x80].tolist()
    ends, last = [], 0
    cand.append(n)
    for c in cand:
        while c - last > largest:
            cut = last + largest
            while cut > last + 1 and (data[cut] & 0xC0) == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
        if c - last >= smallest:
            ends.append(c)
            last = c
    if not ends or ends[-1] != n:
        ends.append(n)
    return ends


def sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over every run of ``width`` values, by doubling."""
    n = 1
    out = values
    while n * 2 <= width:
        out = op(out[:-n], out[n:])
        n *= 2
    if n < width:
        extra = width - n
        out = op(out[: len(out) - extra], out[extra:])
    return out
