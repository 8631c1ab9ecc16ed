"""Vectorised 64-bit hashes of words and word n-grams over many texts at once."""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A random value for each byte; the second table takes A-Z as a-z.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LOWER_VALUES = BYTE_VALUES[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
IS_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        with np.errstate(over="ignore"):
            done, step = 1, base
            while done < size:
                have[done : 2 * done] = have[:done] * np.uint64(step)
                done, step = 2 * done, step * step & MASK
        _powers[base] = have
    return have[:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * BASE**i, with a leading 0."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of values[start:stop] that do not depend on where they stand; the length is mixed in."""
    return mix((sums[stop] - sums[start]) * powers(INVERSE, len(sums))[start] + (stop - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Bytes of a window; a string's hash sums over its windows.
WINDOW = 8


def windows(data: np.ndarray) -> np.ndarray:
    """A random value for the WINDOW bytes from each place on (0 where fewer are left).

    Sums over single bytes modulo 2**64 collide for texts built like the Thue-Morse word; windows are not additive, so these do not."""
    out = np.zeros(len(data), np.uint64)
    if len(data) >= WINDOW:
        out[: 1 - WINDOW] = mix(np.ndarray((len(data) - WINDOW + 1,), np.uint64, np.ascontiguousarray(data), 0, (1,)) + np.uint64(0x9E3779B97F4A7C15))
    return out


def strings(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of the strings data[start:stop], of WINDOW bytes at least, from prefix sums of their windows."""
    return spans(sums, start, stop - (WINDOW - 1))


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each followed by a space, and where each starts (one more start than texts)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8) if texts else np.zeros(0, np.uint8)
    return data, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of all words."""
    space = np.concatenate([[True], IS_SPACE[data], [True]])
    change = np.flatnonzero(space[1:] != space[:-1])
    return change[::2], change[1::2]


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that start at each position but the last n - 1."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mix(out + hashes[k : k + size] + np.uint64(k + 1))
    return out
