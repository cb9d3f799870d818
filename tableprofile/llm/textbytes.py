"""Words, shingles and window hashes of UTF-8 bytes as numpy arrays, for use inside tasks."""

from __future__ import annotations

import numpy as np

U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def draw(x: np.ndarray, stream: int) -> np.ndarray:
    """Pseudo-random 64-bit numbers that depend on x and the number of the stream."""
    return mix(x + U(((stream + 1) * 0x9E3779B97F4A7C15) % 2**64))


BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_codes = draw(np.arange(256, dtype=U), 0)
CODES, LOWER_CODES = _codes, _codes[LOWER]
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2**64 for i up to n."""
    if len(_powers["up"]) <= n:
        size = max(2 * n, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            steps = np.full(size + 1, base, U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def sums(data: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    """Prefix sums from which the hash of any substring follows."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(codes[data] * powers(len(data))[0][: len(data)], out=out[1:])
    return out


#: What does not belong to a word of letters and digits; bytes from 128 on are parts of letters.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def words(data: np.ndarray, gaps: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without bytes of `gaps`."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = gaps[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, codes: np.ndarray = LOWER_CODES, gaps: np.ndarray = WHITE) -> np.ndarray:
    start, end = words(data, gaps)
    total = sums(data, codes)
    return mix((total[end] - total[start]) * powers(len(data))[1][start])


def shingles(data: np.ndarray, n: int) -> np.ndarray:
    """The sorted set of hashes of n consecutive words; with fewer words, of the whole sequence; none without words."""
    w = word_hashes(data)
    if not len(w):
        return w
    if len(w) < n:
        out = U(len(w))
        for x in w:
            out = mix(np.array([out * U(0x9E3779B97F4A7C15) + x], U))[0]
        return np.array([out], U)
    out = np.zeros(len(w) - n + 1, U)
    for i in range(n):
        out = out * U(0x9E3779B97F4A7C15) + w[i : len(w) - n + 1 + i]
    return np.unique(mix(out))


np.seterr(over="ignore")
