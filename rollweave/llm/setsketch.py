"""SetSketch (Ertl, 2021): registers that hold exponentially spaced, truncated minima.

Every element gives each of M registers an exponential arrival time; a register keeps the least, as
K = 1 - floor(log_BASE(time)), larger for earlier times and truncated to 0..TOP. Registers of a union are the maxima of
the registers, equal registers are likelier the more alike two sets are, and with known set sizes the numbers of larger,
equal and smaller registers give the likelihood of the similarity.

One Poisson process of rate M for each element, its points dealt to registers at random, is the same as M processes of
rate 1; only its points before a limit matter, so the work for a set of n elements is n plus a constant.
"""

from __future__ import annotations

import numpy as np

BANDS, ROWS = 32, 5
M = BANDS * ROWS
BASE = 1.001
TOP = 65_534
#: Arrival times are scaled so that sets of 1 to 10**12 elements stay inside 0..TOP.
_SHIFT = 27_500
_LOG = np.log(BASE)
#: Expected arrivals in a register before the first limit.
_DEPTH = 9.0


def mix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _registers(times: np.ndarray) -> np.ndarray:
    return np.clip(_SHIFT + 1 - np.floor(np.log(times) / _LOG), 0, TOP).astype(np.uint16)


def _least(hashes: np.ndarray, owner: np.ndarray, limit: np.ndarray, sets: int) -> np.ndarray:
    """Least arrival time of each register of each set, infinite where none is before the set's limit."""
    least = np.full(sets * M, np.inf)
    state, base, most = hashes, owner * M, limit[owner]
    at = np.zeros(len(hashes))
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        while len(state):
            state = state + step
            x = mix64(state)
            at = at - np.log1p(-((x >> np.uint64(12)).astype(np.float64) * 2.0**-52)) / M
            inside = at <= most
            state, base, most, at, x = state[inside], base[inside], most[inside], at[inside], x[inside]
            register = ((x & np.uint64(0xFFF)).astype(np.int64) * M) >> 12
            np.minimum.at(least, base + register, at)
    return least.reshape(sets, M)


def sketch(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Registers (sets x M, uint16) of sets given one after another as distinct 64-bit hashes; sizes must be positive."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    limit = _DEPTH / sizes
    least = _least(hashes, owner, limit, len(sizes))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    for i in np.flatnonzero(np.isinf(least).any(axis=1)):  # a few in a hundred: look further
        part, n = hashes[begins[i] : begins[i + 1]], 1
        while np.isinf(least[i]).any():
            n *= 2
            least[i] = _least(part, np.zeros(len(part), np.int64), limit[i : i + 1] * n, 1)[0]
    return _registers(np.maximum(least, 1e-300))


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of ROWS registers (sets x BANDS, int64)."""
    x = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), x.shape[:2]).copy()
    for j in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + x[:, :, j])
    return key.view(np.int64)


def likeliest(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sets with known sizes, on a grid of 1/256."""
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = M - up - down
    u = (size_a / (size_a + size_b))[:, None]
    j = np.linspace(0, 1, 257)[None, :]
    most = np.minimum(u, 1 - u) / np.maximum(u, 1 - u)  # the similarity can't exceed the ratio of the sizes

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / _LOG

    # for similarity j, the share of the union in a alone is proportional to u - (1 - u) j, in b alone to (1 - u) - u j
    pa, pb = p(u - (1 - u) * j), p((1 - u) - u * j)
    tiny = 1e-12
    like = up[:, None] * np.log(pa + tiny) + down[:, None] * np.log(pb + tiny) + same[:, None] * np.log(np.maximum(1 - pa - pb, tiny))
    like[j > most + 1 / 256] = -np.inf
    return j[0, np.argmax(like, axis=1)]
