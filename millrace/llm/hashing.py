"""Rolling hashes over bytes and words of many texts at once, in numpy.

Words have two hashes, unlike each other: words of up to 16 bytes by mixing the
bytes themselves, longer ones by BLAKE2. Sums over units are for stretches of some
tens of units: over thousands of units there are sequences that collide whatever the base.
All sums are taken modulo 2**64. A stretch's hash is the sum of its units'
random numbers times powers of an odd base, shifted back to the stretch's
start, so stretches of equal units have equal hashes wherever they stand.
"""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: A random number for every byte.
BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, INVERSE)):
            x = np.full(size, base, U)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=U)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Prefix:
    """Prefix sums of a unit sequence, for the hashes of any stretches of it."""

    def __init__(self, units: np.ndarray):
        p, self.inverse = powers(len(units) + 1)
        self.sums = np.zeros(len(units) + 1, U)
        np.cumsum(units * p[:-1], dtype=U, out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        return (self.sums[k:] - self.sums[:-k]) * self.inverse[: len(self.sums) - k] if len(self.sums) > k else np.zeros(0, U)

    def stretches(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.inverse[start] + length.astype(U) * U(0xD1B54A32D192ED03))


#: For each of a word's two hashes: what its first and next 8 bytes are mixed with.
WORD_KEYS = ((0x8C3F5D1A7B9E2461, 0xD6E8FEB86659FD93), (0x5851F42D4C957F2D, 0xA0761D6478BD642F))


def word_hashes(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(2, words): two 64-bit hashes of the bytes of each word."""
    padded = np.concatenate([buf, np.zeros(16, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)

    def block(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Up to 8 bytes as a number."""
        x = np.ascontiguousarray(eights[at]).view("<u8").reshape(-1).astype(U, copy=False)
        return np.where(n >= 8, x, x & ((U(1) << (np.minimum(n, 7).astype(U) * U(8))) - U(1)))

    low, out = block(start, size), np.empty((2, len(start)), U)
    two, many = np.flatnonzero(size > 8), np.flatnonzero(size > 16)
    high = block(start[two] + 8, size[two] - 8) if len(two) else low[:0]
    for k, (seed, factor) in enumerate(WORD_KEYS):
        x = mix((low ^ U(seed)) + size.astype(U) * U(factor))
        x[two] = mix(x[two] ^ (high * U(factor) + U(seed)))
        out[k] = x
    for i in many.tolist():
        out[:, i] = np.frombuffer(hashlib.blake2b(buf[start[i] : start[i] + size[i]], digest_size=16).digest(), U)
    return out


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(two hashes, start, end in the joined buffer, first word of each text and the end) of the words of all texts."""
    buf = np.frombuffer(b"\n".join([*texts, b""]) or b"\n", np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    space = SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    return word_hashes(buf, start, end - start), start, end, np.searchsorted(start, at)


def owned_runs(units: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share an anchor: (text, start unit, windows in the run, anchor hash, anchor's unit).

    A window of ``window`` units has as its anchor the leftmost of its grams of
    ``gram`` units with the least hash. Equal windows have equal anchors at
    equal places, so all that can equal a window stands under its anchor's
    hash. ``first`` holds the first unit of each text and the end.
    """
    size, spread = first[1:] - first[:-1], window - gram + 1
    none = np.zeros(0, np.int64)
    if len(units) < window or not (size >= window).any():
        return none, none, none, none.astype(U), none
    grams = mix(Prefix(units).grams(gram))
    order = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
    wide = 1
    while 2 * wide <= spread:
        order = np.minimum(order[:-wide], order[wide:])
        wide *= 2
    if spread > wide:
        order = np.minimum(order[: len(order) - (spread - wide)], order[spread - wide :])
    anchor = (order & U(0xFFFFFFFF)).astype(np.int64)
    # Windows inside one text, in order; a run ends where the anchor or the text changes.
    count = np.maximum(0, size - window + 1)
    inside = np.zeros(len(anchor) + 1, np.int8)
    np.add.at(inside, first[:-1][count > 0], 1)
    np.add.at(inside, (first[:-1] + count)[count > 0], -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]))
    change = np.ones(len(starts), bool)
    change[1:] = (anchor[starts[1:]] != anchor[starts[:-1]]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(change)
    begin, n = starts[at], np.diff(np.concatenate([at, [len(starts)]]))
    owner = np.searchsorted(first, begin, "right") - 1
    return owner, begin, n, grams[anchor[begin]], anchor[begin]
