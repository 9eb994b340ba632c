"""Word and word-shingle hashes of many texts at once, in NumPy.

Words are the runs of bytes outside ``\\x20\\x09-\\x0D``. A word's hash is a polynomial over a random byte table modulo
2**64, mixed; a shingle's hash combines those of its words. Hashes stand for their words: two different shingles are
taken for one with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_B = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = np.random.Generator(np.random.PCG64(77)).integers(1, _MASK, 64, dtype=np.uint64, endpoint=True) | U(1)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _B), ("down", pow(_B, -1, 1 << 64))):
            _powers[name] = np.cumprod(np.full(size, base, np.uint64))
    out = _powers["up"][:n], _powers["down"][:n]
    if n > 1 << 22:  # do not keep what one very long text needed
        _powers.clear()
    return out


def word_hashes(texts: list[str | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and each text's first word's position (one more entry than texts)."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) if parts else np.zeros(0, np.int64)
    raw = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    gap = _SPACE[raw]
    before = np.concatenate(([True], gap[:-1]))
    starts = np.flatnonzero(~gap & before)
    stops = np.flatnonzero(gap & ~before)
    up, down = _power(len(raw))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[_LOWER[raw] if lower else raw] * up)))
    hashes = mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))
    return hashes, np.concatenate((np.zeros(1, np.int64), np.searchsorted(starts, ends)))


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside a text, the text of each, and the position of its first word.

    A text with fewer words, but at least one, has its whole sequence as one window.
    """
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(first[doc + 1] - np.arange(len(hashes)) >= size) if len(hashes) else np.zeros(0, np.int64)
    value = np.zeros(len(whole), np.uint64)
    for k in range(size):
        value += mix(hashes[whole + k] + _PLACES[k]) * _PLACES[size + k]
    short = np.flatnonzero((counts > 0) & (counts < size))
    brief = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        at = first[short] + k
        has = k < counts[short]
        brief[has] += mix(hashes[at[has]] + _PLACES[k]) * _PLACES[size + k]
    brief += counts[short].astype(np.uint64) * U(0xA24BAED4963EE407)
    at = np.concatenate((whole, first[short]))
    order = np.argsort(at, kind="stable")
    return mix(np.concatenate((value, brief)))[order], np.concatenate((doc[whole], short))[order], at[order]
