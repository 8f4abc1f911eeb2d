"""Word shingles of texts as 64-bit hashes, in numpy. Words are runs without ASCII white space."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
CHUNK = 1 << 20  # bytes hashed at once; longer words are hashed apart

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_BASE, _MIX1, _MIX2, _STEP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        down = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, x in (("up", _BASE), ("down", down)):
            row = np.full(size, x, np.uint64)
            row[0] = 1
            _powers[name] = np.cumprod(row, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def _hash_words(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    space = np.concatenate([[True], _SPACE[b], [True]])
    turns = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = turns[::2], turns[1::2]
    up, down = _tables(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    out = mix((sums[ends] - sums[starts]) * down[starts])
    for i in np.flatnonzero(ends - starts > CHUNK):
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def word_hashes(raw: bytes) -> np.ndarray:
    """Hash of each word, in order; long texts are cut at white space."""
    if len(raw) <= CHUNK:
        return _hash_words(raw)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        out.append(_hash_words(raw[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes. A text with fewer than ``size`` words has one, of all its words; no words: none."""
    words = word_hashes(text.encode("utf-8", "surrogatepass"))
    if not len(words):
        return words
    short = len(words) < size
    n = 1 if short else len(words) - size + 1
    out = np.full(n, np.uint64(len(words) if short else 0), np.uint64)
    for i in range(len(words) if short else size):
        out = out * _STEP + words[i : i + n]
    return np.unique(mix(out))


def min_hashes(shingles: np.ndarray, n: int = 128) -> np.ndarray:
    """``n`` 32-bit min-hashes of a set that is not empty."""
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    adds = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(best, (shingles[at : at + 4096, None] * factors + adds).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)
