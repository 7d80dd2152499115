"""Hashed word shingles of a batch of texts, in flat numpy arrays."""

from __future__ import annotations

import numpy as np

from estuary.llm.common import keeps

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = n + n // 8  # slices are alike in size; a long text's powers are kept as they are
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, b in enumerate((_BASE, inverse)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


_PRIME = np.uint64((1 << 31) - 1)
_BASES = (1_000_003_919, 1_584_931_031)
_MODULAR: dict[int, np.ndarray] = {}
keeps("shingles", _MODULAR.clear)


def modular_powers(base: int, n: int) -> np.ndarray:
    """Powers of a base modulo the prime, kept for later calls."""
    have = _MODULAR.get(base, np.ones(1, dtype=np.uint32))
    while len(have) < n:
        step = np.uint64(pow(base, len(have), int(_PRIME)))
        have = np.concatenate([have, (have * step % _PRIME).astype(np.uint32)])
    _MODULAR[base] = have
    return have[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text.

    A-Z are lower-cased; words are runs of bytes other than blank and 0x09-0x0D.
    """
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    # two polynomials modulo a prime: modulo a power of two, words of equal
    # length can have equal hashes whatever the base (Thue-Morse words do)
    halves = []
    for base in _BASES:
        power = modular_powers(base, len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)] % _PRIME, out=total[1:])
        inverse = modular_powers(pow(base, -1, int(_PRIME)), len(data) + 1)
        halves.append((total[end] - total[begin]) % _PRIME * inverse[begin] % _PRIME)
    hashes = mix(((halves[0] << np.uint64(32)) | halves[1]) + (end - begin).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    stops = np.cumsum(sizes)
    counts = np.diff(np.concatenate([[0], np.searchsorted(begin, stops)]))
    return hashes, counts


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text with fewer words is one shingle of all of them; without words it
    has none.
    """
    hashes, counts = word_hashes(texts)
    n = max(0, len(hashes) - words + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for j in range(words):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[j:j + n]
    rolled = mix(rolled)
    out, at = [], 0
    for count in counts.tolist():
        if count >= words:
            own = np.sort(rolled[at:at + count - words + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif count:
            short = np.uint64(count)
            for h in hashes[at:at + count]:
                short = mix(np.atleast_1d(short) * np.uint64(0xD6E8FEB86659FD93) + h)[0]
            out.append(np.array([short], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += count
    return out
