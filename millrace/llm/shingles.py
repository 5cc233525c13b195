"""Word shingles as 64-bit codes, computed for many texts at once and alike on every machine."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
# 64-bit value of every byte, from a rule
_BYTES = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") for b in range(256)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of all texts in order, and the number of words of each text. A-Z count as a-z."""
    rows = [(t or "").encode().translate(_LOWER) + b" " for t in texts]
    flat = np.frombuffer(b"".join(rows), np.uint8)
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = flat != 32
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    first, last = edge[::2], edge[1::2]
    power = np.full(len(flat), _BASE, np.uint64)
    power[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[flat] * np.cumprod(power))])
    power[1:] = _INVERSE
    codes = mix((sums[last] - sums[first]) * np.cumprod(power)[first] + (last - first).astype(np.uint64))
    ends = np.cumsum([len(r) for r in rows])
    return codes, np.diff(np.searchsorted(first, ends), prepend=0)


def shingle_sets(texts: list[str | None], width: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct codes of each text's shingles of ``width`` words; fewer words count as one shingle."""
    words, counts = word_codes(texts)
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        rolled = mix(rolled + words[j:j + len(rolled)] + np.uint64(j))
    out, at = [], 0
    for count in counts.tolist():
        if count >= width:
            out.append(np.unique(rolled[at:at + count - width + 1]))
        elif count:
            code = np.zeros(1, np.uint64)
            for j in range(count):
                code = mix(code + words[at + j:at + j + 1] + np.uint64(j))
            out.append(code ^ np.uint64(count))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out
