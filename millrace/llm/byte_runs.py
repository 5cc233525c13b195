"""Runs of byte windows that share a minimizer.

The hash of every ``GRAM`` bytes is taken; a window of ``width`` bytes is named by the least hash inside it. Equal
windows have equal names, so windows can be compared name by name. Neighbouring windows mostly share their name: a run
is a longest stretch of them within one text, and its segment is the bytes it covers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .shingles import _BASE, _BYTES, _INVERSE, mix

GRAM = 32


@dataclass
class Runs:
    name: np.ndarray  # least hash
    row: np.ndarray  # text
    start: np.ndarray  # first byte, in its text
    count: np.ndarray  # windows
    twice: np.ndarray  # the gram of the name occurs more than once in the segment


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from least values to the left and right of block borders."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def runs_of(texts: list[bytes], width: int, gram: int = GRAM) -> Runs:
    flat = np.frombuffer(b"".join(texts), np.uint8)
    n, gram = len(flat), min(gram, width)
    size = np.array([len(t) for t in texts], np.int64)
    if n < width:
        none = np.zeros(0, np.int64)
        return Runs(none.view(np.uint64), none, none, none, none.astype(bool))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[flat] * _powers(_BASE, n), out=sums[1:])
    back = _powers(_INVERSE, n + 1)
    grams = mix((sums[gram:] - sums[:-gram]) * back[:n - gram + 1])
    least = _sliding_least(grams, width - gram + 1)
    begin = np.cumsum(size) - size
    long = size >= width
    # windows that lie within one text
    inside = np.zeros(len(least) + 1, np.int8)
    inside[begin[long]] += 1
    inside[(begin + size - width + 1)[long]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    first = inside.copy()
    first[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    fresh = begin[long]
    first[fresh] = True
    at = np.flatnonzero(first)
    count = np.add.reduceat(inside, at, dtype=np.int64)
    row = np.searchsorted(begin, at, side="right") - 1
    return Runs(least[at], row, at - begin[row], count, _repeated(grams, least, at, count, width - gram))


def _repeated(grams: np.ndarray, least: np.ndarray, at: np.ndarray, count: np.ndarray, reach: int) -> np.ndarray:
    """Whether a run's name occurs more than once among the grams of its segment."""
    held = np.zeros(len(grams) + 1, np.int64)  # grams that are the least of the window that starts or ends with them
    mark = np.zeros(len(grams), bool)
    mark[:len(least)] |= grams[:len(least)] == least
    mark[reach:] |= grams[reach:] == least
    held[1:] = np.cumsum(mark)
    # a run with two marks may hold its name twice; look closer at those only
    maybe = np.flatnonzero(held[at + count + reach] - held[at] > 1)
    out = np.zeros(len(at), bool)
    for i in maybe.tolist():
        a = at[i]
        out[i] = np.count_nonzero(grams[a:a + count[i] + reach] == least[a]) > 1
    return out
