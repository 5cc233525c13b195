"""Windows that repeat, from a Burrows-Wheeler transform.

``repeated_windows`` sorts the suffixes of a text to the depth of the windows, takes the transform, and derives common
prefix lengths by increasing value: an interval of suffixes that share a prefix is extended backward by every byte that
precedes one of them; the extended interval's right end separates suffixes whose common prefix is as long as the prefix
extended, unless a shorter one separated them before. Only intervals that separate something new are extended again, so
every place is visited once. The expansion stops at the window length: suffixes not separated by then share a window.
"""

from __future__ import annotations

import numpy as np

FIRST = 8


def sorted_suffixes(flat: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes or more, and where their first 8 bytes change."""
    n = len(flat)
    padded = np.concatenate([flat, np.zeros(FIRST, np.uint8)])
    head = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, FIRST)[:n]).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(head, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = head[order][1:] != head[order][:-1]
    edges, rank, known = fresh.copy(), np.empty(n + 1, np.int64), FIRST
    rank[n] = -1
    place = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = place
    while known < depth:
        # only suffixes that still share their rank move, within the places of that rank
        tied = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
        if not len(tied):
            break
        who = order[tied]
        key = rank[who] * (n + 1) + rank[np.minimum(who + known, n)] + 1
        by = np.argsort(key, kind="stable")
        order[tied] = who[by]
        key = key[by]
        fresh[tied[1:]] |= key[1:] != key[:-1]
        place = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[order] = place
        known *= 2
    return order, edges


def separated(flat: np.ndarray, order: np.ndarray, edges: np.ndarray, depth: int) -> np.ndarray:
    """For each place, whether its suffix shares less than ``depth`` bytes with the one before it."""
    n = len(order)
    last = flat[order - 1]
    by = np.argsort(last, kind="stable")
    step = np.empty(n, np.int64)  # place of the suffix that is one byte longer
    step[by] = np.arange(n)
    previous, following = np.full(n, -1, np.int64), np.full(n, n, np.int64)  # neighbours preceded by the same byte
    same = last[by][1:] == last[by][:-1]
    previous[by[1:][same]] = by[:-1][same]
    following[by[:-1][same]] = by[1:][same]
    cut = np.append(edges, True)
    left = np.flatnonzero(edges)
    right = np.append(left[1:], n)
    for _ in range(FIRST, depth):
        size = right - left
        which = np.repeat(np.arange(len(left)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + left[which]
        head, tail = previous[at] < left[which], following[at] >= right[which]
        a, b = which[head] * n + step[at[head]], which[tail] * n + step[at[tail]]
        a.sort()
        b.sort()
        left, right = a % n, b % n + 1
        new = ~cut[right]
        left, right = left[new], right[new]
        if not len(left):
            break
        cut[right] = True
    return cut[:-1]


def repeated_windows(segments: list[bytes], width: int) -> list[np.ndarray]:
    """Per segment, the starts of windows that an earlier segment, or the same one further left, has as well."""
    flat = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)  # UTF-8 has no byte 255
    size = np.array([len(s) for s in segments], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    order, edges = sorted_suffixes(flat, width)
    if len(flat) <= width:
        return [np.zeros(0, np.int64) for _ in segments]
    cut = separated(flat, order, edges, width)
    whole = np.zeros(len(flat) + 1, np.int64)
    long = size >= width
    whole[begin[long]] += 1
    whole[(begin + size - width + 1)[long]] -= 1
    whole = np.cumsum(whole[:-1]) > 0
    family = np.cumsum(cut)[whole[order]]
    places = order[whole[order]]
    if not len(places):
        return [np.zeros(0, np.int64) for _ in segments]
    edge = np.flatnonzero(np.diff(family, prepend=-1))
    least = np.minimum.reduceat(places, edge)
    later = np.sort(places[places != np.repeat(least, np.diff(np.append(edge, len(places))))])
    split = np.searchsorted(later, begin[1:])
    return [x - b for x, b in zip(np.split(later, split), begin.tolist())]
