"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of 10 consecutive words of the benchmark items; an item with fewer words is one shorter
pattern, and patterns of one length are searched together. For each length a shift table over blocks of two words says
how far a search position may jump because no pattern can end in between; where the shift is 0, the bucket of the
block selects patterns and comparing the words confirms them. All texts of a piece are searched together: each numpy
step moves every open position by its own shift.

The benchmark is broadcast in blocks of at most ``BLOCK_BYTES`` of text, whatever its size; with more than one block
the finds of a block are written to the shared folder, carried to the next, and the block's broadcast is freed. Null text
has no words, null items have no patterns, repeated items count once per item_id, items with a null id mark words but
are not counted or listed, and rows are searched one by one, so repeated rows and extra columns have no effect.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .arrow import arrow_type, map_arrow, pieces

WINDOW = 10
BLOCK_BYTES = 32 << 20
_STRIDE = 256
_BITS = 20
# ASCII letters are lower-cased, digits and bytes over 127 stay, all else parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def patterns_of(words: list[bytes], width: int = WINDOW) -> Iterator[tuple[bytes, ...]]:
    if words:
        for i in range(max(1, len(words) - width + 1)):
            yield tuple(words[i:i + width])


class Matcher:
    """Shift table and suffix buckets of the patterns of one length."""

    def __init__(self, patterns: list[tuple[bytes, ...]]):
        self.length = len(patterns[0])
        self.block = min(2, self.length)
        codes = np.array([[hash(w) for w in p] for p in patterns], np.int64).view(np.uint64)
        self.shift = np.full(1 << _BITS, self.length - self.block + 1, np.int64)
        for end in range(self.block - 1, self.length):
            np.minimum.at(self.shift, self._slot(self._key(codes, end)), self.length - 1 - end)
        self.buckets: dict[int, set[tuple[bytes, ...]]] = defaultdict(set)
        for pattern, key in zip(patterns, self._key(codes, self.length - 1).tolist()):
            self.buckets[key].add(pattern)
        self.suffixes = np.array(sorted(self.buckets), np.uint64)

    def _key(self, codes: np.ndarray, end) -> np.ndarray:
        """Hash of the block that ends at ``end``."""
        key = codes[..., end] * np.uint64(0x9E3779B97F4A7C15)
        return key if self.block == 1 else key ^ (codes[..., end - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key ^ key >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _BITS)).astype(np.int64)

    def search(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Positions whose block is the suffix of a pattern; no window crosses from one text to the next."""
        fits = size >= self.length
        first, last = begin[fits] + self.length - 1, begin[fits] + size[fits] - 1
        n = (last - first) // _STRIDE + 1
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(first, n) + nth * _STRIDE
        stop = np.minimum(at + _STRIDE, np.repeat(last, n) + 1)
        found = []
        while len(at):
            key = self._key(codes, at)
            jump = self.shift[self._slot(key)]
            zero = jump == 0
            if zero.any():
                place = np.minimum(np.searchsorted(self.suffixes, key[zero]), len(self.suffixes) - 1)
                found.append(at[zero][self.suffixes[place] == key[zero]])
            at = at + np.maximum(jump, 1)
            open_ = at < stop
            at, stop = at[open_], stop[open_]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def confirm(self, words: list[bytes], codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        for end, key in zip(ends.tolist(), self._key(codes, ends).tolist()):
            seen = tuple(words[end - self.length + 1:end + 1])
            if seen in self.buckets[key]:
                yield end, seen


class Search:
    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], width: int = WINDOW):
        self.owners: dict[tuple[bytes, ...], set[str | None]] = defaultdict(set)
        for item, words in items:
            for pattern in patterns_of(words, width):
                self.owners[pattern].add(item)
        lengths = defaultdict(list)
        for pattern in self.owners:
            lengths[len(pattern)].append(pattern)
        self.matchers = [Matcher(lengths[n]) for n in sorted(lengths)]

    def __call__(self, lists: list[list[bytes]]) -> tuple[list[set[tuple[int, int]]], list[set[str]]]:
        """Of each word list the ranges hit and the items found."""
        ranges: list[set[tuple[int, int]]] = [set() for _ in lists]
        items: list[set[str]] = [set() for _ in lists]
        words = [w for ws in lists for w in ws]
        codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        size = np.array([len(ws) for ws in lists], np.int64)
        begin = np.cumsum(size) - size
        for m in self.matchers:
            ends = m.search(codes, begin, size)
            for end, pattern in m.confirm(words, codes, ends):
                row = int(np.searchsorted(begin, end, side="right")) - 1
                ranges[row].add((end - m.length + 1 - int(begin[row]), end + 1 - int(begin[row])))
                items[row] |= self.owners[pattern] - {None}
        return ranges, items


def covered(ranges: Iterable[tuple[int, int]]) -> int:
    total = reach = 0
    for a, b in sorted(ranges):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _blocks(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[str | None, str]]]:
    """Items in blocks of at most ``limit`` bytes (one item at least); the driver holds one block at a time."""
    block, size = [], 0
    rows = items.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string"), F.col(text).cast("string"))
    for name, value in rows.toLocalIterator():
        n_bytes = len(value.encode())
        if block and size + n_bytes > limit:
            yield block
            block, size = [], 0
        block.append((name, value))
        size += n_bytes
    yield block


def find(df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    state = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                      F.lit(None).cast("binary").alias("ranges"), F.lit(None).cast("array<string>").alias("items"))
    spark, before = df.sparkSession, None
    for block in _blocks(items, item_id, item_text, block_bytes):
        if before is not None:
            state = stage(_searched(state, before, width, carry=True), "decontaminate")
            before.unpersist()
        before = spark.sparkContext.broadcast(block)
    return _searched(state, before, width, carry=False)


def _searched(state: DataFrame, block, width: int, carry: bool) -> DataFrame:
    schema = ("doc_id long, text string, ranges binary, items array<string>" if carry else
              "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, out = Search(((name, words_of(value)) for name, value in block.value), width), arrow_type(schema)
        for piece in pieces(batches):
            ids, texts, ranges, items = (piece.column(i).to_pylist() for i in range(4))
            lists = [words_of(t) for t in texts]
            hit, found = search(lists)
            for i, (r, names) in enumerate(zip(ranges, items)):
                if r:
                    hit[i] |= set(map(tuple, np.frombuffer(r, "<i8").reshape(-1, 2).tolist()))
                    found[i] |= set(names)
            if carry:
                made = [ids, texts, [np.array(sorted(r), "<i8").tobytes() for r in hit],
                        [sorted(names) for names in found]]
            else:
                n_hit = [covered(r) for r in hit]
                made = [ids, [len(ws) for ws in lists], n_hit, [len(names) for names in found],
                        [hashlib.sha256(",".join(sorted(names)).encode()).hexdigest() for names in found],
                        [n > 0 for n in n_hit]]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(made, out)], schema=out)

    return map_arrow(state, run, schema)


def drop_contaminated(df: DataFrame, items: DataFrame, text: str = "text", width: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows, with all their columns, in which no pattern occurs; what a block leaves is written before the next one."""
    names, schema, spark, before = df.columns, df.schema, df.sparkSession, None
    for block in _blocks(items, "item_id", "text", block_bytes):
        if before is not None:
            df = stage(df, "decontaminate")
            before.unpersist()
        shared = before = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            search, at = Search(((name, words_of(value)) for name, value in shared.value), width), names.index(text)
            for piece in pieces(batches):
                hit, _ = search([words_of(t) for t in piece.column(at).to_pylist()])
                yield piece.filter(pa.array([not r for r in hit], pa.bool_()))

        df = map_arrow(df, run, schema)
    return df
