"""Byte-level BPE as a deterministic automaton over token labels.

The automaton starts with one state that every byte label loops on. Merges are compiled in rank order; merge (u, v)
into w changes every state p that reads u and then v: p may no longer read v after that u, and p gets an arc labelled
w that leads where the path u, v led. An arc's target depends on its label alone, so there is one state per label:
reading u leads to state u. A merge is therefore two records, and states share them instead of being copied out:

* arc v is cut from state u from this rank on;
* state w is a copy of state v as it is at this rank, and arc w exists in every state that reads u at this rank.

``arc(p, w)`` follows the records. The automaton accepts exactly one label sequence for any byte string, the one that
applying the merges in rank order gives. For bytes it is determinised as texts need it: a row of the byte table is the
set of labels being read, each with the state it left, and at every byte exactly one of them can end. A word is encoded
by walking the table once and reading the labels off backwards. Decoding emits the
labels. Words come from the usual split of a byte-level vocabulary; a special token's text is a label of its own.

Null text encodes to no ids. Rows are handled one by one: repeated rows, null ids and extra columns have no effect.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from .arrow import Piece, map_pieces

# Fixed value: the split pattern of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same split for text of ASCII letters alone, where character classes are short lists.
ASCII_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
# Sizes of what a task keeps at hand; all start anew when full, results do not depend on them.
CACHED_WORDS = 200_000
TABLE_ROWS = 120_000
CACHED_ARCS = 150_000
STEP_WORDS = 4096


def byte_letters() -> dict[str, int]:
    """Letters that the vocabulary file writes for bytes: printable ones stand for themselves, others are shifted."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, bytes]], dict[str, int]]:
    """(label, id) pairs, merges in rank order, special tokens of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    letters = byte_letters()

    def raw(label: str) -> bytes:
        return bytes(letters[c] for c in label)

    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    vocab = [(raw(k), v) for k, v in file["model"]["vocab"].items() if k not in special]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
    return vocab, [(raw(u), raw(v)) for u, v in pairs], special


START = -1


class Automaton:
    def __init__(self, vocab: list[tuple[bytes, int]], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        self.ids = dict(vocab)
        self.labels = {i: b for b, i in vocab} | {i: s.encode() for s, i in special.items()}
        self.special = special
        self.born: dict[int, int] = {}  # label -> rank of its gadget; bytes have none
        self.halves: dict[int, tuple[int, int]] = {}
        self.cut: dict[int, int] = {}  # state << 32 | arc cut from it -> rank
        self.dead: set[int] = set()
        self.arcs: dict[int, bool] = {}
        for rank, (u, v) in enumerate(merges):
            self._gadget(rank, self.ids[u], self.ids[v], self.ids[u + v])
        below: dict[int, int] = {}  # trie over labels: node << 8 | byte -> node
        named = [-2]
        for label, number in self.ids.items():
            node = 0
            for byte in label:
                node = below.setdefault(node << 8 | byte, len(named))
                if node == len(named):
                    named.append(-2)
            named[node] = number
        self.edges, self.below = (np.fromiter(x, np.int64, len(below)) for x in (below, below.values()))
        order = np.argsort(self.edges)
        self.edges, self.below, self.named = self.edges[order], self.below[order], np.array(named)
        self.inner = np.zeros(len(named), bool)  # whether anything is below a node
        self.inner[self.edges >> 8] = True
        self.width = 2 + max(self.labels)  # a label being read is one number: node * width + 1 + the state it left
        self.size_of = np.zeros(1 + max(self.labels), np.int64)
        for number, label in self.labels.items():
            self.size_of[number] = len(label)
        self.bytes_seen, self.class_of = np.zeros(0, np.uint8), np.zeros(256, np.int64)
        self._forget()
        self.split, self.ascii_split = regex.compile(SPLIT), re.compile(ASCII_SPLIT)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.splitter = ByteLevel(add_prefix_space=False)
        self.known: dict[str, bytes] = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if not self._reads(u, v, rank):
            self.dead.add(w)
        self.cut[u << 32 | v] = rank
        self.born[w], self.halves[w] = rank, (u, v)

    def _reads(self, p: int, w: int, rank: int) -> bool:
        """Whether state ``p`` had arc ``w`` just before the gadget of ``rank``."""
        while w not in self.dead:
            made = self.born.get(w, -1)
            if made >= rank or self.cut.get(p << 32 | w, rank) < rank:
                return False
            copied = self.born.get(p, -1)
            if copied > made:  # the copy took the arc along, if its origin had it
                rank, p = copied, self.halves[p][1]
            elif made < 0:
                return True
            else:  # the arc came to the states that read its first half
                rank, (u, v) = made, self.halves[w]
                if copied == made:
                    p = v
                elif p == u == v:
                    return False
                w = u
        return False

    def _split(self, part: str) -> list[str]:
        """Words to encode. Character classes of newer scripts differ between libraries, so those texts go by the
        vocabulary's own library."""
        if part.isascii():
            return self.ascii_split.findall(part)
        if max(part) < "\u0500":
            return self.split.findall(part)
        return [part[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(part)]

    def arc(self, p: int, w: int) -> bool:
        found = self.arcs.get(p << 32 | w)
        if found is None:
            if len(self.arcs) > CACHED_ARCS:
                self.arcs.clear()
            found = self.arcs[p << 32 | w] = self._reads(p, w, 1 << 60)
        return found

    def _forget(self) -> None:
        """Start the byte table anew; row 0 is the start of a word."""
        start = np.array([START + 1])
        self.rows: dict[bytes, int] = {start.tobytes(): 0}  # labels being read -> row
        self.open, self.begin = np.resize(start, 1 << 14), np.zeros(1 << 12, np.int64)  # those of a row, from its begin on
        self.many, self.used = np.ones(1 << 12, np.int64), 1
        self.reached = np.full(1 << 12, START, dtype=np.int32)  # row -> state after its last byte
        self.table = np.full((1 << 12, len(self.bytes_seen) or 1), -1, dtype=np.int32)  # row, class of byte -> row

    def _step(self, cells: np.ndarray) -> None:
        """Fill in transitions of the byte table; a cell is ``row << 8 | byte``."""
        row, byte = cells >> 8, cells & 255
        n = self.many[row]
        of = np.repeat(np.arange(len(cells)), n)
        node, origin = np.divmod(self.open[np.arange(len(of)) + np.repeat(self.begin[row] - np.cumsum(n) + n, n)], self.width)
        wanted = node << 8 | byte[of]
        place = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
        on = self.edges[place] == wanted
        of, origin, node = of[on], origin[on], self.below[place[on]]
        state, label = [START] * len(cells), self.named[node]
        ends = label >= 0
        for i, p, w in zip(of[ends].tolist(), (origin[ends] - 1).tolist(), label[ends].tolist()):
            if state[i] == START and self.arc(p, w):
                state[i] = w
        if START in state:
            raise ValueError("the vocabulary lacks a byte")
        ahead = self.inner[node]
        of = of[ahead]
        size = np.bincount(of, minlength=len(cells)) + 1
        stop = np.cumsum(size)
        reading = np.empty(stop[-1], np.int64)  # of a cell: the labels that go on, then those that start
        reading[stop - 1] = np.array(state) + 1
        reading[np.arange(len(of)) + of] = node[ahead] * self.width + origin[ahead]
        data, to, new, known = reading.tobytes(), [], [], len(self.rows)
        for i, (a, b) in enumerate(zip((8 * (stop - size)).tolist(), (8 * stop).tolist())):
            to.append(self.rows.setdefault(data[a:b], len(self.rows)))
            if len(self.rows) > known:
                new.append(i)
                known += 1
        if new:
            self._add_rows(known - len(new), size[new], np.array(state)[new],
                           np.concatenate([reading[a:b] for a, b in zip((stop - size)[new].tolist(), stop[new].tolist())]))
        self.table[row, self.class_of[byte]] = to

    def _add_rows(self, at: int, size: np.ndarray, state: np.ndarray, reading: np.ndarray) -> None:
        to = at + len(size)
        if to > len(self.table):
            more = to + to // 2 - len(self.table)
            grown = lambda x, value: np.concatenate([x, np.full((more, *x.shape[1:]), value, x.dtype)])
            self.begin, self.many, self.reached = grown(self.begin, 0), grown(self.many, 0), grown(self.reached, START)
            self.table = grown(self.table, -1)
        if self.used + len(reading) > len(self.open):
            self.open = np.resize(self.open, 2 * (self.used + len(reading)))
        self.open[self.used:self.used + len(reading)] = reading
        self.many[at:to], self.begin[at:to] = size, self.used + np.cumsum(size) - size
        self.reached[at:to] = state
        self.used += len(reading)

    def _classes(self, flat: np.ndarray) -> None:
        new = np.setdiff1d(np.unique(flat), self.bytes_seen)
        if len(new):
            self.class_of[new] = len(self.bytes_seen) + np.arange(len(new))
            first, self.bytes_seen = not len(self.bytes_seen), np.concatenate([self.bytes_seen, new])
            grown = np.full((len(self.table), len(self.bytes_seen)), -1, np.int32)
            grown[:, :self.table.shape[1] - first] = self.table[:, first:]
            self.table = grown

    def run(self, words: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of the one accepted path that reads each word.

        All words advance together, one byte at a time; the paths are then read off backwards. Words are sorted by
        length, longest first, so those that still have bytes left are always a prefix.
        """
        if len(self.rows) > TABLE_ROWS:
            self._forget()
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        flat = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
        self._classes(flat)
        size = np.array([len(words[i]) for i in order])
        begin = np.cumsum(size) - size
        row, states = np.zeros(len(words), np.int32), np.empty(len(flat), np.int32)
        for k in range(int(size[0])):
            n = int(np.searchsorted(-size, -k))
            at = begin[:n] + k
            byte, here = flat[at], row[:n]
            to = self.table[here, self.class_of[byte]]
            gap = to < 0
            if gap.any():
                self._step(np.unique(here[gap].astype(np.int64) << 8 | byte[gap]))
                to = self.table[here, self.class_of[byte]]
            row[:n] = to
            states[at] = self.reached[to]
        taken = np.zeros(len(flat), dtype=bool)
        end, on = size - 1, np.arange(len(words))
        while len(on):
            at = begin[on] + end
            taken[at] = True
            end = end - self.size_of[states[at]]
            on, end = on[end >= 0], end[end >= 0]
        ids = states[taken].astype("<u4").tobytes()
        stop = np.cumsum(np.add.reduceat(taken, begin, dtype=np.int64)) * 4
        out: list[bytes] = [b""] * len(words)
        for i, a, b in zip(order, [0, *stop[:-1].tolist()], stop.tolist()):
            out[i] = ids[a:b]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        lists = [[w for part in (self.marks.split(text) if self.marks else [text]) for w in
                  ([part] if part in self.special else self._split(part))] for text in texts]
        if len(self.known) > CACHED_WORDS:
            self.known = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        new = list(set().union(*lists).difference(self.known))
        for at in range(0, len(new), STEP_WORDS):
            words = new[at:at + STEP_WORDS]
            self.known.update(zip(words, self.run([w.encode() for w in words])))
        return [b"".join(map(self.known.__getitem__, words)) for words in lists]

    def decode(self, ids: bytes) -> str:
        labels = map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(labels).decode("utf-8", "replace")


def automaton_on_workers(spark: SparkSession, path: str) -> Callable[[], Automaton]:
    """The vocabulary (bounded by its file) is broadcast; a task compiles it once."""
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(path))
    return lambda: Automaton(*vocabulary.value)


def encode(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every row."""
    compiled = automaton_on_workers(df.sparkSession, path)

    def start():
        machine = compiled()

        def work(piece: Piece) -> Piece:
            return {"doc_id": piece["doc_id"], "ids": machine.encode([t or "" for t in piece["text"]])}
        return work

    return map_pieces(_texts(df, doc_id, text), "doc_id long, ids binary", start)


def decode(df: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids decode to empty text, an id outside the vocabulary fails."""
    compiled = automaton_on_workers(df.sparkSession, path)

    def start():
        machine = compiled()

        def work(piece: Piece) -> Piece:
            return {"doc_id": piece["doc_id"],
                    "text": [machine.decode(b or b"") for b in piece["ids"]]}
        return work

    return map_pieces(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")),
                      "doc_id long, text string", start)


def digests(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every row in one pass and returns the digests of both results."""
    compiled = automaton_on_workers(df.sparkSession, path)

    def start():
        machine = compiled()

        def work(piece: Piece) -> Piece:
            ids = machine.encode([t or "" for t in piece["text"]])
            return {"doc_id": piece["doc_id"], "n_tokens": [len(i) // 4 for i in ids],
                    "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                    "decoded_sha256": [hashlib.sha256(machine.decode(i).encode()).hexdigest() for i in ids]}
        return work

    return map_pieces(_texts(df, doc_id, text), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                      start)


def _texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
