"""Quality rules as a short-circuit cascade.

Every document gets the base counts. Documents that pass the base rules go through further rules, each of which sees
only what the rules before it let through. Their order is chosen on a sample: the rule with the most rejections per
second goes first, then the best of the rest on the sample rows that are left. The order changes the work, never the
verdict, so results do not depend on timings.

Null or empty text counts as no words: all counts 0, base_failed true, kept false. Rows are judged one by one, so
repeated rows, null ids and an empty table need no special care; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Piece, map_pieces

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000

_BREAKS = " \t\n\x0b\x0c\r"


@dataclass
class Doc:
    """One text and what the base counts found."""

    text: str
    words: list[bytes]
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Doc], bool]


def _symbols(d: Doc) -> bool:
    return d.n_symbols > 0.1 * len(d.words)


def _word_length(d: Doc) -> bool:
    return not 2.5 * len(d.words) <= d.word_chars <= 12 * len(d.words)


def _dup_lines(d: Doc) -> bool:
    return d.n_dup_lines > 0.4 * d.n_lines


def _shouting(d: Doc) -> bool:
    upper = sum(map(str.isupper, d.text))
    return upper > 0.6 * (upper + sum(map(str.islower, d.text)))


def _exclaiming(d: Doc) -> bool:
    return d.text.count("!") > 0.5 * len(d.words)


def _vocabulary(d: Doc) -> bool:
    return len(set(d.words)) < 0.15 * min(len(d.words), 2000)


def _alphabetic(d: Doc) -> bool:
    lettered = sum(not w.isdigit() and any(c >= 128 or chr(c).isalpha() for c in w) for w in d.words)
    return lettered < 0.6 * len(d.words)


RULES = (Rule("symbols", _symbols), Rule("word_length", _word_length), Rule("dup_lines", _dup_lines),
         Rule("shouting", _shouting), Rule("exclaiming", _exclaiming), Rule("vocabulary", _vocabulary),
         Rule("alphabetic", _alphabetic))


def repeated_words(lists: Sequence[list[bytes]], width: int = WINDOW) -> np.ndarray:
    """Per word list, how many of its words lie in windows of ``width`` words that it holds twice or more."""
    counts = np.array([len(w) for w in lists], dtype=np.int64)
    total = int(counts.sum())
    out = np.zeros(len(lists), dtype=np.int64)
    if total < width:
        return out
    codes = np.fromiter((hash(w) for words in lists for w in words), dtype=np.int64, count=total).view(np.uint64)
    owner = np.repeat(np.arange(len(lists)), counts)
    n = total - width + 1
    rolled = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[j:j + n]
    inside = owner[:n] == owner[width - 1:]
    at = np.flatnonzero(inside)
    keys = rolled[at] ^ (owner[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + width, -1)
    np.add.at(out, owner[np.cumsum(edge[:-1]) > 0], 1)
    return out


def describe(text: str | None) -> Doc:
    text = text or ""
    words = text.encode().split()  # bytes.split() breaks at exactly \x20 and \x09-\x0D
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(_BREAKS):
            lines += 1
            dup += line in seen
            seen.add(line)
    return Doc(text, words, len(text) - sum(map(text.count, _BREAKS)), sum(map(text.count, SYMBOLS)), lines, dup)


def _base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def measure(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules in the order of the cascade, from their run times and rejections on about ``rows`` sampled rows.

    The sample only sets the order. What reaches the driver is one row per set of failed rules.
    """
    names = [r.name for r in rules]

    def start():
        def work(piece: Piece) -> Piece:
            out: dict[str, list] = {"failed": [], **{n: [] for n in names}}
            for value in piece["text"]:
                doc, failed = describe(value), 0
                if _base_failed(len(doc.words), int(repeated_words([doc.words])[0])):
                    continue
                for i, rule in enumerate(rules):
                    began = time.perf_counter_ns()
                    failed |= rule.fails(doc) << i
                    out[rule.name].append(time.perf_counter_ns() - began)
                out["failed"].append(failed)
            return out
        return work

    total = df.count()
    sample = df.select(F.col(text).alias("text")).sample(min(1.0, rows / max(1, total)), seed=7)
    schema = "failed long, " + ", ".join(f"{n} long" for n in names)
    seen = (map_pieces(sample, schema, start).groupBy("failed")
            .agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names]).collect())
    cost = [sum(r[n] for r in seen) or 1 for n in names]
    left, order = {r["failed"]: r["n"] for r in seen}, []
    while len(order) < len(rules):
        rejected = {i: sum(n for f, n in left.items() if f >> i & 1) for i in range(len(rules)) if i not in order}
        best = max(rejected, key=lambda i: (rejected[i] / cost[i], -cost[i], -i))
        order.append(best)
        left = {f: n for f, n in left.items() if not f >> best & 1}
    return [rules[i] for i in order]


def judge(df: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """Base counts, base verdict and final verdict of every row."""
    order = tuple(measure(df, text) if rules is None else rules)
    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean")

    def start():
        def work(piece: Piece) -> Piece:
            docs = [describe(t) for t in piece["text"]]
            n_repeat = repeated_words([d.words for d in docs]).tolist()
            failed = [_base_failed(len(d.words), n) for d, n in zip(docs, n_repeat)]
            left = [i for i, f in enumerate(failed) if not f]
            for rule in order:
                left = [i for i in left if not rule.fails(docs[i])]
            kept = set(left)
            return {"doc_id": piece["doc_id"], "n_words": [len(d.words) for d in docs],
                    "word_chars": [d.word_chars for d in docs], "n_symbols": [d.n_symbols for d in docs],
                    "n_dup_lines": [d.n_dup_lines for d in docs], "n_repeat_words": n_repeat,
                    "base_failed": failed, "kept": [i in kept for i in range(len(docs))]}
        return work

    return map_pieces(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                      schema, start)
