"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must contain. Texts are
indexed shard by shard (a shard is one Arrow piece of a task): postings list the texts that hold each trigram which a
query mentions, queries intersect and unite postings, and only the candidates are matched by the rule itself. A rule
without mandatory trigrams (a run of hex digits) scans every text. Trigrams are taken from ASCII-lower-cased bytes, so
case-blind rules share them; the index only narrows, the rule decides.

Null text counts as empty. Rows are scanned one by one: repeated rows, null ids and extra columns have no effect.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from re import _constants as node
from re import _parser as parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Piece, map_pieces

Query = tuple | str | None
"""A trigram, ("and" | "or", *queries), or None where anything may match."""
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``ok`` judges a match; a failing one is dropped and the search goes on behind it."""

    kind: str
    pattern: str
    flags: int = re.A
    ok: Callable[[re.Match], bool] | None = None


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.A | re.I, lambda m: m.end(2) - m.start(2) >= 6),
    Rule("access", r"AKIA[A-Z0-9]+", ok=lambda m: m.end() - m.start() >= 20),
    # The same matches as runs of any length that are then held against the least length.
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("login", r"[a-z]{2,10}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
)


def both(queries: Iterable[Query]) -> Query:
    kept = [q for q in dict.fromkeys(queries) if q is not None]
    return None if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def either(queries: Iterable[Query]) -> Query:
    kept = list(dict.fromkeys(queries))
    return None if None in kept or not kept else kept[0] if len(kept) == 1 else ("or", *kept)


def _of_strings(strings: set[str]) -> Query:
    return either(both(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _strings(items: Iterable) -> set[str] | None:
    """All lower-cased texts that a sequence can match, if they are few."""
    out = {""}
    for op, arg in items:
        some: set[str] | None = None
        if op is node.LITERAL:
            some = {chr(arg).lower()} if arg < 128 else None
        elif op is node.IN and all(k is node.LITERAL and c < 128 for k, c in arg):
            some = {chr(c).lower() for _, c in arg}
        elif op is node.SUBPATTERN:
            some = _strings(arg[3])
        elif op is node.BRANCH:
            parts = [_strings(p) for p in arg[1]]
            some = None if None in parts else set().union(*parts)
        elif op is node.MAX_REPEAT and arg[1] <= 3:
            once = _strings(arg[2])
            some = None if once is None else _powers(once, arg[0], arg[1])
        if some is None or len(out) * len(some) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in some}
    return out


def _powers(once: set[str], least: int, most: int) -> set[str] | None:
    out, now = set(), {""}
    for n in range(most + 1):
        if n >= least:
            out |= now
        now = {a + b for a in now for b in once}
        if len(now) > MOST_STRINGS:
            return None
    return out


def _query(items: Iterable) -> Query:
    clauses: list[Query] = []
    run = {""}
    for item in items:
        op, arg = item
        some = _strings([item])
        if some is not None and len(run) * len(some) <= MOST_STRINGS:
            run = {a + b for a in run for b in some}
            continue
        clauses.append(_of_strings(run))
        run = some or {""}
        if some is None:
            if op is node.SUBPATTERN:
                clauses.append(_query(arg[3]))
            elif op is node.BRANCH:
                clauses.append(either(_query(p) for p in arg[1]))
            elif op is node.MAX_REPEAT and arg[0] >= 1:
                clauses.append(_query(arg[2]))
    clauses.append(_of_strings(run))
    return both(clauses)


def trigram_query(pattern: str) -> Query:
    """What the lower-cased text of every match holds; None if nothing is certain."""
    return _query(parser.parse(pattern, re.A))


def trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1:]))


class Index:
    """Postings of a shard for a given set of trigrams."""

    def __init__(self, wanted: Sequence[str]):
        self.wanted = wanted
        self.number = np.zeros(1 << 24, np.uint16)
        for i, t in enumerate(wanted, 1):
            a, b, c = t.encode()
            self.number[a << 16 | b << 8 | c] = i

    def build(self, texts: Sequence[str]) -> None:
        rows = [t.encode().lower() + b"\0\0" for t in texts]
        flat = np.frombuffer(b"".join(rows), np.uint8).astype(np.int32)
        self.all = np.arange(len(rows))
        found = self.number[flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]] if len(flat) > 2 else np.zeros(0, np.uint16)
        at = np.flatnonzero(found)
        owner = np.searchsorted(np.cumsum([len(r) for r in rows]), at, side="right")
        pairs = np.unique(found[at].astype(np.int64) * (len(rows) + 1) + owner)
        which, row = pairs // (len(rows) + 1), pairs % (len(rows) + 1)
        edge = np.searchsorted(which, np.arange(1, len(self.wanted) + 2))
        self.postings = {t: row[edge[i]:edge[i + 1]] for i, t in enumerate(self.wanted)}

    def candidates(self, query: Query) -> np.ndarray:
        if query is None:
            return self.all
        if isinstance(query, str):
            return self.postings[query]
        parts = sorted(map(self.candidates, query[1:]), key=len)
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out


class Scanner:
    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(i, r, re.compile(r.pattern, r.flags), trigram_query(r.pattern)) for i, r in enumerate(rules)]
        self.index = Index(sorted(set().union(*(trigrams(q) for *_, q in self.rules))))

    def __call__(self, texts: Sequence[str]) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of every text's spans, by start and then rule."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        self.index.build(texts)
        for i, rule, pattern, query in self.rules:
            for row in self.index.candidates(query).tolist():
                out[row] += [(m.start(), i, m.end()) for m in pattern.finditer(texts[row]) if not rule.ok or rule.ok(m)]
        for spans in out:
            spans.sort()
        return out


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", base: Sequence[Rule] = BASE,
         added: Sequence[Rule] = ADDED) -> DataFrame:
    """doc_id, n_<kind> of every base rule, base_sha256 over the base spans, spans of all rules."""
    rules = (*base, *added)
    counts = ", ".join(f"n_{r.kind} long" for r in base)

    def joined(spans: Iterable[tuple[int, int, int]]) -> str:
        return ",".join(f"{rules[i].kind}:{a}:{b}" for a, i, b in spans)

    def start():
        scanner = Scanner(rules)

        def work(piece: Piece) -> Piece:
            found = scanner([t or "" for t in piece["text"]])
            own = [[s for s in spans if s[1] < len(base)] for spans in found]
            return ({"doc_id": piece["doc_id"], "spans": [joined(s) for s in found],
                     "base_sha256": [hashlib.sha256(joined(s).encode()).hexdigest() for s in own]}
                    | {f"n_{r.kind}": [sum(s[1] == i for s in spans) for spans in own] for i, r in enumerate(base)})
        return work

    return map_pieces(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                      f"doc_id long, {counts}, base_sha256 string, spans string", start)
