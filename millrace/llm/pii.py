"""Personal data: candidate spans judged by gradient boosted trees.

Base spans are what the four plain rules find; they always stay. High-recall generators propose further, overlapping
spans: every local part before a written-out or spaced at sign, and every run of neighbouring groups of digits whose
count fits the kind, so that a number is proposed with and without the numbers beside it. Boosted trees score each
candidate from its format and its context, scores are calibrated on a held-out part, and per kind the lowest threshold
that reaches ``PRECISION`` there selects redactions; they may not touch a base span or a better candidate.

There are no labels for personal data among the tables, so training labels come from the base rules on a bounded sample
(``TRAIN_DOCS`` texts by a hash of their id, ``TRAIN_ROWS`` candidates by another): candidates that a base span fills
are positive, all others negative, and every positive is also shown in the other ways of writing it and beside another
number, every card also with a wrong check digit as a negative and every address with words around it written as
"word at word.word" as negatives; spans that cover a shown positive in part, or more than
it, are negative. The features do not tell whether a base rule matched.

Null text counts as empty; rows are judged one by one, so repeated rows, null ids and extra columns have no effect.
With an empty table, or a sample without both classes, no span is added.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .arrow import Piece, hash_share, map_arrow, map_pieces, pieces

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 4000
TRAIN_ROWS = 20_000
PRECISION = 0.98

Span = tuple[int, int, int]
"""start, kind number, end"""

_MARKS = re.compile(r"[0-9@+]")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits, so looking only at starts of runs finds the same matches.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_AT_WORDS, _DOT_WORDS = r"(?:\x20?@\x20?|\x20?[(\[]at[)\]]\x20?|\x20at\x20)", r"(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)"
_WRITTEN_AT = re.compile(rf"(?=({_AT_WORDS}[A-Za-z0-9-]{{1,64}}(?:{_DOT_WORDS}[A-Za-z0-9-]{{1,64}}){{1,4}}))")
_BRACKETED = re.compile(r"[(\[]at[)\]]")
_GROUP = re.compile(r"[0-9]+")
# Per kind of number: what may stand between two groups, and the least and most digits, groups and characters of a run.
NUMBERS = (
    (1, re.compile(r"\x20?[.,:]\x20?"), (4, 12), (4, 4), (7, 21)),
    (2, re.compile(r"[\x20./_-]{1,2}"), (11, 20), (1, 20), (11, 58)),
    (3, re.compile(r"[\x20()./-]{1,24}"), (7, 16), (1, 16), (8, 26)),
)
MOST_DIGITS = 20
LONGEST_GAP = 24
SCORED = 4096  # candidates whose features are held at once
NEIGHBOURS = (("2024-01-15 ", ""), ("", " 2024-01-15"), ("12 ", " 7"), ("12, ", ", 7"))
# Another number beside a span.
_CUT_BEFORE, _CUT_AFTER = re.compile(r"[0-9]++([\x20/_().,:-]{1,3})$"), re.compile(r"([\x20/_().,:-]{1,3})[0-9]+")
# Frequent ends of host names; words that speak for or against a kind nearby.
ENDINGS = frozenset("com org net edu gov".split())
CONTEXT = (re.compile(r"mail|contact|write|adress|correo|courriel", re.I), re.compile(r"\bip\b|host|server|addr|login", re.I),
           re.compile(r"card|visa|credit|carte|karte|tarjeta|iban", re.I),
           re.compile(r"phone|tel|call|fax|mobil|cell", re.I),
           re.compile(r"version|isbn|order|\bno\b|\bid\b|page|date|release|\bv\b", re.I))


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterable[tuple[int, int]]:
    done = at = 0
    while (m := _AT.search(text, at)) is not None:
        first = m.start()
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        if first < m.start():
            yield first, m.end()
            at = done = m.end()
        else:
            at = m.start() + 1


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test, by start and kind."""
    out: list[Span] = []
    if _MARKS.search(text) is None:
        return out
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 or len(p.lstrip("0")) <= 3 for p in m[0].split(".")) and \
                all(int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def _written_emails(text: str) -> Iterable[Span]:
    for m in _WRITTEN_AT.finditer(text):
        first = m.start()
        while first > 0 and m.start() - first < 64 and text[first - 1] in _LOCAL:
            first -= 1
        if first < m.start():
            yield first, 0, m.end(1)


def _numbers(text: str) -> Iterable[Span]:
    """Every run of neighbouring groups of digits that fits a kind."""
    groups = [m.span() for m in _GROUP.finditer(text)]
    joins = []  # per group, the kinds whose numbers may go on to the next group
    for (_, end), (start, _) in zip(groups, groups[1:]):
        gap = text[end:start] if start - end <= LONGEST_GAP else ""
        joins.append([k for k, (_, between, *_) in enumerate(NUMBERS) if between.fullmatch(gap)])
    for i, (first, _) in enumerate(groups):
        open_, digits = [0, 1, 2], 0
        for j in range(i, len(groups)):
            start, end = groups[j]
            if j > i:
                open_ = [k for k in open_ if k in joins[j - 1]]
            digits += end - start
            if not open_ or digits > MOST_DIGITS:
                break
            for k in open_:
                kind, _, count, parts, length = NUMBERS[k]
                if count[0] <= digits <= count[1] and parts[0] <= j - i + 1 <= parts[1] and \
                        length[0] <= end - first <= length[1]:
                    if kind == 1 and max(b - a for a, b in groups[i:j + 1]) > 3:
                        continue
                    at = first
                    if kind == 3:
                        at -= text[at - 1:at] == "+"
                        at -= text[at - 1:at] == "("
                    yield at, kind, end


def _proposed(text: str) -> Iterable[Span]:
    if "@" in text or "at" in text:
        yield from _written_emails(text)
    yield from _numbers(text)


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of all generators."""
    return list(_proposed(text))


def features(text: str, span: Span) -> list[float]:
    start, kind, end = span
    body, before, after = text[start:end], text[max(0, start - 32):start], text[end:end + 16]
    digits, groups = digits_of(body), re.findall("[0-9]+", body)
    sizes = list(map(len, groups)) or [0]
    edge_a, edge_b = before[-1:], after[:1]
    gaps, cut_a, cut_b = re.findall("[^0-9]+", body.lstrip("(+")), _CUT_BEFORE.search(before), _CUT_AFTER.match(after)
    near = before[-24:] + " " + after
    return [kind, len(body), len(digits), len(groups), max(sizes), min(sizes), sizes[-1], sum(map(str.isalpha, body)),
            body.count(" "), body.count("-"), body.count("."), body.count("("), body.startswith("+"),
            bool(digits) and luhn(digits), len(set(digits)), "@" in body, bool(_BRACKETED.search(body)), "dot" in body.lower(),
            len(re.split(r"[^A-Za-z]+", body)[-1]), body[-3:].lower() in ENDINGS, all(int(g[:4]) <= 255 for g in groups), digits[:1] == "0",
            sizes[0], body.startswith("("), body.count("(") == body.count(")"),
            sizes[0] - sizes[-1], max(sizes) - min(sizes), len(set(gaps)), len(set(gaps[1:])),
            cut_a is not None, cut_b is not None, cut_a is not None and cut_a[1] in gaps[:1],
            cut_b is not None and cut_b[1] in gaps[-1:], cut_a is not None and len(cut_a[0]) - len(cut_a[1]) == sizes[0],
            cut_b is not None and len(cut_b[0]) - len(cut_b[1]) == sizes[-1],
            edge_a.isalnum(), edge_b.isalnum(), edge_a in (".", "-", ","), edge_b == "-",
            bool(re.match(r"[.,:-]?[0-9]", after)), bool(re.search(r"[0-9][.,:-]?$", before)),
            *[bool(p.search(near)) for p in CONTEXT]]


def _rewritten(kind: int, body: str) -> list[tuple[str, float]]:
    """Other ways to write a span, with their labels."""
    if kind == 0:
        local, _, host = body.rpartition("@")
        forms = [(at, dot) for at in (" (at) ", "(at)", " [at] ", " @ ", " at ") for dot in (".", " (dot) ", " [dot] ", " dot ")
                 if dot == "." or at.strip()[0] == dot.strip()[0] or at == " at " and dot == " dot "]
        short = local.rpartition(".")[2] or local, ".".join(host.split(".")[-2:])
        return [(x + at + y.replace(".", dot), 1) for at, dot in forms for x, y in dict.fromkeys([(local, host), short])]
    if kind == 1:
        return [(body.replace(".", " . "), 1), (body.replace(".", ","), 0), (body.replace(".", ":"), 0)]
    digits = digits_of(body)
    if kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + 3) % 10)
        quads = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [("/".join(quads), 1), (".".join(quads), 1), (wrong, 0), (".".join(wrong[i:i + 4] for i in range(0, len(wrong), 4)), 0)]
    return [(f"({digits[1:4]}) {digits[4:7]}-{digits[7:]}", 1), (f"00{digits[:2]} {digits[2:5]} {digits[5:]}", 1),
            (digits, 0), (f"{digits[:4]}/{digits[4:8]}/{digits[8:]}", 0)]


def _prose(kind: int, before: str) -> list[tuple[str, float]]:
    """Words with an at between them and no blank behind the full stop, which are no address."""
    words = re.findall("[A-Za-z]{2,12}", before) if kind == 0 else []
    return [(f"{a} at {b}.{c}", 0) for a, b, c in zip(words[0::3], words[1::3], words[2::3])][-6:]


def training_rows(text: str) -> list[tuple[list[float], float]]:
    out, base = [], base_spans(text)
    for c in _clear_of(base, _proposed(text)):
        out.append((features(text, c), 0.0))
    for a, kind, b in base:
        for body, label in [(text[a:b], 1), *_rewritten(kind, text[a:b]), *_prose(kind, text[max(0, a - 200):a])]:
            for left, right in (("", ""), *NEIGHBOURS):
                before, after = text[max(0, a - 32):a] + left, right + text[b:b + 16]
                around, shown = before + body + after, (len(before), kind, len(before) + len(body))
                every = candidates(around)
                if shown not in every:
                    continue
                out.append((features(around, shown), float(label)))
                for c in _clear_of(base_spans(around), every):  # what would be judged there
                    if c != shown and c[0] < shown[2] and shown[0] < c[2]:
                        out.append((features(around, c), 0.0))
    return out


def _clear_of(taken: list[Span], spans: Iterable[Span]) -> Iterable[Span]:
    """Spans that touch none of the taken ones, which are in order of their starts."""
    starts, reach = [a for a, _, _ in taken], list(accumulate((b for _, _, b in taken), max))
    for c in spans:
        before = bisect_left(starts, c[2])
        if not before or reach[before - 1] <= c[0]:
            yield c


@dataclass
class Detector:
    model: boosting.Model
    thresholds: list[float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates over their threshold that touch no base span, the most likely first, of equal ones the longest."""
        likely: list[tuple[float, int, Span]] = []
        open_ = (c for c in _clear_of(base, _proposed(text)) if self.thresholds[c[1]] <= 1)
        while some := list(islice(open_, SCORED)):
            p = self.model.probabilities(np.array([features(text, c) for c in some], np.float64))
            likely += [(-q, c[0] - c[2], c) for q, c in zip(p.tolist(), some) if q >= self.thresholds[c[1]]]
        taken: list[Span] = []
        for _, _, c in sorted(likely):
            at = bisect_left(taken, c)
            if (not at or taken[at - 1][2] <= c[0]) and (at == len(taken) or c[2] <= taken[at][0]):
                taken.insert(at, c)
        return taken

    def __call__(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans; all spans."""
        base = base_spans(text)
        return base, sorted(base + self.added(text, base))


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", docs: int = TRAIN_DOCS, rows: int = TRAIN_ROWS) -> Detector:
    """Trees, calibration and thresholds from a bounded sample."""
    sample = (hash_share(df, doc_id, docs, 3).where(F.col(text).isNotNull())
              .select(F.col(text).cast("string").alias("text"), F.xxhash64(F.lit(3), F.col(doc_id)).alias("h"))
              .orderBy("h", "text").limit(docs))

    def start():
        def work(piece: Piece) -> Piece:
            made = [(h, np.array(x, "<f8").tobytes(), y) for h, t in zip(piece["h"], piece["text"])
                    for x, y in training_rows(t)]
            return dict(zip(("h", "x", "y"), map(list, zip(*made)))) if made else {"h": [], "x": [], "y": []}
        return work

    seen = (map_pieces(sample, "h long, x binary, y double", start)
            .orderBy(F.xxhash64("h", "x"), "x").limit(rows).collect())
    if not seen:
        return Detector(boosting.Model(0.0, [], np.zeros(0), np.zeros(0)), [2.0] * len(KINDS))
    x = np.stack([np.frombuffer(r["x"], "<f8") for r in seen])
    y, held = np.array([r["y"] for r in seen]), np.array([r["h"] % 3 == 0 for r in seen])
    model = boosting.fit(x, y, held)
    p, thresholds = model.probabilities(x[held]), []
    for kind in range(len(KINDS)):
        own = x[held][:, 0] == kind
        ok = [t for t in np.unique(p[own]) if t > 0.5 and y[held][own][p[own] >= t].mean() >= PRECISION]
        thresholds.append(float(min(ok, default=2.0)))
    return Detector(model, thresholds)


def _shared(df: DataFrame, detector: Detector):
    m = detector.model
    parts = (m.start, [(t.feature, t.cut, t.leaf) for t in m.trees], m.knots, m.heights, detector.thresholds)
    return df.sparkSession.sparkContext.broadcast(parts)


def _unpacked(parts) -> Detector:
    start, trees, knots, heights, thresholds = parts
    return Detector(boosting.Model(start, [boosting.Tree(*t) for t in trees], knots, heights), thresholds)


def find(df: DataFrame, detector: Detector, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base counts, base_sha256 and spans of every row."""
    shared = _shared(df, detector)

    def joined(spans: list[Span]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def start():
        judge = _unpacked(shared.value)

        def work(piece: Piece) -> Piece:
            found = [judge(t or "") for t in piece["text"]]
            return ({"doc_id": piece["doc_id"], "spans": [joined(s) for _, s in found],
                     "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]}
                    | {f"n_{k}": [sum(s[1] == i for s in b) for b, _ in found] for i, k in enumerate(KINDS)})
        return work

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_pieces(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                      f"doc_id long, {counts}, base_sha256 string, spans string", start)


def redacted(text: str, spans: list[Span]) -> str:
    """Each span, or run of overlapping spans, becomes the name of the kind that starts it."""
    out, at, reach = [], 0, 0
    for a, kind, b in sorted(spans):
        if a >= reach:
            out += [text[at:a] if a >= at else "", f"<{KINDS[kind].upper()}>"]
        at = reach = max(reach, b)
    return "".join(out) + text[at:]


def redact(df: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """All rows and columns, with spans in ``text`` replaced."""
    shared, names, schema = _shared(df, detector), df.columns, df.schema

    def run(batches):
        judge, at = _unpacked(shared.value), names.index(text)
        for piece in pieces(batches):
            column = piece.column(at)
            made = [None if t is None else redacted(t, judge(t)[1]) for t in column.to_pylist()]
            yield piece.set_column(at, piece.schema.field(at), pa.array(made, column.type))

    return map_arrow(df, run, schema)
