"""Quality scores by supervised subword embeddings.

Words, pairs of neighbouring words and the character n-grams of words are hashed into a table of learned vectors. A document
is the average of the vectors of all its features, and a softmax layer turns it into the probabilities of the labels. Table
and layer are trained by stochastic gradient descent in numpy, one document a step, on a bounded sample of labelled rows
(``DOCS`` rows and ``FEATURES`` distinct features of a document in all, in the order of a hash of the id). A step is scaled
by the document's number of features, so long documents teach as much as short ones.

The layer is linear, so for scoring each feature's vector is multiplied by it once; the average of these numbers over a
document is the same as the layer of the average.

A text without features (null, empty, white space) is the zero vector and scores what the layer's offsets say. Without any
label every score is 0.5; rows whose label is null or other than 0 and 1 teach nothing. Labels that repeat for a document
teach once each; a null doc_id has no label and is not held out. Repeated rows give repeated results, an empty table none.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import Piece, hash_share, map_pieces
from .shingles import mix

BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4, 5)
DOCS = 4000
FEATURES = 12_000_000
EPOCHS = 6
RATE = 0.3
_LOWEST = 33  # code points below are taken as the edge of a word


def _words(codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last places of the words and their codes (a sum over letters mixed with their places)."""
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    first, last = edge[::2], edge[1::2]
    if not len(first):
        return first, last, np.zeros(0, np.uint64)
    nth = np.cumsum(np.diff(inside.astype(np.int8), prepend=0) == 1) - 1
    place = np.arange(len(codes)) - first[np.maximum(nth, 0)]
    value = np.where(inside, mix(codes + (place.astype(np.uint64) << np.uint64(24))), np.uint64(0))
    return first, last, mix(np.add.reduceat(value, first))


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, and the text each belongs to."""
    flat = "\n".join(["", *(t or "" for t in texts), ""])  # an edge before the first text too
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.array([len(t or "") + 1 for t in texts], np.int64)
    inside = codes >= _LOWEST
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size + (np.arange(len(texts)) == 0))
    first, last, words = _words(codes, inside)
    whose = owner[first]
    out, of = [mix(words + np.uint64(1))], [whose]
    pair = whose[1:] == whose[:-1] if len(whose) else np.zeros(0, bool)
    out.append(mix(mix(words[:-1][pair] + np.uint64(2)) + words[1:][pair]))
    of.append(whose[1:][pair])
    # n-grams of a word with its edges: blanks only at the ends
    letters = np.where(inside, codes, np.uint64(32))
    blanks = np.concatenate([[0], np.cumsum(~inside)])
    for n in GRAMS:
        if len(letters) < n:
            continue
        at = np.flatnonzero(blanks[n - 1:-1] - blanks[1:len(blanks) - n + 1] == 0)  # none between the ends
        gram = np.full(len(at), np.uint64(n))
        for j in range(n):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + letters[at + j]
        out.append(mix(gram))
        of.append(owner[at + 1])
    return (np.concatenate(out) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(of)


def train(docs: Iterator[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 13) -> dict:
    """Table, layer and offsets from (distinct features, their shares, label) of documents."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, offset = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    rows = list(docs)
    step, steps = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            ids, share, label = rows[i]
            now = rate * (1 - step / steps)
            step += 1
            vectors = table[ids]
            hidden = share @ vectors
            x = hidden @ layer + offset
            error = np.exp(x - x.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            layer -= now * np.outer(hidden, error)
            offset -= now * 0.1 * error
            if len(ids):
                table[ids] = vectors - (now / (share @ share)) * share[:, None] * back
    return {"weight": (table @ (layer[:, 1] - layer[:, 0])).astype(np.float64), "offset": float(offset[1] - offset[0])}


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32 of the id's text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        docs: int = DOCS, limit: int = FEATURES) -> dict:
    """Train on about ``docs`` labelled rows that are not held out; features are made in tasks and sent to the driver."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id)).select(
        F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    chosen = hash_share(known, "id", docs, 13)
    texts = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id")  # a bounded sample

    def start():
        def work(piece: Piece) -> Piece:
            at, of = features(piece["text"])
            edge = np.searchsorted(of_sorted := of[order := np.argsort(of, kind="stable")], np.arange(len(piece["id"]) + 1))
            parts = [np.unique(at[order[i:j]], return_counts=True) for i, j in zip(edge[:-1], edge[1:])]
            return {"id": piece["id"], "label": piece["label"], "ids": [p[0].astype("<u2").tobytes() for p in parts],
                    "counts": [p[1].astype("<u4").tobytes() for p in parts]}
        return work

    made = map_pieces(rows.select("id", "text", "label"), "id long, label int, ids binary, counts binary", start)

    def bounded() -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        total = 0
        for r in made.orderBy(F.xxhash64(F.lit(13), "id"), "id", "label", "ids").toLocalIterator():
            total += len(r["ids"]) // 2
            if total > limit:
                return
            counts = np.frombuffer(r["counts"], "<u4").astype(np.float32)
            yield np.frombuffer(r["ids"], "<u2"), counts / max(1.0, counts.sum()), r["label"]

    return train(bounded())


def score(df: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (probability of label 1) and predicted of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        weight, offset = shared.value["weight"], shared.value["offset"]

        def work(piece: Piece) -> Piece:
            at, of = features(piece["text"])
            n = len(piece["text"])
            mean = np.bincount(of, weight[at], minlength=n) / np.maximum(1, np.bincount(of, minlength=n))
            p = 1 / (1 + np.exp(-np.clip(mean + offset, -50, 50)))
            return {"doc_id": piece["doc_id"], "score": p.tolist(), "predicted": (p >= 0.5).astype(int).tolist()}
        return work

    return map_pieces(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                      "doc_id long, score double, predicted int", start)
