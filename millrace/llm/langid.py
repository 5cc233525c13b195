"""Language ID by a byte convolutional network in numpy.

Filters of widths 2, 3 and 4 slide over UTF-8 bytes, each filter keeps its maximum over a window of 128 bytes, and a
softmax layer turns the maxima into languages. Training uses a bounded sample of labelled texts (``TRAIN_DOCS`` texts,
``TRAIN_WINDOWS`` windows each at positions spread over the whole text); only text and label are seen. A text is judged
over all its windows, the last one shifted back to end with the text: log-probabilities are averaged over windows.

Null text, or text without a letter, is ``und`` with score 0. A null label is never learned from; with no labelled
text at all everything is ``und``. Rows are judged one by one, so repeated rows and extra columns have no effect.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import Piece, hash_share, map_arrow, map_pieces, pieces

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
TRAIN_DOCS = 3000
TRAIN_WINDOWS = 4
STEPS = 400
BATCH = 128
UNKNOWN = "und"


@dataclass
class Network:
    """taps[w][j] is the byte -> filters table of position j in the filters of width w."""

    classes: list[str]
    taps: dict[int, np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray


def _convolved(taps: np.ndarray, windows: np.ndarray) -> np.ndarray:
    width = len(taps)
    n = windows.shape[1] - width + 1
    out = taps[0][windows[:, :n]]
    for j in range(1, width):
        out = out + taps[j][windows[:, j:j + n]]
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, classes: list[str], steps: int = STEPS, seed: int = 5) -> Network:
    """Adam on cross-entropy; through max pooling the gradient reaches only the position that won."""
    rng = np.random.default_rng(seed)
    taps = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
    bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    weights = rng.normal(0, 0.3, (len(bias), len(classes))).astype(np.float32)
    offset = np.zeros(len(classes), np.float32)
    params = [*taps.values(), bias, weights, offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rows = np.arange(BATCH)
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), BATCH)
        x, y = windows[pick], labels[pick]
        maps = [_convolved(taps[w], x) for w in WIDTHS]
        won = [m.argmax(axis=1) for m in maps]
        pooled = np.concatenate([m.max(axis=1) for m in maps], axis=1) + bias
        hidden = np.maximum(pooled, 0)
        error = _softmax(hidden @ weights + offset)
        error[rows, y] -= 1
        error /= BATCH
        back = (error @ weights.T) * (pooled > 0)
        grads = []
        for i, w in enumerate(WIDTHS):
            g = np.zeros_like(taps[w])
            part = back[:, i * FILTERS:(i + 1) * FILTERS]
            for j in range(w):
                np.add.at(g[j], (x[rows[:, None], won[i] + j], np.arange(FILTERS)[None, :]), part)
            grads.append(g)
        grads += [back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return Network(classes, taps, bias, weights, offset)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows that cover each text, and whose they are. Short texts are padded with zero bytes."""
    owner, starts = [], []
    flat = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size) - size
    count = np.maximum(1, -(-size // WINDOW))
    owner = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    inside = np.minimum(nth * WINDOW, np.maximum(0, size[owner] - WINDOW))
    starts = begin[owner] + inside
    windows = flat[starts[:, None] + np.arange(WINDOW)]
    short = size[owner] < WINDOW
    if short.any():
        at = np.flatnonzero(short)
        windows[at] = np.where(np.arange(WINDOW) < size[owner[at]][:, None], windows[at], 0)
    return windows, owner


class Predictor:
    """The network with pairs of bytes looked up at once."""

    def __init__(self, net: Network):
        self.net = net
        pairs = {w: [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, FILTERS) for j in range(0, w - 1, 2)]
                 for w, t in net.taps.items()}
        # one row per byte pair for all filters that start there
        self.head = np.concatenate([pairs[w][0] for w in WIDTHS], axis=1)
        self.single = net.taps[3][2]
        self.tail = pairs[4][1]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Log-probabilities per window."""
        out, net = [], self.net
        for at in range(0, len(windows), 512):
            x = windows[at:at + 512]
            code = x[:, :-1].astype(np.int32) << 8 | x[:, 1:]
            maps = self.head[code]
            maps[:, :-1, FILTERS:2 * FILTERS] += self.single[x[:, 2:]]
            maps[:, :-2, 2 * FILTERS:] += self.tail[code[:, 2:]]
            pooled = np.concatenate([maps[:, :, :FILTERS].max(axis=1), maps[:, :-1, FILTERS:2 * FILTERS].max(axis=1),
                                     maps[:, :-2, 2 * FILTERS:].max(axis=1)], axis=1)
            out.append(np.log(_softmax(np.maximum(pooled + net.bias, 0) @ net.weights + net.offset) + 1e-9))
        return np.concatenate(out)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        named = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        label, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if named and self.net.classes:
            windows, owner = cut([texts[i].encode() for i in named])
            total = np.zeros((len(named), len(self.net.classes)))
            np.add.at(total, owner, self.probabilities(windows))
            mean = _softmax(total / np.bincount(owner)[:, None])
            for i, best, p in zip(named, mean.argmax(axis=1).tolist(), mean.max(axis=1).tolist()):
                label[i], score[i] = self.net.classes[best], p
        return label, score


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id",
        docs: int = TRAIN_DOCS) -> Network:
    """Train on ``docs`` rows chosen by a hash of their id (a bounded sample); rows with a null label are left out."""
    known = labelled.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    chosen = (hash_share(known, doc_id, docs, 11).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"),
                              F.col(label).cast("string").alias("label")))
    # spread over the whole text: window n of TRAIN_WINDOWS starts at its n-th part
    size = F.greatest(F.lit(0), F.length("text") - WINDOW)
    windows = F.transform(F.sequence(F.lit(0), F.lit(TRAIN_WINDOWS - 1)), lambda n: F.substring(
        F.col("text"), (size * n / (TRAIN_WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW)))
    rows = (chosen.select("label", windows.alias("w"), F.xxhash64(F.lit(11), "id").alias("h"))
            .orderBy("h", "label").limit(docs).collect())
    classes = sorted({r["label"] for r in rows})
    if not rows:
        return Network([], {w: np.zeros((w, 256, FILTERS), np.float32) for w in WIDTHS},
                       np.zeros(len(WIDTHS) * FILTERS, np.float32), np.zeros((len(WIDTHS) * FILTERS, 0), np.float32),
                       np.zeros(0, np.float32))
    parts = [w.encode()[:WINDOW].ljust(WINDOW, b"\0") for r in rows for w in r["w"]]
    x = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, WINDOW)
    y = np.repeat([classes.index(r["label"]) for r in rows], TRAIN_WINDOWS)
    return train(x, y, classes)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32 of the id's text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(df: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shared = df.sparkSession.sparkContext.broadcast(vars(net))

    def start():
        judge = Predictor(Network(**shared.value))

        def work(piece: Piece) -> Piece:
            label, score = judge(piece["text"])
            return {"doc_id": piece["doc_id"], "lang_pred": label, "score": score}
        return work

    return map_pieces(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                      "doc_id long, lang_pred string, score double", start)


def least_score(classes: int) -> float:
    """0.3, or 1.2 times an even share of the labels where that is less."""
    return min(0.3, 1.2 / max(1, classes))


def keep_identified(df: DataFrame, net: Network, text: str = "text", least: float | None = None) -> DataFrame:
    """Rows with all their columns, without those that are ``und`` or score under ``least`` (``least_score`` if None)."""
    least = least_score(len(net.classes)) if least is None else least
    shared = df.sparkSession.sparkContext.broadcast(vars(net))
    names = df.columns

    def run(batches):
        judge = Predictor(Network(**shared.value))
        at = names.index(text)
        for piece in pieces(batches):
            label, score = judge(piece.column(at).to_pylist())
            yield piece.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(label, score)]))

    return map_arrow(df, run, df.schema)
