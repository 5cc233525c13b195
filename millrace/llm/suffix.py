"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of ``width`` bytes over it also starts earlier. Equal strings have equal minimizer names, so all
windows of one name can be judged apart from the others:

1. Every text is cut into runs of windows that share a name. Names, a 128-bit digest of the run's bytes and its place are
   shuffled by name, packed. Runs with equal bytes keep their first occurrence, the others are ranges to remove.
2. A name with several different runs, or one that may repeat inside a run, sends the runs' bytes on. They are shuffled
   by name again; whole names are gathered into pieces of about 1 MB, each gets its transform, and the bounded expansion
   gives the windows that an earlier place shares. A name with more than ``HOT`` different runs (the rim of a passage
   that stands in very many texts) is first cut again by longer grams, which tell its runs apart by nearly all their
   bytes, so no piece has to hold it.
3. Ranges are united per document and cut out of its bytes.

Null text is empty; texts shorter than ``width`` keep everything. A null doc_id comes before all others. Rows that share a
doc_id but not the text are documents of their own, in the order of a hash of their texts (Spark's xxhash64), so each is
judged for itself. Rows that share both are one document, and each of them gets its result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import scope, stage
from .arrow import Piece, arrow_type, map_arrow, map_pieces, pieces
from .bwt import repeated_windows
from .byte_runs import GRAM, Runs, runs_of

WIDTH = 100
HOT = 2048
FLUSH = 400_000
PIECE = 1 << 20
SENT_KEYS = 400_000  # 10 MB at most, what Spark itself broadcasts
ROW = ["key", "sub"]
REMOVED, COMPARED, CROWDED = 0, 1, 2
_NULL_ID = -(1 << 63)


def _packed_runs(texts: DataFrame, width: int, gram: int, buckets: int) -> DataFrame:
    """Runs of (key, sub, first, bytes) rows by bucket of their name, packed: names and digests; documents and starts as
    differences, texts among rows of one id; windows, negative if the name may repeat inside."""
    schema = "bucket int, names binary, codes binary, documents binary, subs binary, starts binary, counts binary"
    out = arrow_type(schema)

    def packed(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        name, code, doc, sub, start, count = (np.concatenate(c) for c in zip(*parts))
        bucket = ((name >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        rows = []
        for b, (i, j) in enumerate(zip(edge[:-1], edge[1:])):
            if j > i:
                at = order[i:j]
                rows.append((b, name[at].astype("<u4").tobytes(), code[at].astype("<u8").tobytes(),
                             np.diff(doc[at], prepend=0).astype("<i8").tobytes(), sub[at].astype("<i8").tobytes(),
                             np.diff(start[at], prepend=0).astype("<i4").tobytes(), count[at].astype("<i4").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), out)], schema=out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, total = [], 0
        for piece in pieces(batches, 1 << 20):
            keys, subs, first = (piece.column(i).to_numpy() for i in range(3))
            texts_ = [b or b"" for b in piece.column(3).to_pylist()]
            r = runs_of(texts_, width, gram)
            parts.append((r.name, _digests(texts_, r, width), keys[r.row], subs[r.row], first[r.row] + r.start,
                          np.where(r.twice, -r.count, r.count)))
            total += len(r.name)
            if total >= FLUSH:
                yield packed(parts)
                parts, total = [], 0
        if total:
            yield packed(parts)

    return map_arrow(texts.select("key", "sub", "first", "bytes"), run, schema)


def _digests(texts: list[bytes], runs: Runs, width: int) -> np.ndarray:
    """128 bits of each run's bytes, as two numbers."""
    views = [memoryview(t) for t in texts]
    made = [hashlib.blake2b(views[row][a:b], digest_size=16).digest() for row, a, b in zip(
        runs.row.tolist(), runs.start.tolist(), (runs.start + runs.count - 1 + width).tolist())]
    return np.frombuffer(b"".join(made), "<u8").reshape(-1, 2)


def _judged(packed: DataFrame, width: int, hot: int) -> DataFrame:
    """kind, key, sub, first, stop and name of the runs that are to be removed or to be compared."""
    schema = "kind int, key long, sub long, first long, stop long, name long"
    out = arrow_type(schema)

    def of_bucket(bucket: int, parts: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        name, code, doc, sub, start, count = (
            np.concatenate([read(np.frombuffer(p[i], kind)) for p in parts]) for i, (kind, read) in enumerate(
                (("<u4", np.asarray), ("<u8", lambda x: x.reshape(-1, 2)), ("<i8", np.cumsum), ("<i8", np.asarray),
                 ("<i4", lambda x: np.cumsum(x, dtype=np.int64)), ("<i4", lambda x: x.astype(np.int64)))))
        order = np.argsort(name, kind="stable")
        same = name[order][1:] == name[order][:-1]
        shared = np.append(same, False) | np.insert(same, 0, False) | (count[order] < 0)
        order = order[shared]
        order = order[np.lexsort((start[order], sub[order], doc[order], code[order, 0], code[order, 1], name[order]))]
        name, code, doc, sub, start, count = name[order], code[order], doc[order], sub[order], start[order], count[order]
        fresh_name = np.diff(name.astype(np.int64), prepend=-1) != 0
        fresh = fresh_name.copy()
        fresh[1:] |= (code[1:] != code[:-1]).any(axis=1)
        which = np.cumsum(fresh_name) - 1
        different = np.bincount(which[fresh], minlength=int(fresh_name.sum()))[which]
        lead = np.maximum.accumulate(np.where(fresh, np.arange(len(name)), 0))
        first_one = (doc == doc[lead]) & (sub == sub[lead]) & (start == start[lead])
        kind = np.where(~first_one, REMOVED, np.where(different > hot, CROWDED, COMPARED))
        used = ~first_one | fresh & ((different > 1) | (count < 0))
        stop = start + np.abs(count) - 1 + width
        columns = (kind, doc, sub, start, stop, (np.int64(bucket) << np.int64(32)) | name.astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c[used], type=f.type) for c, f in zip(columns, out)], schema=out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for b, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket and parts:
                    yield of_bucket(bucket, parts)
                    parts = []
                bucket = b
                parts.append(row)
        if parts:
            yield of_bucket(bucket, parts)

    return map_arrow(packed, run, schema)


def _narrowed(texts: DataFrame, width: int, gram: int, hot: int) -> DataFrame:
    buckets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = _packed_runs(texts, width, gram, buckets).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return stage(_judged(packed, width, hot), "judged")


def _segments(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """kind, name, key, sub, first and bytes of runs. A document's runs travel together, so its text is joined once."""
    listed = runs.groupBy("key", "sub").agg(F.collect_list(F.struct("kind", "name", "first", "stop")).alias("runs"))
    schema = "kind int, name long, key long, sub long, first long, segment binary"
    out = arrow_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 1 << 20):
            keys, subs, texts_, lists = (c.to_pylist() for c in piece.columns)
            rows = [(r["kind"], r["name"], key, sub, r["first"], text[r["first"]:r["stop"]])
                    for key, sub, text, list_ in zip(keys, subs, texts_, lists) for r in list_ if r["stop"] <= len(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(out)], schema=out)

    return stage(map_arrow(texts.select(*ROW, "bytes").join(listed, ROW), run, schema), "segments")


def _expanded(segments: DataFrame, width: int) -> DataFrame:
    """key, sub, first and stop of the ranges that repeat, among segments of equal name."""
    schema = "key long, sub long, first long, stop long"
    out = arrow_type(schema)

    def of_piece(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        rows = sorted(set(rows))
        keys, subs, firsts, stops = [], [], [], []
        for (key, sub, first, _), starts in zip(rows, repeated_windows([r[3] for r in rows], width)):
            if len(starts):
                gap = np.flatnonzero(np.diff(starts) > 1)
                a, b = starts[np.append(0, gap + 1)] + first, starts[np.append(gap, len(starts) - 1)] + first + width
                keys.append(np.full(len(a), key))
                subs.append(np.full(len(a), sub))
                firsts.append(a)
                stops.append(b)
        none = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c or none), type=pa.int64()) for c in (keys, subs, firsts, stops)],
                                          schema=out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows, size = None, [], 0
        for batch in batches:
            for n, key, sub, first, segment in zip(*(c.to_pylist() for c in batch.columns)):
                if n != name and size >= PIECE:
                    yield of_piece(rows)
                    rows, size = [], 0
                name = n
                rows.append((key, sub, first, segment))
                size += len(segment)
        if rows:
            yield of_piece(rows)

    dealt = segments.select("name", *ROW, "first", "segment")
    width_ = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(dealt.repartition(width_, "name").sortWithinPartitions("name"), run, schema)


def repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """key (doc_id, a null one as the least number), sub (hash of the text) and the ranges of repeated bytes; they may
    overlap."""
    texts = _keyed(df, doc_id, text)
    range_ = [*ROW, "first", "stop"]
    with scope(df.sparkSession) as keep:
        found = _narrowed(texts, width, GRAM, hot)
        parts = _segments(texts, found.where(F.col("kind") != REMOVED))
        ranges = (found.where(F.col("kind") == REMOVED).select(*range_)
                  .unionByName(_expanded(parts.where(F.col("kind") == COMPARED), width)))
        crowded = parts.where(F.col("kind") == CROWDED)
        if not crowded.isEmpty():
            finer = _narrowed(crowded.select(*ROW, "first", F.col("segment").alias("bytes")), width, width - 4, 1 << 62)
            finer_runs = finer.where(F.col("kind") != REMOVED)
            rows = stage(finer_runs.select(*ROW).distinct(), "keys")
            few = texts.join(F.broadcast(rows), ROW, "left_semi") if rows.count() <= SENT_KEYS else texts
            again = _segments(few, finer_runs)
            ranges = (ranges.unionByName(finer.where(F.col("kind") == REMOVED).select(*range_))
                      .unionByName(_expanded(again, width)))
        return keep(ranges, "ranges")


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """key, sub, first and bytes of every row; key and sub together tell documents apart and put them in order."""
    bytes_ = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("key"), F.xxhash64(bytes_).alias("sub"),
                     F.lit(0).cast("long").alias("first"), bytes_.alias("bytes"))


def remove(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """doc_id, bytes kept, n_bytes, n_removed and n_spans of every row."""
    listed = (repeats(df, doc_id, text, width, hot).groupBy(*ROW)
              .agg(F.collect_list(F.struct("first", "stop")).alias("ranges")))
    schema = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"

    def start():
        def work(piece: Piece) -> Piece:
            made = [_cut(b, r) for b, r in zip(piece["bytes"], piece["ranges"])]
            kept, removed, spans = zip(*made)
            return {"doc_id": [None if k == _NULL_ID else k for k in piece["key"]], "kept": list(kept),
                    "n_bytes": list(map(len, piece["bytes"])), "n_removed": list(removed), "n_spans": list(spans)}
        return work

    return map_pieces(_keyed(df, doc_id, text).select(*ROW, "bytes").join(listed, ROW, "left"), schema, start)


def _cut(text: bytes, ranges: list[dict] | None) -> tuple[bytes, int, int]:
    kept, at, removed, spans, reach = [], 0, 0, 0, -1
    for r in sorted((r["first"], min(r["stop"], len(text))) for r in ranges or []):
        a, b = r
        if b <= a:
            continue
        if a > reach:
            spans += 1
            kept.append(text[at:a])
            removed += b - a
        else:
            removed += max(0, b - reach)
        reach = at = max(reach, b)
    kept.append(text[at:])
    return b"".join(kept), removed, spans


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    return remove(df, doc_id, text, width, hot).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
