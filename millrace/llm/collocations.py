"""Phrase collocations by prefix-free parsing.

The words of a piece of text are cut where the hash of the last words says so: a chunk ends with such a trigger, and the
next one starts with it, so the same passage gives the same chunks wherever it stands. The distinct chunks of a language
with their frequencies are the dictionary of the parse. Phrases are counted inside distinct chunks, weighted by the chunk's
frequency. Chunks overlap by one word less than the longest phrase: every phrase lies in one at least, and it is counted in
the one where it does not start inside the overlap at the end, so exactly once.

Most phrases are rare, so they are told apart first by short codes (a few bits more than the number of words needs).
Chunks are dealt into groups. A group sends its codes with their counts, packed, to buckets of the code range; a bucket
answers each group with those of its codes that reach the least count over all. Two phrases may share a code, which only
lets a rare one through: what is counted in the end, in the groups and then over all of them, are the phrases themselves.
No list of phrases, words or codes is sent to every task.

A null text is empty and a null language is ``und``. Rows that repeat count as often as they occur. Empty texts and
punctuation alone give nothing; an empty table gives no rows. doc_id is not used; extra columns are ignored. Words are kept
as they are but for A-Z, so any other letter counts by its own bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import scope, stage, unstage
from .arrow import map_arrow, packed_numbers, pieces, unpacked_numbers
from .shingles import mix

LONGEST = 3
LEAST = 10
TOP = 2000
TRIGGER = 16  # one place in so many ends a chunk
GROUP_WORDS = 1_500_000  # at most; there are four groups a task at least
BUCKET_CODES = 1_000_000
SPARE_BITS = 6
PIECE = 4 << 20
_CHUNK = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("last", pa.bool_()), ("freq", pa.int64())])


def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined or cut to about ``PIECE`` bytes."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for piece in pieces(batches, PIECE):
        if not piece.num_rows:
            continue
        held.append(piece)
        size += piece.nbytes
        if size >= PIECE:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def _hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of each word among the distinct ones, 64-bit code of the distinct ones, and these."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    return (coded.indices.to_numpy().astype(np.int64),
            pd.util.hash_array(np.array(distinct.to_pylist(), object)) if len(distinct) else np.zeros(0, np.uint64), distinct)


def _span_index(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of every span, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def parse(texts: pa.Array, langs: pa.Array, longest: int = LONGEST, trigger: int = TRIGGER) -> pa.Table:
    """Distinct (lang, chunk, last) of some texts and how often each occurs; ``last`` marks the end of a piece."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), r"[.,;:!?\n-\r]")
    split = pc.split_pattern_regex(pc.list_flatten(parts), "[ \t]+")
    words, piece = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
    real = pc.not_equal(words, "")
    words, piece = words.filter(real), piece[real.to_numpy(zero_copy_only=False)]
    if not len(words):
        return _CHUNK.empty_table()
    doc = pc.list_parent_indices(parts).to_numpy()
    edge = np.flatnonzero(np.diff(piece, prepend=-1))  # first word of each piece
    size = np.diff(np.append(edge, len(words)))
    begin, end = np.repeat(edge, size), np.repeat(edge + size, size)
    number, codes, _ = _hashed(words)
    code, overlap, at = codes[number], longest - 1, np.arange(len(words))
    window = np.zeros(len(words), np.uint64)
    for back in range(overlap):
        window = mix(window + code[np.maximum(at - back, 0)])
    # a chunk must own a word, and the end of a piece is an end anyway
    cut = np.flatnonzero((window % np.uint64(trigger) == 0) & (at - begin >= overlap) & (at < end - 1)) if overlap else at[:0]
    first = np.sort(np.concatenate([edge, cut + 1 - overlap]))
    stop = np.sort(np.concatenate([edge + size, cut + 1]))
    chunk = pc.binary_join(pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(stop - first)]).astype(np.int32)),
        words.take(pa.array(_span_index(first, stop - first)))), " ")
    lang = pc.fill_null(langs, "und").take(pa.array(doc[piece[first]]))
    rows = pa.table({"lang": lang, "chunk": chunk, "last": pa.array(stop == end[first])})
    return (rows.group_by(["lang", "chunk", "last"]).aggregate([([], "count_all")])
            .rename_columns(["lang", "chunk", "last", "freq"]).cast(_CHUNK))


class Counted:
    """Owned phrases of some distinct chunks: where each starts, its number of words, its code and its weight."""

    def __init__(self, lang: pa.Array, chunk: pa.Array, last: np.ndarray, freq: np.ndarray, longest: int):
        split = pc.split_pattern(chunk, " ")
        self.words, owner = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
        self.number, codes, self.distinct = _hashed(self.words)
        size = np.bincount(owner, minlength=len(chunk))
        end = np.cumsum(size)
        place = np.arange(len(self.words))
        owned = place < (end - np.where(last, 0, longest - 1))[owner]
        langs, spoken, _ = _hashed(lang)
        code = mix(spoken[langs][owner])
        self.owner, self.parts = owner, []
        for k in range(1, longest + 1):
            ahead = np.minimum(place + k - 1, len(self.words) - 1)
            code = mix(code + codes[self.number[ahead]] + np.uint64(k))
            at = np.flatnonzero(owned & (place + k <= end[owner]))
            self.parts.append((k, at, code[at], freq[owner[at]]))


def _longer(key: np.ndarray, span: int, number: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Keys below ``span`` told apart further by numbers below ``size``, in the same order; what they are below. Exact: keys
    that would not fit into 63 bits are numbered anew first."""
    if span * size >= 1 << 63:
        known, key = np.unique(key, return_inverse=True)
        span = len(known)
    return key * np.int64(size) + number, span * size


def _of_piece(piece: pa.RecordBatch, longest: int) -> Counted:
    return Counted(piece["lang"], piece["chunk"], piece["last"].to_numpy(zero_copy_only=False), piece["freq"].to_numpy(), longest)


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct keys, a place of each, and exact sums of their weights."""
    order = np.argsort(keys)
    edge = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[order][edge], order[edge], np.add.reduceat(weights[order], edge) if len(edge) else weights[:0]


def dictionary(df: DataFrame, text: str, lang: str, longest: int, trigger: int) -> DataFrame:
    """Staged grp, lang, chunk, last, freq, words (owned ones) of the distinct chunks, in groups of about GROUP_WORDS."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in gathered(batches):
            yield from parse(piece.column(0), piece.column(1), longest, trigger).to_batches()

    rows = df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(4 * width, int(size / 6 / GROUP_WORDS))
    parsed = map_arrow(rows, run, "lang string, chunk string, last boolean, freq long")
    dealt = parsed.withColumn("grp", F.pmod(F.xxhash64("lang", "chunk"), F.lit(groups)).cast("int")).repartition(width, "grp")
    once = dealt.groupBy("grp", "lang", "chunk", "last").agg(F.sum("freq").alias("freq"))
    words = F.length("chunk") - F.length(F.replace("chunk", F.lit(" "), F.lit(""))) + 1
    owned = words - F.when(F.col("last"), 0).otherwise(longest - 1)
    return stage(once.withColumn("words", owned.cast("long")).sortWithinPartitions("grp"), "chunks")


def _codes(chunks: DataFrame, longest: int, bits: int, bucket_bits: int) -> DataFrame:
    """grp, bucket, number, packed codes (differences) and packed counts of all phrases."""
    kind = "grp int, bucket int, n int, codes binary, counts binary"
    schema = pa.schema([("grp", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in gathered(batches):
            rows, group = [], piece["grp"].to_numpy()
            for grp in np.unique(group).tolist():
                made = _of_piece(piece.filter(pa.array(group == grp)), longest)
                codes, _, counts = _sums(np.concatenate([p[2] for p in made.parts]) >> np.uint64(64 - bits),
                                         np.concatenate([p[3] for p in made.parts]))
                bucket = (codes >> np.uint64(bits - bucket_bits)).astype(np.int64)
                edge = np.flatnonzero(np.diff(bucket, prepend=-1))
                for i, j in zip(edge.tolist(), np.append(edge[1:], len(codes)).tolist()):
                    rows.append((grp, int(bucket[i]), j - i, packed_numbers(np.diff(codes[i:j], prepend=np.uint64(0))), packed_numbers(counts[i:j])))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return map_arrow(chunks, run, kind)


def _frequent(codes: DataFrame, width: int, least: int) -> DataFrame:
    """grp, number and packed codes of those that reach ``least`` over all groups: a bucket's answer to each group."""
    schema = pa.schema([("grp", pa.int32()), ("n", pa.int32()), ("codes", pa.binary())])

    def of_bucket(rows: list[tuple]) -> pa.RecordBatch:
        codes_ = [np.cumsum(unpacked_numbers(r[2], r[1]), dtype=np.uint64) for r in rows]
        values, _, sums = _sums(np.concatenate(codes_), np.concatenate([unpacked_numbers(r[3], r[1]) for r in rows]).astype(np.int64))
        often = values[sums >= least]
        hits = [c[np.isin(c, often, assume_unique=True)] for c in codes_]
        found = [(r[0], len(h), packed_numbers(h)) for r, h in zip(rows, hits) if len(h)]
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t.type) for k, t in enumerate(schema)], schema=schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for grp, now, n, codes_, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if now != bucket and rows:
                    yield of_bucket(rows)
                    rows = []
                bucket = now
                rows.append((grp, n, codes_, counts))
        if rows:
            yield of_bucket(rows)

    return map_arrow(codes.repartition(width, "bucket").sortWithinPartitions("bucket"), run, "grp int, n int, codes binary")


def _phrases(chunks: DataFrame, frequent: DataFrame, width: int, longest: int, bits: int) -> DataFrame:
    """lang, phrase, k (words) and f of the phrases that a group counts under a frequent code."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("f", pa.int64())])
    none = {c: F.lit(None).cast(t) for c, t in (("n", "int"), ("codes", "binary"), ("lang", "string"), ("chunk", "string"),
                                                ("last", "boolean"), ("freq", "long"))}
    columns = ["grp", "kind", *none]
    rows = (frequent.withColumns({c: none[c] for c in ("lang", "chunk", "last", "freq")} | {"kind": F.lit(0)}).select(*columns)
            .unionByName(chunks.withColumns({c: none[c] for c in ("n", "codes")} | {"kind": F.lit(1)}).select(*columns))
            .repartition(width, "grp").sortWithinPartitions("grp", "kind"))

    def counted(piece: pa.RecordBatch, often: np.ndarray) -> pa.Table:
        made, out = _of_piece(piece, longest), []
        langs = piece["lang"].dictionary_encode()
        spoken = langs.indices.to_numpy()[made.owner].astype(np.int64)
        key, span = spoken, max(1, len(langs.dictionary))  # number of (lang, words so far) at each place, exact
        for k, at, code, weight in made.parts:
            ahead = np.minimum(np.arange(len(key)) + k - 1, len(key) - 1)
            key, span = _longer(key, span, made.number[ahead], max(1, len(made.distinct)))
            code = code >> np.uint64(64 - bits)
            near = np.minimum(np.searchsorted(often, code), max(0, len(often) - 1))
            hit = often[near] == code if len(often) else np.zeros(len(code), bool)
            _, where, f = _sums(key[at[hit]], weight[hit])
            first = at[hit][where]
            if len(first):
                text = pc.binary_join(pa.ListArray.from_arrays(
                    pa.array(np.arange(0, k * len(first) + 1, k).astype(np.int32)),
                    made.words.take(pa.array(_span_index(first, np.full(len(first), k))))), " ")
                out.append(pa.table([langs.dictionary.take(pa.array(spoken[first])), text,
                                     pa.array(np.full(len(first), k, np.int32)), pa.array(f)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, often = None, [], np.zeros(0, np.uint64)
        for batch in gathered(batches):
            for grp in pc.unique(batch["grp"]).to_pylist():
                rows_ = batch.filter(pc.equal(batch["grp"], grp))
                if grp != group:
                    group, parts, often = grp, [], None
                told = rows_.filter(pc.equal(rows_["kind"], 0))
                parts += [unpacked_numbers(c, n) for c, n in zip(told["codes"].to_pylist(), told["n"].to_pylist())]
                rows_ = rows_.filter(pc.equal(rows_["kind"], 1))
                if rows_.num_rows:
                    if often is None:  # all answers of a group come before its chunks
                        often, parts = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64), []
                    yield from counted(rows_, often).to_batches()

    return map_arrow(rows, run, "lang string, phrase string, k int, f long")


def counts(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST,
           trigger: int = TRIGGER) -> tuple[DataFrame, DataFrame]:
    """Staged (lang, phrase, k, f) of all phrases of up to ``longest`` words found ``least`` times or more, and (lang, n)."""
    chunks = dictionary(df, text, lang, longest, trigger)
    words = stage(chunks.groupBy("lang").agg(F.sum(F.col("words") * F.col("freq")).alias("n"), F.sum("words").alias("distinct")), "words")
    size = words.agg(F.sum("distinct")).first()[0] or 1
    bucket_bits = (longest * size // BUCKET_CODES).bit_length()
    bits = min(62, max(bucket_bits, int(size).bit_length()) + SPARE_BITS)
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answers = stage(_frequent(_codes(chunks, longest, bits, bucket_bits), width, least), "frequent")
    found = stage(_phrases(chunks, answers, width, longest, bits).groupBy("lang", "phrase", "k")
                  .agg(F.sum("f").alias("f")).where(F.col("f") >= least), "phrases")
    unstage(chunks)
    unstage(answers)
    return found, words.select("lang", "n")


def mine(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP,
         share: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best collocations of each language.

    A phrase scores by the cut that scores lowest. One that lies inside a longer candidate with ``share`` percent or more
    of its own count is left out.
    """
    with scope(df.sparkSession) as keep:
        found, words = counts(df, text, lang, longest, least)
        return keep(_ranked(found, words, top, share), "collocations")


def _ranked(found: DataFrame, words: DataFrame, top: int, share: int) -> DataFrame:
    """The best ``top`` collocations of each language from counts of phrases and words."""
    word = F.split("phrase", " ")
    candidates = found.where("k > 1").select("lang", "phrase", F.col("k").alias("size"), F.col("f").alias("a"))
    known = found.select("lang", "phrase", F.col("f"))
    cuts = (candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .withColumns({"left": F.array_join(F.slice(word, F.lit(1), F.col("cut")), " "),
                          "right": F.array_join(F.slice(word, F.col("cut") + 1, F.col("size") - F.col("cut")), " ")}))
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}  # products have up to 38 digits
    scored = (cuts.join(known.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"])
              .join(known.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"])
              .select("lang", "phrase", "cut", "a", "l", "r", (F.lit(1_000_000) * (wide["a"] * wide["a"])).alias("x"),
                      (wide["l"] * wide["r"]).alias("y"))
              .withColumn("score", F.expr("x div y")))
    lowest = (scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("b"))
              .select("lang", "phrase", "b.score", "b.a", "b.l", "b.r"))
    inside = (candidates.where("size > 2").withColumn("n", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
              .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
              .select("lang", F.array_join(F.slice(word, F.col("at"), F.col("n")), " ").alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (lowest.join(inside, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {share} * a"))
            .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
