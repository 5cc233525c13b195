"""N-gram Jaccard join by parity sketches.

A set of shingles is hashed into a sketch of parity blocks: every shingle falls into one block and is XORed into it.
Sets that differ in D shingles differ in at most D blocks. Similarity of 3/4 or more bounds D by a seventh of the two
sizes' sum, so a document with more filled blocks than that shares a filled block with every document it links to. The
number of blocks is set per size band for this to hold; a document that falls short of it joins again with twice the
blocks, until it does. Bands overlap at their borders, so that every linkable pair meets in one.

Blocks are joined as (band, block, value) signatures. Documents with equal sets are one class with one stand-in per
task, so copies do not inflate groups. Since linked documents share several signatures, each may leave out those of its
largest groups and still meet every partner in a smaller one (``_kept``): groups that only a frequent passage holds
together fall apart, and documents without partners drop out. In each group that is left, the links to its least member
are candidates. They must pass the bit sketches, whose Hamming distance never exceeds D; then one link of each document
is tested, then those between documents that are not connected yet. A group that is connected by then is done; in any
other, the members that are not connected to the least one are compared with the rest by their sketches, and pairs within
the bound are tested as well. All tests count shingles exactly, so no link between different texts is lost.

Only those last comparisons look at pairs inside a group: a group held together by a passage, whose members mostly do not
link, costs one XOR and bit count of two sketches for each pair of a loose member and another one. They are dealt out in
parts of ``CHUNK`` members and no pair becomes a row unless its sketches allow a link.

Texts without words (null, empty, white space) have n_shingles 0, link with nothing and are their own component. Rows
that share a doc_id are one document with all their links; a row with a null doc_id is not linked (component_id null).
Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import scope, stage, unstage
from .arrow import Piece, arrow_type, map_arrow, map_pieces, packed_numbers, pieces, unpacked_numbers
from .components import components
from .shingles import mix, shingle_sets

FLUSH = 300_000
CHUNK = 1024
SALTED = 256
ROWS = 64  # sketches compared with all of a part at once
SENT_IDS = 500_000  # 8 MB at most; Spark itself broadcasts up to 10 MB


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union of two sorted sets."""
    if not len(a) or not len(b) or 3 * len(a) > 4 * len(b) or 3 * len(b) > 4 * len(a):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def schemes(size: int) -> list[tuple[int, int, int]]:
    """(number, least, most size) of the bands a set of ``size`` belongs to.

    Even numbers are the bands [4^n, 4^(n+1)), odd ones the borders between two, where 3/4 of one set may still be as
    large as a set below the border.
    """
    n = (size.bit_length() - 1) // 2
    out = [(2 * n, 4 ** n, 4 ** (n + 1) - 1)]
    for border, number in ((4 ** n, 2 * n - 1), (4 ** (n + 1), 2 * n + 1)):
        low, high = -(-3 * border // 4), 4 * (border - 1) // 3
        if low <= size <= high:
            out.append((number, low, high))
    return out


def most_apart(size: int, most: int) -> int:
    """Largest symmetric difference of a set of ``size`` to any linked set of at most ``most``."""
    return (size + min(4 * size // 3, most)) // 7


def blocks_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Signatures of the filled blocks of a set for each of its bands; the band of each; (band, filled, wanted) of each
    band. ``wanted`` is how many of the rarest signatures must be joined, all of them where a band needed more blocks."""
    out, marks, wanted, size = [], [], [], len(codes)
    for number, _, most in schemes(size):
        bound, blocks, attempt, filled, total = most_apart(size, most), 1 + int(0.37 * most), 0, 0, 0
        while filled <= bound:
            seed = np.uint64((number * 64 + attempt) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            spread = mix(codes ^ seed)
            block = ((spread >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
            order = np.argsort(block, kind="stable")
            edge = np.flatnonzero(np.diff(block[order], prepend=np.uint64(1 << 63)))
            parity = np.bitwise_xor.reduceat(mix(spread + seed)[order], edge)
            out.append(mix(parity ^ mix(block[order][edge] + seed)))
            filled, blocks, attempt = len(edge), 2 * blocks, attempt + 1
            total += filled
            marks.append(np.full(filled, number + 1, np.uint8))
        wanted.append((number + 1, total, bound + 1 if attempt == 1 else total))
    return np.concatenate(out), np.concatenate(marks), wanted


def signatures(codes: np.ndarray) -> np.ndarray:
    return blocks_of(codes)[0]


def sketch_bits(size: int) -> int:
    """Bits of the sketch in which sets of about this size are compared; a power of two, at least four times the size."""
    return 1 << max(6, (4 * size - 1).bit_length())


def sketch(codes: np.ndarray, bits: int) -> bytes:
    """Bit i is the parity of the shingles that fall on it. A wider sketch folds into a narrower one by XOR."""
    at = (mix(codes + np.uint64(0x51)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").astype(np.uint8).tobytes()


def folded(sketch_: bytes, bits: int) -> np.ndarray:
    x = np.frombuffer(sketch_, np.uint8)
    while len(x) * 8 > bits:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def describe(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set, bit sketch, and packed (band, filled, wanted) of every row."""

    def start():
        def work(piece: Piece) -> Piece:
            sets = shingle_sets(piece["text"])
            return {"doc_id": piece["doc_id"], "n_shingles": list(map(len, sets)),
                    "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                    "sketch": [sketch(s, sketch_bits(len(s))) if len(s) else b"" for s in sets]}
        return work

    return map_pieces(df, "doc_id long, n_shingles long, digest binary, sketch binary", start)


def _signature_blocks(df: DataFrame, buckets: int) -> DataFrame:
    """bucket, signatures (32 bits beyond the bucket), documents (differences of ascending ids) and the band of each with its
    filled and wanted blocks, packed."""
    schema = "bucket int, signatures binary, documents binary, bands binary"
    out = arrow_type(schema)

    def packed(ids: list[int], found: list[tuple]) -> pa.RecordBatch:
        owner = np.repeat(np.array(ids, np.int64), [len(f[0]) for f in found])
        values, bands = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        # a set's bands come in runs, in the order of its list
        runs = [(np.count_nonzero(f[1] == band), filled, wanted) for f in found for band, filled, wanted in f[2]]
        limits = np.repeat(np.array([r[1:] for r in runs], np.uint64), [r[0] for r in runs], axis=0)
        bands = bands.astype(np.uint64) << np.uint64(56) | limits[:, 0] << np.uint64(28) | limits[:, 1]
        bucket = (values >> np.uint64(32)) % np.uint64(buckets)
        order = np.lexsort((owner, bucket))
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
        rows = []
        for b, (i, j) in enumerate(zip(edge[:-1], edge[1:])):
            if j > i:
                at = order[i:j]
                rows.append((b, values[at].astype("<u4").tobytes(), packed_numbers(np.diff(owner[at], prepend=0)),
                             packed_numbers(bands[at])))
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), out)], schema=out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, total, seen = [], [], 0, set()
        for piece in pieces(batches):
            for doc, codes in zip(piece.column(0).to_pylist(), shingle_sets(piece.column(1).to_pylist())):
                if doc is None or not len(codes):
                    continue
                digest = hashlib.blake2b(codes.tobytes(), digest_size=16).digest()
                if digest in seen:  # a copy: the first one of this task stands for it
                    continue
                seen.add(digest)
                ids.append(doc)
                found.append(blocks_of(codes))
                total += len(found[-1][0])
                if total >= FLUSH:
                    yield packed(ids, found)
                    ids, found, total = [], [], 0
        if ids:
            yield packed(ids, found)

    return map_arrow(df, run, schema)


def _shared(blocks: DataFrame) -> DataFrame:
    """grp, doc, band, filled, wanted and freq (documents of the group) of every signature that documents share."""
    schema = "grp long, doc long, band int, filled int, wanted int, freq int"
    out = arrow_type(schema)

    def of_bucket(bucket: int, parts: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        low = np.concatenate([np.frombuffer(p[0], "<u4") for p in parts])
        owner, limits = (np.concatenate([read(unpacked_numbers(p[i], len(p[0]) // 4)) for p in parts])
                         for i, read in ((1, lambda x: np.cumsum(x.view(np.int64))), (2, np.asarray)))
        band, filled, wanted = (limits >> np.uint64(56), limits >> np.uint64(28) & np.uint64((1 << 28) - 1),
                                limits & np.uint64((1 << 28) - 1))
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        at = order[np.append(same, False) | np.insert(same, 0, False)]
        at = at[np.lexsort((owner[at], low[at]))]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (low[at][1:] != low[at][:-1]) | (owner[at][1:] != owner[at][:-1])
        at = at[fresh]
        edge = np.flatnonzero(np.diff(low[at].astype(np.int64), prepend=-1))
        freq = np.diff(np.append(edge, len(at)))
        freq = np.repeat(freq, freq)
        at, freq = at[freq > 1], freq[freq > 1]
        columns = ((np.int64(bucket) << np.int64(32)) | low[at].astype(np.int64), owner[at], band[at], filled[at], wanted[at], freq)
        return pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, out)], schema=out)

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

    return map_arrow(blocks, run, schema)


def _kept(shared: DataFrame) -> DataFrame:
    """grp and doc of the memberships that must be joined.

    A linked pair shares at least filled - wanted + 1 signatures of a band, so each document may leave out filled -
    wanted of them. It leaves out those of the largest groups; the order is the same for all, so the smallest group that
    a pair shares stays for both. Signatures of a single document count as kept first: a document with enough of them
    links with none and drops out.
    """
    mine = Window.partitionBy("doc", "band")
    ranked = (shared.withColumn("nth", F.row_number().over(mine.orderBy("freq", "grp")))
              .withColumn("alone", F.col("filled") - F.count("*").over(mine)))
    return ranked.where("nth <= wanted - alone").select("grp", "doc")


def _centered(kept: DataFrame) -> DataFrame:
    """grp, doc, center (least document) and n of the groups of two or more; of groups with the same documents one stays."""
    per = kept.groupBy("grp").agg(F.min("doc").alias("center"), F.count("*").alias("n"),
                                  F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("all")).where("n > 1")
    once = per.groupBy("center", "n", "all").agg(F.min("grp").alias("grp")).drop("all")
    return kept.join(once, "grp")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b and whether they link, by their texts.

    Each pair carries one text; the other is sent once to every place that needs it. A document with many pairs is
    split over places of ``SALTED`` pairs on average.
    """
    per = pairs.groupBy("a").agg(F.count("*").alias("n"))
    placed = (pairs.join(per.select("a", F.ceil(F.col("n") / SALTED).alias("salts")), "a")
              .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts"))))
    near = placed.join(docs.select(F.col("doc_id").alias("b"), "text"), "b").select("a", "salt", "b", "text")
    ends = placed.select("a", "salt").distinct().join(docs.select(F.col("doc_id").alias("a"), "text"), "a")
    rows = (near.unionByName(ends.select("a", "salt", F.lit(None).cast("long").alias("b"), "text"))
            .repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()))
    schema = "a long, b long, linked boolean"
    out = arrow_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ends = None, []
        for piece in pieces(batches):
            made = []
            a, salt, b, text = (c.to_pylist() for c in piece.columns)
            for i, codes in enumerate(shingle_sets(text)):
                if (a[i], salt[i]) != here:
                    here, ends = (a[i], salt[i]), []
                if b[i] is None:
                    ends.append(codes)
                else:
                    made.append((a[i], b[i], any(linked(codes, e) for e in ends)))
            yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], type=f.type) for k, f in enumerate(out)], schema=out)

    return map_arrow(rows, run, schema).groupBy("a", "b").agg(F.max("linked").alias("linked"))


def _with_sketches(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """a, b and whether sizes and bit sketches allow a link. A sketch's distance never exceeds that of the sets."""
    one = known.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("size_a"), F.col("sketch").alias("sketch_a"))
    two = known.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("size_b"), F.col("sketch").alias("sketch_b"))
    schema = "a long, b long, possible boolean"
    out = arrow_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            made = []
            for a, b, m, n, x, y in zip(*(c.to_pylist() for c in piece.columns)):
                bits = 8 * min(len(x), len(y))
                ok = 4 * m >= 3 * n and 4 * n >= 3 * m
                made.append(ok and int(np.bitwise_count(folded(x, bits) ^ folded(y, bits)).sum()) <= (m + n) // 7)
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(made, pa.bool_())], schema=out)

    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")
    return map_arrow(rows, run, schema).groupBy("a", "b").agg(F.max("possible").alias("possible"))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component."""
    a, b = (found.select(F.col("node").alias(c), F.col("component").alias(f"component_{c}")) for c in "ab")
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("component_a", "a") != F.coalesce("component_b", "b")).select(*pairs.columns))


def _texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Texts of the documents in ``pairs``; a list of at most ``SENT_IDS`` ids is broadcast, a longer one is joined."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    return stage(docs.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, "doc_id", "left_semi"), "texts")


def _left_over(groups: DataFrame, joined: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct (a, b) that share a group whose documents are not all connected, are not connected themselves, and whose
    bit sketches and sizes allow a link.

    Groups with one center hold much the same documents (those around one passage), so they are taken together: a document
    travels once for each center, and a pair is compared once for it. Documents that are not connected to the center are
    compared with all others. Both sides are dealt out in parts of about ``CHUNK``, so no place holds a whole large group.
    """
    component = joined.select(F.col("node").alias("doc"), "component")
    center = joined.select(F.col("node").alias("grp"), F.col("component").alias("of_center"))
    members = groups.where("n > 2").select(F.col("center").alias("grp"), "doc").distinct()
    sizes = members.groupBy("grp").agg(F.count("*").alias("n"))
    rows = (members.join(sizes, "grp").join(component, "doc", "left").join(center, "grp", "left")
            .select("grp", "doc", "n", F.coalesce("component", "doc").alias("component"),
                    (F.coalesce("component", "doc") != F.coalesce("of_center", "grp")).alias("loose")))
    open_ = rows.groupBy("grp").agg(F.count_if("loose").alias("n_loose")).where("n_loose > 0")
    rows = (rows.join(open_, "grp").join(known.withColumnRenamed("doc_id", "doc"), "doc")
            .withColumns({"parts": F.ceil(F.col("n") / CHUNK).cast("int"), "loose_parts": F.ceil(F.col("n_loose") / CHUNK).cast("int")}))
    every = rows.withColumns({"x": F.pmod(F.xxhash64("doc"), "parts").cast("int"),
                              "y": F.explode(F.sequence(F.lit(0), F.col("loose_parts") - 1)), "fresh": F.lit(False)})
    fresh = rows.where("loose").withColumns({"x": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)),
                                             "y": F.pmod(F.xxhash64("doc"), "loose_parts").cast("int"), "fresh": F.lit(True)})
    columns = ["grp", "x", "y", "doc", "fresh", "n_shingles", "sketch", "component"]

    schema = "a long, b long"
    out = arrow_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for *now, doc, new, size, bits, component_ in zip(*(c.to_pylist() for c in batch.columns)):
                if now != key:
                    found |= near(rows)
                    key, rows = now, []
                rows.append((doc, new, size, bits, component_))
            yield packed(found)
        yield packed(near(rows))

    def packed(found: set[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], schema=out)

    width_ = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (every.select(*columns).unionByName(fresh.select(*columns)).repartition(width_, "grp", "x", "y")
             .sortWithinPartitions("grp", "x", "y"))
    return map_arrow(dealt, run, schema).distinct()


def _narrowed(sketches: np.ndarray, words: int) -> np.ndarray:
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def near(rows: list[tuple]) -> set[tuple[int, int]]:
    """Pairs of a fresh and another row, of (doc, fresh, size, sketch, component), whose sizes and sketches allow a link."""
    sides: dict[tuple[bool, int], list[tuple]] = {}
    for row in rows:
        sides.setdefault((row[1], len(row[3])), []).append(row)

    def columns(rows_: list[tuple]) -> tuple[np.ndarray, ...]:
        doc, size, part = (np.array([r[i] for r in rows_], np.int64) for i in (0, 2, 4))
        return doc, size, part, np.frombuffer(b"".join(r[3] for r in rows_), "<u8").reshape(len(rows_), -1)

    read, found = {k: columns(v) for k, v in sides.items()}, set()
    for (new, wide), (doc, size, part, bits) in read.items():
        for (fresh, other), (doc_, size_, part_, bits_) in read.items():
            if not new or fresh or wide > 2 * other or other > 2 * wide:  # sizes apart too far to link
                continue
            words = min(wide, other) // 8
            right = _narrowed(bits_, words)
            for at in range(0, len(doc), ROWS):
                to = slice(at, at + ROWS)
                left, n = _narrowed(bits[to], words), size[to, None]
                apart = np.zeros((len(left), len(right)), np.int32)
                for w in range(words):
                    apart += np.bitwise_count(left[:, w, None] ^ right[None, :, w])
                fits = (apart <= (n + size_) // 7) & (4 * n >= 3 * size_) & (4 * size_ >= 3 * n) & (part[to, None] != part_)
                for i, j in np.argwhere(fits).tolist():
                    a, b = int(doc[at + i]), int(doc_[j])
                    found.add((a, b) if a < b else (b, a))
    return found


def links(docs: DataFrame, info: DataFrame) -> DataFrame:
    """a, b: links between documents (stand-ins of their classes) that connect all that link by different sets."""
    spark = docs.sparkSession
    width = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # signatures outweigh the rest
    blocks = _signature_blocks(docs, width).repartition(width, "bucket").sortWithinPartitions("bucket")
    shared = stage(_shared(blocks), "shared")  # so the shuffled blocks, which outweigh it, are gone before the next shuffle
    kept = stage(_kept(shared), "kept")
    unstage(shared)
    groups = stage(_centered(kept), "groups")
    unstage(kept)
    known = info.select("doc_id", "n_shingles", "sketch").dropDuplicates(["doc_id", "sketch"])
    pairs = groups.where("doc <> center").select(F.col("center").alias("a"), F.col("doc").alias("b")).distinct()
    possible = stage(_with_sketches(pairs, known).where("possible").select("a", "b"), "possible")
    texts = _texts_of(docs, possible)
    # one link for each document; then what these have not connected; then groups that are still not connected
    first = stage(_verified(possible.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), texts).where("linked"), "first")
    near_first = components(first)
    rest = stage(_apart(possible, near_first).join(first, ["a", "b"], "left_anti"), "rest")
    sure = stage(first.unionByName(_verified(rest, texts).where("linked")).select("a", "b"), "sure")
    unstage(possible, texts, first, near_first)
    near_sure = components(sure)
    more = stage(_left_over(groups, near_sure, known).join(rest, ["a", "b"], "left_anti"), "left_over")
    unstage(groups, rest, near_sure)
    return sure.unionByName(_verified(more, _texts_of(docs, more)).where("linked").select("a", "b"))


def join(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    with scope(df.sparkSession) as keep:
        info = stage(describe(docs), "described")
        named = info.where("n_shingles > 0 and doc_id is not null")
        copies = named.groupBy("digest").agg(F.min("doc_id").alias("rep"))
        same = named.join(copies, "digest").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        found = components(links(docs, info).unionByName(same))
        return keep(info.join(found, info.doc_id == found.node, "left")
                    .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")), "joined")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows, with all their columns, of the least document of each component.

    That is one row of each where ids are unique and not null. All rows with the least id stay where it repeats, whatever
    their texts, and so do all rows with a null id, exact copies included, and rows that cannot link.
    """
    found = join(df, doc_id, text).where("doc_id <> component_id").select("doc_id").distinct()
    return df.join(found.withColumnRenamed("doc_id", doc_id), doc_id, "left_anti").select(*df.columns)
