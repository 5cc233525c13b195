"""Whitening, collocations and quality scores against brute force, and on the odd cases their docstrings define."""

import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
from millrace.llm import collocations, quality_classifier, whitening

FOLDER = "/root/testdata/sf0.001"


# whitening

def vectors(spark, rows, extra=()):
    kind = "vec_id long, embedding array<double>" + "".join(f", {c} long" for c in extra)
    return spark.createDataFrame([(*r, *(0 for _ in extra)) for r in rows], kind).repartition(3)


def check_whitening(rows, found, components=32):
    x = np.floor(64 * np.array([r[1] for r in rows])).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = np.array([[float(Fraction(int(n * v - t), n)) for v, t in zip(row, s)] for row in x])
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1], turned[:, ::-1]
    kept = min(components, int((values > 1e-13 * values[0]).sum()))
    got = {(r["vec_id"], r["component"]): r for r in found}
    assert len(found) == len(got) == n * kept
    want = centred @ turned[:, :kept] / np.sqrt(values[:kept])
    mine = np.array([[got[r[0], j + 1]["whitened"] for j in range(kept)] for r in rows])
    assert np.abs(mine - want * np.sign((mine * want).sum(axis=0))).max() < 1e-6
    for i, (name, _) in enumerate(rows):
        one = got[name, 1]
        assert one["n"] == n and one["identity_error"] < 1e-8
        assert one["deviation"] == sum((n * int(v) - int(t)) ** 2 for v, t in zip(x[i], s)) == int(one["deviation_exact"])
    for j in range(kept):
        assert got[rows[0][0], j + 1]["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-6)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(1)
    turn = rng.normal(size=(40, 40)) * (1.3 ** -np.arange(40) * 500)[:, None]  # variances far apart, and 40 > 32
    rows = [(i, (rng.normal(size=40) @ turn + 7).tolist()) for i in range(300)]
    df = vectors(spark, rows)
    check_whitening(rows, whitening.whiten(df, whitening.fit(df)).collect())


def test_whitening_of_fewer_rows_than_entries_and_of_dependent_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [*a, *a, a[0] + a[1], 5.0]) for i, a in enumerate(rng.integers(-50, 50, (20, 4)).astype(float).tolist())]
    for some in (rows, rows[:3]):
        df = vectors(spark, some)
        check_whitening(some, whitening.whiten(df, whitening.fit(df)).collect())


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(50)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [1.0, float("inf"), 2.0]), (104, []),
           (105, [1.0, 2.0]), (106, [1e20, 0.0, 0.0])]
    df = vectors(spark, rows + odd, ["n", "component", "vector"])
    check_whitening(rows, whitening.whiten(df, whitening.fit(df)).collect())
    twice = vectors(spark, rows + rows + [(None, [0.5, 0.5, 0.5])])
    found = whitening.whiten(twice, whitening.fit(twice)).collect()
    assert Counter(r["vec_id"] for r in found)[3] == 6 and Counter(r["vec_id"] for r in found)[None] == 3
    for none in (df.limit(0), vectors(spark, [(1, [2.0, 3.0])] * 4), vectors(spark, odd[:5])):
        assert whitening.whiten(none, whitening.fit(none)).collect() == []


def test_deviation_beyond_64_bits(spark):
    rows = [(0, [2.0 ** 40, 0.0]), (1, [0.0, 1.0]), (2, [-(2.0 ** 40), 3.0])]
    df = vectors(spark, rows)
    found = {r["vec_id"]: r for r in whitening.whiten(df, whitening.fit(df)).where("component = 1").collect()}
    x = [[int(64 * v) + 1_000_000 for v in r[1]] for r in rows]
    for i in range(3):
        assert int(found[i]["deviation_exact"]) == sum((3 * x[i][k] - sum(r[k] for r in x)) ** 2 for k in (0, 1))
    assert found[0]["deviation"] is None


def test_division_by_factor():
    rng = np.random.default_rng(4)
    factor = np.triu(rng.normal(size=(70, 70))) + 5 * np.eye(70)
    rows = rng.normal(size=(9, 70))
    assert np.allclose(whitening.divided(rows, factor) @ factor, rows)


# collocations

def plain_counts(rows, longest):
    n, f = Counter(), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", " ".join(words[i:i + k])] += 1
    return n, f


def plain_mine(rows, longest=3, least=10, top=2000, share=50):
    n, f = plain_counts(rows, longest)
    candidates = {p: a for p, a in f.items() if a >= least and " " in p[1]}
    longer = Counter()
    for (lang, phrase), a in candidates.items():
        w = phrase.split(" ")
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                part = lang, " ".join(w[i:i + k])
                longer[part] = max(longer[part], a)
    out = []
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) in longer and 100 * longer[lang, phrase] >= share * a:
            continue
        w = phrase.split(" ")
        parts = [(f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]) for k in range(1, len(w))]
        score, k = min((1_000_000 * a * a // (l * r), k) for k, (l, r) in enumerate(parts))
        out.append((lang, -score, -a, phrase.encode(), phrase, a, *parts[k], n[lang], score))
    out.sort()
    rank = Counter()
    for row in out:
        rank[row[0]] += 1
        if rank[row[0]] <= top:
            yield (row[0], rank[row[0]], *row[4:])


def some_texts(seed, docs, words):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cc", "Dé", "漢字", "the", "e\x0bf", "g\xa0h", "0", "É"][:words]
    passage = "the cc a B the the 漢字 a cc the B a a a cc"
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n"])
                       for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice([text, text + passage, passage, text]), rng.choice(["en", "de", None, "und", "en"])))
    return rows + [(None, "en"), ("", None), (" ,.\n", "de"), ("a " * 5000, "en"), (passage * 40, None)]


@pytest.mark.parametrize("longest, trigger", [(3, 16), (3, 2), (2, 1), (4, 3)])
def test_chunks_count_every_phrase_once(longest, trigger):
    rows = some_texts(longest, 80, 10)
    table = collocations.parse(pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), longest, trigger)
    found = Counter()
    for chunk in table.to_pylist():
        w = chunk["chunk"].split(" ")
        starts = len(w) if chunk["last"] else len(w) - longest + 1
        for k in range(1, longest + 1):
            for i in range(min(starts, len(w) - k + 1)):
                found[chunk["lang"], " ".join(w[i:i + k])] += chunk["freq"]
    assert found == plain_counts(rows, longest)[1]


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"least": 3, "longest": 4}), (3, {"top": 5, "share": 90})])
def test_collocations_equal_plain_count(spark, seed, options):
    rows = some_texts(seed, 200, 10)
    df = spark.createDataFrame([(i % 7 or None, *r, "x", 1) for i, r in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n long").repartition(5)
    assert sorted(tuple(r) for r in collocations.mine(df, **options).collect()) == sorted(plain_mine(rows, **options))


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([(1, None, "en"), (2, " . ", None)], "doc_id long, text string, lang string")
    assert collocations.mine(df).collect() == [] and collocations.mine(df.limit(0)).collect() == []


def test_small_pieces_and_shared_codes(spark, monkeypatch):
    """Buckets, groups and codes so small that phrases share codes and groups span batches."""
    rows = some_texts(9, 150, 10)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    for name, value in (("PIECE", 300), ("BUCKET_CODES", 50), ("SPARE_BITS", 0)):
        monkeypatch.setattr(collocations, name, value)
    assert sorted(tuple(r) for r in collocations.mine(df, least=4).collect()) == sorted(plain_mine(rows, least=4))


def test_collocation_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    out = driver.queries()["op12_prefix_free_collocations"](spark, FOLDER)
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({driver.oracle_sql()['op12_prefix_free_collocations']})").fetchall()
    assert len(want) and sorted(tuple(r) for r in out.collect()) == sorted(want)


# quality

def number_of_features(text):
    """Words, pairs of words and n-grams of words with both edges, by plain loops."""
    words = [w for w in "".join(c if c >= "!" else " " for c in text or "").split(" ") if w]
    return (len(words) + max(0, len(words) - 1)
            + sum(max(0, len(w) + 2 - k + 1) for w in words for k in (3, 4, 5)))


def test_features_are_counted_and_do_not_depend_on_neighbours():
    texts = ["ab c", None, "", "Ünï 漢字x a", "\t\n", "hello world", "word " * 50, "x" * 5000]
    for order in (texts, texts[::-1], texts[3:]):
        at, of = quality_classifier.features(order)
        for i, text in enumerate(order):
            alone = quality_classifier.features([text])[0]
            assert (of == i).sum() == number_of_features(text)
            assert Counter(at[of == i].tolist()) == Counter(alone.tolist())
    once, wide = (quality_classifier.features([t])[0] for t in ("ab c", "ab  c"))
    assert Counter(once.tolist()) == Counter(wide.tolist())


def labelled(spark, n=400):
    rng = random.Random(5)
    good = ["the river runs to the sea", "a quiet morning in the valley", "she wrote about old maps"]
    bad = ["CLICK HERE NOW!!", "win $$$ free $$$", "best price best price"]
    rows, labels = [], []
    for i in range(n):
        label = i % 2
        rows.append((i, " ".join(rng.choice(good if label else bad) for _ in range(rng.randint(1, 20)))))
        labels.append((i, label))
    return (spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_quality_learns_and_ignores_held_out_labels(spark):
    docs, labels = labelled(spark)
    model = quality_classifier.fit(docs, labels)
    found = {r["doc_id"]: r for r in quality_classifier.score(docs, model).collect()}
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(found[i]["predicted"] == i % 2 for i in held) >= 0.95 * len(held)
    wrong = labels.withColumn("quality", quality_classifier.F.when(quality_classifier.held_out(), 1 - quality_classifier.F.col("quality"))
                              .otherwise(quality_classifier.F.col("quality")))
    again = quality_classifier.fit(docs, wrong)
    assert (again["weight"] == model["weight"]).all() and again["offset"] == model["offset"]
    few = quality_classifier.fit(docs, labels, limit=300)
    assert few["offset"] != model["offset"]


def test_quality_odd_rows(spark):
    docs, labels = labelled(spark, 60)
    model = quality_classifier.fit(docs, labels.unionByName(spark.createDataFrame(
        [(None, 1), (3, None), (5, 7), (4, 1)], "doc_id long, quality int")))
    odd = spark.createDataFrame([(1, None, 5.0), (2, "", None), (None, "x" * 50_000, 0.1), (3, "a", 1.0), (3, "a", 1.0), (4, "word " * 9000, 0.0)],
                                "doc_id long, text string, score double")
    found = quality_classifier.score(odd, model).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    empty = {r["score"] for r in found if r["doc_id"] in (1, 2)}
    assert len(empty) == 1
    none = quality_classifier.fit(docs, labels.limit(0))
    assert {(r["score"], r["predicted"]) for r in quality_classifier.score(odd, none).collect()} == {(0.5, 1)}
    assert quality_classifier.score(odd.limit(0), model).collect() == []


def test_quality_query_on_held_out_labels(spark):
    import pandas as pd
    folder = "/root/testdata/sf0.01"
    found = driver.queries()["op13_subword_quality"](spark, folder).toPandas()
    assert len(found) == len(pd.read_parquet(f"{folder}/documents.parquet"))
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]).all()
    both = found.merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    both = both[both["held_out"]]
    assert (both["predicted"] == both["quality"]).mean() > 0.95


def test_phrase_keys_are_exact_where_they_do_not_fit():
    rng = np.random.default_rng(2)
    key, number = rng.integers(0, 5, 4000), rng.integers(0, 90, 4000)
    want = np.unique(key * 90 + number, return_inverse=True)[1]
    for below in (5, 1 << 62):
        longer, span = collocations._longer(key, below, number, 90)
        assert (np.unique(longer, return_inverse=True)[1] == want).all() and span < 1 << 63 and longer.max() < span
