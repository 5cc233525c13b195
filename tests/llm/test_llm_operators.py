"""Each language-data operator against a brute-force version, and on the odd cases its docstring defines."""

import gzip
import hashlib
import io
import itertools
import random
import re
import struct
import tracemalloc
from html import unescape

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import (boosting, bpe, bwt, decontaminate, html_text, jaccard, langid, pii, quality, secret_scan,
                          suffix, warc)
from millrace.llm.arrow import map_arrow
from millrace.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t", "a", "Ünïcödé 漢字 😀", "x" * 30_000, "word " * 5000]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def odd_rows(spark):
    """Null ids, repeated rows, odd texts, and extra columns named like results."""
    rows = [(i, t, "extra", i) for i, t in enumerate(ODD)] + [(3, "a", "extra", 3), (None, "a b c d e f", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, n_words long").repartition(3)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# personal data

def plain_pii(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            n = len(re.sub("[^0-9]", "", m[0]))
            if kind == 3 and 9 <= n <= 15 or kind == 2 and 12 <= n <= 19 and pii.luhn(re.sub("[^0-9]", "", m[0])):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_plain_search():
    rng = random.Random(1)
    bits = ["1", "22", "255", "256", ".", ".", "@", "a", "b.c", "+", "-", " ", "(", ")", "com", "%", "é", "0000",
            "4111111111111111"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_pii(text), text


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@a" * 100_000, "+1" + " " * 200_000):
        pii.base_spans(text)
        pii.candidates(text)


def test_pii_rows_and_redaction(spark):
    texts = [f"mail bob.{i}@mail{i}.example.com or +1 ({200 + i}) 555-{1000 + i} card 4111111111111111 ip 10.0.{i}.7" for i in range(90)]
    texts += ["call (415) 555-1234 now", "card 4111/1111/1111/1111", "version 1.2.3", "nothing here"]
    df = frame(spark, list(enumerate(texts)))
    detector = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    got = by_id(pii.find(df, detector), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for i, text in enumerate(texts):
        base = plain_pii(text)
        assert got[i][:4] == tuple(sum(s[1] == k for s in base) for k in range(4))
        joined = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert got[i][4] == sha(",".join(joined)) and set(joined) <= set(got[i][5].split(","))
    assert got[90][5] == "phone:5:19"  # a span that the base rules do not know
    assert got[92][5] == got[93][5] == ""
    clean = by_id(pii.redact(df, detector), "text")
    assert clean[0][0] == "mail <EMAIL> or <PHONE> card <CARD> ip <IP>" and clean[93][0] == "nothing here"


def test_numbers_are_proposed_with_and_without_their_neighbours():
    def proposed(text):
        return {(pii.KINDS[k], text[a:b]) for a, k, b in pii.candidates(text)}
    assert ("phone", "(555) 123-4567") in proposed("2024-01-15 (555) 123-4567")
    assert ("card", "4111.1111.1111.1111") in proposed("2024-01-15 4111.1111.1111.1111")
    assert {("card", "4111111111111111"), ("card", "12 4111111111111111")} <= proposed("12 4111111111111111 7")
    assert ("ip", "10 . 0 . 0 . 7") in proposed("at 12, 10 . 0 . 0 . 7")
    assert ("email", "me.bob (at) example (dot) com") in proposed("look at me.bob (at) example (dot) com")
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["1", "22", "333", "4444", "55555555", " ", "-", ".", "(", ") ", "/", "x"]) for _ in range(16))
        groups = [m.span() for m in re.finditer("[0-9]+", text)]
        runs = [(a, b) for i, (a, _) in enumerate(groups) for _, b in groups[i:]
                if 11 <= sum(map(str.isdigit, text[a:b])) <= 20 and re.fullmatch(r"[0-9]+(?:[ ./_-]{1,2}[0-9]+)*", text[a:b])]
        assert sorted(runs) == sorted((a, b) for a, k, b in pii.candidates(text) if k == 2), text


def test_personal_data_beside_other_numbers_is_found(spark):
    detector = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for text, hidden in (("2024-01-15 (555) 123-4567", "2024-01-15 <PHONE>"),
                         ("2024-01-15 4111.1111.1111.1111", "2024-01-15 <CARD>"),
                         ("a (555) 123-4567 (555) 123-4568 b", "a <PHONE> <PHONE> b"),
                         ("on 2024-01-15 at 10:22", "on 2024-01-15 at 10:22")):
        assert pii.redacted(text, detector(text)[1]) == hidden
    many = "1." * 20_000 + " (555) 123-4567"
    assert pii.redacted(many, detector(many)[1]).endswith(" <PHONE>")


def test_written_addresses_need_no_other_at_sign(spark):
    detector = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    for text, hidden in (("write to john (at) example.com", "write to <EMAIL>"),
                         ("write to john [at] example.com today", "write to <EMAIL> today"),
                         ("look at me.bob now", "look at me.bob now"),
                         ("we met at noon.then at home", "we met at noon.then at home")):
        assert pii.redacted(text, detector(text)[1]) == hidden
    assert (9, 0, 28) in pii.candidates("write to john at example.com")


def test_pii_odd(spark):
    df = odd_rows(spark)
    detector = pii.fit(df)
    out = pii.find(df, detector)
    assert out.count() == df.count() and {r.spans for r in out.collect()} == {""}
    assert pii.redact(df, detector).columns == df.columns
    none = df.limit(0)
    assert pii.find(none, pii.fit(none)).count() == 0


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    held = np.arange(3000) % 3 == 0
    p = boosting.fit(x, y, held).probabilities(x[held])
    assert ((p > 0.5) == y[held]).mean() > 0.97 and p.min() >= 0 and p.max() <= 1


# quality

def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit), failed


def test_quality_counts_and_order_does_not_matter(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))).replace("b a", "b\na") for _ in range(80)]
    texts += ["good words all over the place and none of them said twice in a row here, " * 1 + " ".join(f"w{i}x" for i in range(40)),
              "THIS IS " + " ".join(f"LOUD{chr(65 + i)}!!" for i in range(25)), "# | " * 30, *[t for t in ODD[:5]]]
    df = frame(spark, list(enumerate(texts)))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = by_id(quality.judge(df), *columns, "kept")
    for i, text in enumerate(texts):
        assert got[i][:6] == plain_quality(text), i
        assert not (got[i][5] and got[i][6])
    assert got[80][6] and not got[81][6] and not got[82][6]
    assert got == by_id(quality.judge(df, rules=quality.RULES[::-1]), *columns, "kept")
    assert sorted(r.name for r in quality.measure(df)) == sorted(r.name for r in quality.RULES)
    assert quality.judge(odd_rows(spark)).count() == len(ODD) + 2
    assert quality.judge(df.limit(0)).count() == 0


# html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site, top.</header>
<nav><ul><li><a href="/a">Menu, one</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, yes. Do you agree, too?</p></div>
<div class="page with-sidebar"><div class="sidebar"><p>Side, text. Here.</p></div><div class="story"><h2>A &amp; B</h2>
<p>The first  paragraph,<br>with &lt;marks&gt;, and more.<p>Second one, with <b>bold</b> words, too. And a tail.
<script>var x = "<p>no</p>";</script><!-- <p>hidden</p> --><p>Short</p></div>
<div id="comments"><p>Nice, very nice post, I like it. Really, I do.</p></div></div><form><p>Write, to us.</p></form>
<footer>End, of page.</footer></body></html>"""


def test_html_main_text():
    assert html_text.main_text(PAGE) == (
        "A & B\nThe first paragraph, with <marks>, and more.\nSecond one, with bold words, too. And a tail.\nShort")
    assert html_text.main_text("<p>one<p>two &amp three <!-- open") == "one\ntwo & three"
    assert html_text.main_text("plain < text") == "plain < text"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""


def test_html_keeps_content_outside_the_largest_element():
    words = "Many words of a story, told at length. " * 5
    linked = f"{words}See <a href='/x'>here</a>, or <em>there</em>."
    plain = " ".join(re.sub("<[^>]*>", "", linked).split())
    assert html_text.main_text(f"<body><p>{linked}</p><p>{linked}</p></body>") == f"{plain}\n{plain}"
    story, one = f"<p>{words}</p>" * 30, " ".join(words.split())
    page = f"<div><div><p>{words}</p></div><div>{story}</div><div><h2>Last part</h2><p>{linked}</p></div></div>"
    assert html_text.main_text(page) == "\n".join([one] * 31 + ["Last part", plain])
    page = f"<article><h2>First</h2>{story}</article><article><h2>Second</h2><p>{words}</p><p>End</p></article>"
    assert html_text.main_text(page) == "\n".join(["First"] + [one] * 30 + ["Second", one, "End"])
    page = f"<div>{story}</div><main><p>{words}</p></main>"  # a small main does not win over the story
    assert html_text.main_text(page) == "\n".join([one] * 31)


def test_html_ids_and_unclosed_tags_do_not_cut_the_article():
    words = "Many words of a story, told at length. " * 5
    story, one = f"<p>{words}</p>" * 4, " ".join(words.split())
    page = (f"<article>{story}<h2 id='related-work'>Related</h2><p id='notice-of-meeting'>{words}</p>"
            f"<section id='social-impact'><h2>Impact</h2><p>{words}</p></section><h2 id='responses'>Responses</h2>"
            f"<div class='comments'><p>{words}</p></div><p>End</p></article>")
    assert html_text.main_text(page) == "\n".join([one] * 4 + ["Related", one, "Impact", one, "Responses", "End"])
    page = f"<div>{story}<div id='social-impact'><p>{words}</p></div><div id='skip-links'><a>Up</a> <a>Down</a></div></div>"
    assert html_text.main_text(page) == "\n".join([one] * 5)
    page = f"<article>{story}<p>{words}So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>"
    assert html_text.main_text(page).endswith("told at length. So x=1 holds.")
    for tag in ("<svg><path d=''>", "<select>", "<select><option>a<option>b", "<math>"):
        for after in ("", "<svg></svg><select><option>c</option></select>"):
            page = f"<article>{story}<p>{words}{tag}</p>{story}{after}<p>End</p></article>"
            assert html_text.main_text(page) == "\n".join([one] * 9 + ["End"]), tag
    assert html_text.main_text("a <select><option>x<option>y</select> b <svg><text>z</text></svg>c") == "a b c"


def test_html_classes_of_several_words_do_not_cut_the_article():
    words = "Many words of a story, told at length. " * 5
    story, one = f"<p>{words}</p>" * 4, " ".join(words.split())
    for name in ("social-impact", "share-prices", "menu-engineering", "promoted-officers", "related-work",
                 "notice-of-meeting", "row notice"):
        for head in ("", "<h2>Part</h2>"):
            page = f"<article>{story}<section class='{name}'>{head}<p>{words}</p></section><p>End</p></article>"
            assert html_text.main_text(page) == "\n".join([one] * 4 + ["Part"] * bool(head) + [one, "End"]), name
    for name in ("comments", "ad", "comments-area", "related-posts", "sidebar widget", "share-buttons"):
        page = f"<article>{story}<div class='{name}'><h3>More</h3><p>{words}</p></div><p>End</p></article>"
        assert html_text.main_text(page) == "\n".join([one] * 4 + ["End"]), name
    page = f"<div class='notice-board'><p>{words}</p></div><article>{story}</article><div class='left-sidebar'><p>{words}</p></div>"
    assert html_text.main_text(page) == "\n".join([one] * 4)  # outside the article such classes mark as before


def test_html_articles_of_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in html_text.extract(pages).collect():
        article = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<br>|</?b>", lambda m: " " * (m[0] == "<br>"), b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>" * 3000, "y"), (1, None, None, "x")],
                                "page_id long, url string, html string, text string")
    assert {r.text for r in html_text.extract(odd).collect()} == {""}
    assert html_text.extract(odd.limit(0)).count() == 0


# tokens

@pytest.fixture(scope="module")
def machine():
    return bpe.Automaton(*bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))


def test_compiled_vocabulary_is_small():
    """Every task holds one, beside the others of its executor."""
    parts = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    tracemalloc.start()
    try:
        machine = bpe.Automaton(*parts)
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert machine.decode(machine.encode(["a token"])[0]) == "a token" and held < 36_000_000


def test_automaton_equals_library(machine):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    bits = ["a", "aa", "e", "the", " ", "  ", "\n", "1", "12", "é", "日本", "😀", "'s", "'", "<|endoftext|>", "<|endof",
            "\x1c", "\x85", "\xa0", "-", "==", "\t", "A", "ZZ", "՘", "ing", "tion", "\x00"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + [t or "" for t in ODD]
    made = machine.encode(texts)
    for text, ids, expected in zip(texts, made, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids, text
        assert machine.decode(ids) == library.decode(expected.ids, skip_special_tokens=False)


def test_table_is_filled_batch_by_batch(machine):
    """All transitions that a byte of many words lacks are found together, and starting anew changes nothing."""
    parts = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    small, calls = bpe.Automaton(*parts), []
    step = small._step
    small._step = lambda cells: (calls.append(len(cells)), step(cells))
    rng = random.Random(5)
    words = list({"".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))).encode() for _ in range(3000)})
    first = small.run(words)
    assert len(calls) <= max(map(len, words)) and sum(calls) > 1000
    small._forget()
    assert small.run(words) == first == [machine.encode([w.decode()])[0] for w in words]


def test_ascii_text_is_split_as_any_other(machine):
    for text in map("".join, itertools.product([*"a1' \t\r\x1c.", "'ll"], repeat=5)):
        assert machine._split(text) == machine.split.findall(text), repr(text)


def test_batches_are_bounded_by_bytes(spark):
    """A batch of long texts holds some MB in the JVM and in the worker, whatever its number of rows."""
    long_ = spark.range(0, 64, 1, 1).select(F.repeat(F.lit("x"), 1_000_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    assert max(r.n for r in map_arrow(long_, sizes, "n long").collect()) < 8_000_000


def test_bpe_rows(spark):
    path, df = public_tokenizers.path("byte_bpe_50k.json"), odd_rows(spark)
    library = Tokenizer.from_file(path)
    for r in bpe.digests(df.where("doc_id is not null"), path).collect():
        ids = library.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)))
        assert r.decoded_sha256 == sha(ODD[r.doc_id] or "")
    back = bpe.decode(bpe.encode(df, path), path)
    assert sorted(r.text for r in back.collect()) == sorted(r.text or "" for r in df.collect())


# near duplicates

def plain_components(rows):
    sets = {}
    for i, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def copies(seed, n):
    rng, words, rows = random.Random(seed), [f"w{i}" for i in range(300)], []
    passage = [rng.choice(words) for _ in range(60)]
    while len(rows) < n:
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 10, 20, 40, 80, 150, 300]))]
        base = passage + base if rng.random() < 0.5 else base
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 8])):
                if rng.random() < 0.5:
                    w.insert(rng.randrange(len(w) + 1), rng.choice(words))
                else:
                    w = w + [rng.choice(words) for _ in range(len(w) // 12)]
            rows.append((len(rows), " ".join(w)))
    return rows


def test_jaccard_join_equals_all_pairs(spark):
    rows = copies(1, 220)
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \n", "Same", "same ", "x " * 20_000])]
    plain = plain_components(rows)
    assert by_id(jaccard.join(frame(spark, rows)), "n_shingles", "component_id") == plain
    kept = jaccard.keep_one(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in plain.items() if i == c)


def test_jaccard_odd(spark):
    df = odd_rows(spark)
    out = jaccard.join(df).collect()
    assert len(out) == df.count()
    assert {(r.doc_id, r.component_id) for r in out} == {(i, i) for i in range(len(ODD))} | {(None, None)}
    assert jaccard.keep_one(df).columns == df.columns
    assert jaccard.join(df.limit(0)).count() == 0


def test_signatures_leave_no_linkable_set_alone():
    rng = np.random.default_rng(5)
    for size in [1, 2, 3, 4, 5, 7, 11, 15, 16, 17, 30, 63, 64, 65, 100, 255, 256, 400]:
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        for _ in range(20):
            apart = int(rng.integers(0, size // 3 + 1))
            drop = int(rng.integers(0, apart + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, apart - drop).astype(np.uint64)]))
            if jaccard.linked(a, b):
                assert set(jaccard.signatures(a).tolist()) & set(jaccard.signatures(b).tolist()), (size, apart, drop)


def test_sketch_bounds_difference():
    rng = np.random.default_rng(6)
    for n in (5, 60, 500):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 5:], rng.integers(0, 1 << 63, n // 7).astype(np.uint64)]))
        bits = min(jaccard.sketch_bits(len(a)), jaccard.sketch_bits(len(b)))
        x, y = (jaccard.folded(jaccard.sketch(s, 2 * bits), bits) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


# decontamination

def test_wu_manber_equals_plain_search(spark):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 13)))) for i in range(12)] + [(90, None), (3, "b a")]
    rows = [(i, " ".join(rng.choice("abcD") for _ in range(rng.randint(0, 600)))) for i in range(30)] + [(99, None)]
    patterns = {}
    for item, text in items:
        for p in decontaminate.patterns_of(decontaminate.words_of(text)):
            patterns.setdefault(p, set()).add(str(item))
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 20):  # one block, and one for nearly every item
        got = by_id(decontaminate.find(docs, bench, block_bytes=block), "n_words", "n_hit", "n_items", "items_sha256")
        for i, text in rows:
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
            hit, names = set(), set()
            for p, owners in patterns.items():
                for k in range(len(w) - len(p) + 1):
                    if tuple(x.encode() for x in w[k:k + len(p)]) == p:
                        hit |= set(range(k, k + len(p)))
                        names |= owners
            assert got[i] == (len(w), len(hit), len(names), sha(",".join(sorted(names)))), (i, block)
    clean = decontaminate.drop_contaminated(docs, bench, block_bytes=20)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows if got[i][1] == 0}


def test_decontamination_odd(spark):
    df, bench = odd_rows(spark), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    out = decontaminate.find(df, bench)
    assert sorted((r.doc_id is None, r.contaminated) for r in out.collect() if r.contaminated) == [(True, True)]
    assert decontaminate.find(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.find(df.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(df, bench).columns == df.columns


def test_decontamination_names_items_alike_at_every_block_size(spark):
    items = [("two\nlines", "a b c"), (None, "d e f"), ("é" * 30, "g h i"), ("plain", "a b c")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = frame(spark, [(1, "x a b c x g h i"), (2, "d e f"), (3, "none")])
    names = sorted(["two\nlines", "é" * 30, "plain"])
    for block in (1, 5, 1 << 20):
        got = by_id(decontaminate.find(docs, bench, block_bytes=block), "n_hit", "n_items", "items_sha256")
        assert got == {1: (6, 3, sha(",".join(names))), 2: (3, 0, sha("")), 3: (0, 0, sha(""))}, block
        assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench, block_bytes=block).collect()] == [3]


def test_sketch_comparison_equals_plain_loop():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    rows, sets = [], []
    for n in range(70):
        own = rng.integers(0, 1 << 62, int(rng.integers(0, 90))).astype(np.uint64)
        codes = np.unique(np.concatenate([base[:rng.integers(1, 400)], own]))
        sets.append(codes)
        rows.append((n, bool(rng.integers(0, 2)), len(codes), jaccard.sketch(codes, jaccard.sketch_bits(len(codes))), n % 9))
    plain = set()
    for a, new, m, x, p in rows:
        for b, old, n, y, q in rows:
            bits = 8 * min(len(x), len(y))
            if new and not old and p != q and 4 * m >= 3 * n and 4 * n >= 3 * m and int(
                    np.bitwise_count(jaccard.folded(x, bits) ^ jaccard.folded(y, bits)).sum()) <= (m + n) // 7:
                plain.add((min(a, b), max(a, b)))
    assert jaccard.near(rows) == plain and plain
    assert jaccard.near([]) == set()


def test_documents_around_one_passage_do_not_multiply(spark):
    """Texts that share three quarters of their words with all others, and link with none: few pairs become rows."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(300))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(90))) for i in range(600)]
    rows += [(1000 + i, rows[i][1] + " extra") for i in range(20)]
    docs = frame(spark, rows)
    info = jaccard.describe(docs).cache()
    found = jaccard.links(docs, info).collect()
    info.unpersist()
    assert {(min(r), max(r)) for r in map(tuple, found)} == {(i, 1000 + i) for i in range(20)}


# repeated byte strings

def plain_removal(rows, width):
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if b[k:k + width] in seen:
                gone[k:k + width] = b"\1" * width
            seen.add(b[k:k + width])
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out[i] = len(b), sum(gone), spans, sha(bytes(x for x, y in zip(b, gone) if not y))
    return out


@pytest.mark.parametrize("width, hot", [(100, 2048), (40, 1)])
def test_repeats_equal_plain_removal(spark, width, hot):
    rng, rows = random.Random(width), []
    words = [f"w{i}" for i in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    for n in range(90):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 50, 150])))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(passages) + text[at:]
        text += "ab" * rng.randint(0, 200) if rng.random() < 0.1 else ""
        rows.append((n, rng.choice(rows)[1] if rows and rng.random() < 0.2 else text))
    rows += [(200, None), (201, ""), (202, "é" * 300)]
    got = by_id(suffix.digests(frame(spark, rows), width=width, hot=hot), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == plain_removal(rows, width)


def test_repeats_odd(spark):
    df = odd_rows(spark)
    out = suffix.remove(df)
    assert out.count() == df.count()
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in out.collect()}[5] == (30_000, 29_900 + 99)
    assert suffix.remove(df.limit(0)).count() == 0


def test_repeats_of_rows_that_share_an_id(spark):
    """Null and repeated ids: each text is judged for itself, in the order of id and hash of the text."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    a, c = (" ".join(word() for _ in range(60)) for _ in range(2))
    rows = [(1, a), (2, a), (2, c), (2, a + c), (None, c + "x" * 150), (None, a), (3, c), (3, c), (None, None), (2, "")]
    df = frame(spark, rows)
    order = {r.text: r.h for r in df.selectExpr("text", "xxhash64(cast(coalesce(text, '') as binary)) h").collect()}
    plain = plain_removal([((i is not None, i or 0, order[t]), t) for i, t in set(rows)], 100)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in suffix.digests(df).collect())
    assert got == sorted((*key[:2], *plain[key]) for key in ((i is not None, i or 0, order[t]) for i, t in rows))
    alone = suffix.digests(frame(spark, [(1, a), (2, a), (2, c)])).where(f"n_bytes = {len(c)} and n_removed = 0")
    assert alone.count() >= 1 + (len(a) == len(c))


def test_transform_finds_repeated_windows():
    rng = random.Random(7)
    for _ in range(150):
        width, letters = rng.choice([9, 12, 20, 33]), rng.choice([b"ab", b"abcd", b"a", bytes(range(1, 120))])
        base = bytes(rng.choice(letters) for _ in range(rng.randint(0, 200)))
        segments, seen, expected = [], set(), []
        for _ in range(rng.randint(1, 6)):
            a = rng.randint(0, len(base))
            segments.append(base[a:rng.randint(a, len(base))] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 20))))
            windows = [segments[-1][i:i + width] for i in range(len(segments[-1]) - width + 1)]
            expected.append([i for i, w in enumerate(windows) if w in seen or w in windows[:i]])
            seen |= set(windows)
        assert [x.tolist() for x in bwt.repeated_windows(segments, width)] == expected


# secrets

def plain_secrets(text):
    rules = ((0, r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
              lambda m: len(m[2]) >= 6),
             (1, r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (2, r"[0-9a-f]+", lambda m: len(m[0]) >= 24))
    return sorted((m.start(), k, m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m))


def test_secret_spans(spark):
    rng = random.Random(8)
    bits = ["token", "Token", "API_KEY", "apikey", "ſecret", "secret", "=", ":", " ", "'", '"', "abc123", "deadbeef" * 3, "AKIA",
            "ABCDEFGH12345678", "\n", "é", "x", "passwd", "pass", "word"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += ["ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----", "see http://bob:hunter22@host/", "plain words"]
    got = by_id(secret_scan.scan(frame(spark, list(enumerate(texts)))), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    for i, text in enumerate(texts):
        base, kinds = plain_secrets(text), ("assign", "access", "hex")
        joined = [f"{kinds[k]}:{a}:{b}" for a, k, b in base]
        assert got[i][:4] == (*(sum(s[1] == k for s in base) for k in range(3)), sha(",".join(joined))), text
        assert set(filter(None, joined)) <= set(got[i][4].split(","))
    assert [got[len(texts) - 4 + k][4].split(":")[0] for k in range(4)] == ["github", "pem", "login", ""]
    assert secret_scan.scan(odd_rows(spark)).count() == len(ODD) + 2


def test_trigram_queries():
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == ("and", "aki", "kia")
    assert secret_scan.trigram_query("[0-9a-f]{24,}") is None
    assert secret_scan.trigram_query("(abcd|xyz)+") == ("or", ("and", "abc", "bcd"), "xyz")
    assert secret_scan.trigram_query("(abcd|x*)") is None


# language

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.fit(docs.where(~langid.held_out()))
    out = langid.predict(docs, net).join(docs.select("doc_id", "lang", langid.held_out().alias("held")), "doc_id").where("held")
    rows = out.collect()
    assert len(rows) > 150 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    odd = by_id(langid.predict(odd_rows(spark), net), "lang_pred", "score")
    assert odd[0] == odd[1] == odd[2] == ("und", 0.0) and odd[3][0] in net.classes
    kept = langid.keep_identified(odd_rows(spark), net)
    assert kept.columns == odd_rows(spark).columns and kept.where("text is null").count() == 0
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd_rows(spark), nothing).collect()} == {"und"}


def test_network_gradient_learns():
    rng = np.random.default_rng(9)
    x = rng.integers(97, 110, (600, langid.WINDOW)).astype(np.uint8)
    y = np.arange(600) % 2
    x[y == 1, 40:43] = np.frombuffer(b"xyz", np.uint8)
    judge = langid.Predictor(langid.train(x, y, ["no", "yes"], steps=150))
    assert (judge.probabilities(x).argmax(axis=1) == y).mean() > 0.95


def test_rejection_follows_the_number_of_labels(spark):
    classes, size = list("abcdefgh"), len(langid.WIDTHS) * langid.FILTERS
    taps = {w: np.zeros((w, 256, langid.FILTERS), np.float32) for w in langid.WIDTHS}
    for top, kept in ((0.2, 1), (0.13, 0)):  # of eight labels, an even share is 0.125
        offset = np.log(np.array([top] + [(1 - top) / 7] * 7)).astype(np.float32)
        net = langid.Network(classes, taps, np.zeros(size, np.float32), np.zeros((size, 8), np.float32), offset)
        assert langid.keep_identified(frame(spark, [(1, "some text"), (2, "12 34")]), net).count() == kept
    assert langid.least_score(4) == langid.least_score(2) == langid.least_score(0) == 0.3


# archives

def test_archives_round_trip(spark, tmp_path):
    rows = [(5, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (9, None, None), (7, "u", ""), (8, "u", "é\r\n\r\nWARC/1.1"),
            (2, "http://b", "same"), (None, "n", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write(warc.resolve(pages), f"{tmp_path}/warc")
    records = warc.read(spark, f"{tmp_path}/warc").cache()
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.headers(records).collect()), key=str)
    assert got == sorted([(5, 4, "revisit", 2), (2, 4, "response", None), (2, 4, "response", None), (9, 0, "revisit", 7),
                          (7, 0, "response", None), (8, 14, "response", None), (None, 4, "revisit", 2)], key=str)
    assert {bytes(r.payload).decode() for r in records.where("payload is not null").collect()} == {"same", "", "é\r\n\r\nWARC/1.1"}
    assert all(r.payload_digest == warc.b32encode(hashlib.sha1(r.payload).digest()).decode()
               for r in records.where("payload is not null").collect())
    small = warc.resolve(pages, least=5)
    assert {r.record_type for r in small.collect()} == {"response"}
    for file in (tmp_path / "warc").glob("*.gz"):
        assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\n")
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "warc").glob("*.gz"))
    assert plain.count(b"WARC-Record-ID: <urn:") == len(rows) and plain.count(b"WARC-Record-ID: <urn:payload:") == 1
    archive = io.BytesIO(plain)
    head, block = next(warc.parse(archive))
    assert len(block) == int(head["Content-Length"]) and archive.tell() < len(plain)  # one record read, not the archive
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(plain[:-6])))
    warc.write(warc.resolve(pages.limit(0)), f"{tmp_path}/none")
    assert warc.headers(warc.read(spark, f"{tmp_path}/none")).count() == 0
