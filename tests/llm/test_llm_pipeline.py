"""The pipeline against a brute-force version of its stages, and the archive query against its SQL."""

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import decontaminate, langid, pii, queries
from test_llm_operators import plain_components, sha

FOLDER = "/root/testdata/sf0.001"


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    known = langid.predict(docs, langid.fit(docs.where(~langid.held_out()))).where("lang_pred <> 'und' and score >= 0.3")
    rows = {r.doc_id: rows[r.doc_id] for r in known.collect()}
    assert len(rows) >= 198  # clean documents stay
    groups = plain_components(list(rows.items()))
    rows = {i: t for i, t in rows.items() if groups[i][1] == i}
    patterns = {p for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
                for p in decontaminate.patterns_of(decontaminate.words_of(r.text))}
    for i, text in list(rows.items()):
        words = decontaminate.words_of(text)
        if any(tuple(words[k:k + n]) in patterns for n in {*map(len, patterns)} for k in range(len(words) - n + 1)):
            del rows[i]
    left = docs.where(docs.doc_id.isin(list(rows)))
    detector = pii.fit(left)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for i, text in rows.items():
        text = pii.redacted(text, detector(text)[1])
        expected[i] = len(library.encode(text, add_special_tokens=False).ids), sha(text)
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in got} == expected and len(got) == len(expected)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, FOLDER).columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0


def test_archive_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    res = con.execute(queries.ORACLE["op10_warc_revisits"])
    names = [c[0] for c in res.description]
    out = queries.QUERIES["op10_warc_revisits"](spark, FOLDER)
    assert sorted(out.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in out.collect()) == sorted(res.fetchall())


def test_every_operator_query_covers_its_table(spark):
    for name, query in queries.QUERIES.items():
        if name.split("_")[0] in ("op1", "op2", "op3", "op4", "op6", "op8", "op9"):
            table = "pages" if name.startswith("op3") else "documents"
            assert query(spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count(), name
