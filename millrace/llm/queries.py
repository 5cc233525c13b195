"""The language-data operators on the test tables, with their SQL checks."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import fresh_path
from . import (bpe, collocations, decontaminate, html_text, jaccard, langid, pii, quality, quality_classifier, secret_scan,
               suffix, warc, whitening)
from .arrow import documents

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_pii_boosting(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return pii.find(docs, pii.fit(docs))


def op2_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder))


def op3_tag_path_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(documents(spark, folder, "pages"))


def op4_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(documents(spark, folder), TOKENIZER)


def op5_parity_sketch_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(documents(spark, folder))


def op6_wu_manber_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(documents(spark, folder), documents(spark, folder, "benchmark"))


def op7_bounded_interval_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.digests(documents(spark, folder))


def op8_trigram_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(documents(spark, folder))


def op9_byte_cnn_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    net = langid.fit(docs.where(~langid.held_out()))
    return langid.predict(docs, net).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op10_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write(warc.resolve(documents(spark, folder, "pages")), path)
    return warc.headers(warc.read(spark, path))


def op11_shifted_cholesky_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = documents(spark, folder, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op12_prefix_free_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(documents(spark, folder))


def op13_subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = quality_classifier.fit(docs, documents(spark, folder, "labels"))
    return quality_classifier.score(docs, model).select("doc_id", quality_classifier.held_out().alias("held_out"), "score", "predicted")


QUERIES = {f.__name__: f for f in (
    op1_pii_boosting, op2_quality_cascade, op3_tag_path_text, op4_bpe_automaton, op5_parity_sketch_join,
    op6_wu_manber_decontamination, op7_bounded_interval_dedup, op8_trigram_secrets, op9_byte_cnn_language, op10_warc_revisits,
    op11_shifted_cholesky_whitening, op12_prefix_free_collocations, op13_subword_quality)}

_DIGEST = "||".join(f"substr('{warc._LETTERS}', 1 + ((('0x' || substr(h, {1 + 5 * (i // 4)}, 5))::INT >> {15 - 5 * (i % 4)}) & 31), 1)"
                    for i in range(32))
ORACLE = {
    "op10_warc_revisits": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS h FROM p),
        e AS (SELECT page_id, payload_bytes, {_DIGEST} AS payload_digest FROM d),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM e)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f""",
    "op12_prefix_free_collocations": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents),
        parts AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
        f1 AS (SELECT lang, w, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(ws) AS w FROM parts) GROUP BY ALL),
        f2 AS (SELECT lang, u, v, count(*)::HUGEINT AS f FROM (SELECT lang, ws[i] AS u, ws[i + 1] AS v
               FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM parts)) GROUP BY ALL HAVING count(*) >= 10),
        f3 AS (SELECT lang, u, v, w, count(*)::HUGEINT AS f FROM (SELECT lang, ws[i] AS u, ws[i + 1] AS v, ws[i + 2] AS w
               FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM parts)) GROUP BY ALL HAVING count(*) >= 10),
        cuts AS (
            SELECT c.lang, u || ' ' || v AS phrase, c.f AS a, x.f AS l, y.f AS r, 1 AS cut
            FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w = u JOIN f1 y ON y.lang = c.lang AND y.w = v
            UNION ALL SELECT c.lang, c.u || ' ' || c.v || ' ' || c.w, c.f, x.f, y.f, 1
            FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w = c.u JOIN f2 y ON y.lang = c.lang AND y.u = c.v AND y.v = c.w
            UNION ALL SELECT c.lang, c.u || ' ' || c.v || ' ' || c.w, c.f, x.f, y.f, 2
            FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.u = c.u AND x.v = c.v JOIN f1 y ON y.lang = c.lang AND y.w = c.w),
        scored AS (SELECT *, 1000000 * a * a // (l * r) AS score FROM cuts),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inside AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, u || ' ' || v AS phrase, f FROM f3
                   UNION ALL SELECT lang, v || ' ' || w, f FROM f3) GROUP BY ALL),
        kept AS (SELECT o.* FROM lowest o LEFT JOIN inside i ON i.lang = o.lang AND i.phrase = o.phrase
                 WHERE i.longer IS NULL OR 100 * i.longer < 50 * o.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
               (SELECT sum(f) FROM f1 WHERE f1.lang = ranked.lang)::BIGINT AS n, score::BIGINT AS score
        FROM ranked WHERE rank <= 2000""",
}
