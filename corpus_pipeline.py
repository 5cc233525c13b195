"""Corpus pipeline: language ID, near duplicates, benchmark decontamination, personal data, tokens.

Each stage gets all rows that the one before it kept and passes on the columns of ``documents``; the last one returns
the tokens. ``run`` writes every stage to the shared folder and reads it again, so a lost executor costs one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard, langid, pii
from millrace.llm.arrow import documents
from millrace.llm.queries import TOKENIZER
from millrace.sources.staging import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language the network tells. It learns from the rows that are not held out."""
    return langid.keep_identified(docs, langid.fit(docs.where(~langid.held_out())))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group of near or exact copies; its rows all stay if its id repeats or is null."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind; n_chars follows the text."""
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""
    return bpe.digests(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("tokens", tokenize),
]

# Trained models and the tokenizer's automaton have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
