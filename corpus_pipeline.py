"""Corpus pipeline: quality, near-duplicates, benchmark leaks, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. The first four return the
columns of ``documents``; the last returns one row per remaining document with its
token count and digests. Decisions are joined back by doc_id: rows that share one are
judged together, and rows without one pass the filters. The only rows that leave
are those a stage decides against.

Edge cases: null and empty texts are scored as empty, near nothing and leaks of nothing,
and stay null or empty; very long texts are handled whole; null sources and languages are
a site of their own; an empty table gives empty results; extra columns pass through,
whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushlake.llm import bpe_stream, decontam, near_dup, pii, site_quality
from pushlake.llm._util import materialize, table

VOCABULARY = "byte_bpe_50k.json"

#: One stage samples, joins on samples and aggregates: SQL cannot express it.
ORACLE_SQL = None


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is not in ``ids`` (doc_id); the smaller side may repeat ids."""
    return docs.join(ids.filter("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    judged = site_quality.judge(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return _without(docs, judged.filter(~F.col("kept")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component."""
    found = near_dup.near_duplicates(docs)
    return _without(docs, found.filter(~F.col("kept")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return _without(docs, decontam.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts and the text decoded from them, as digests."""
    return bpe_stream.round_trip(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("bpe encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
