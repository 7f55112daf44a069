"""Corpus preparation: documents -> token ids, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of ``documents``.

Nulls, empty texts, ties and repeated rows are handled as each operator's
module says; an empty table passes through every stage empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, near_dup, pieces, pii, quality
from tessera.session import scratch_path
from tessera.sources.tables import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier accepts."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dup.drop_near_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced in the texts; ``n_chars`` follows the text."""
    return pii.redact(docs, "text").withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars and the text's token ids, each checked to
    decode to the text."""
    return pieces.encode_texts(docs, ["doc_id", "lang", "source", "n_chars"], "text")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Not expressible in SQL as a whole (trained models, near duplicates, tokens):
# tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
