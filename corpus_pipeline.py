"""From raw documents to packed training sequences: five stages over the table ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes each
result as Parquet to the shared folder and reads it back as the next stage's ``docs``.
Stages 1 to 4 return the columns of ``documents``, the last one the place of every piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheaf.llm import exact_dedup, near_dedup, packing, quality_rules, secrets
from sheaf.llm.queries import vocabulary
from sheaf.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy."""
    return quality_rules.kept_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on shingles of five words."""
    return near_dedup.without_near_duplicates(docs, 5)


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return secrets.redacted(docs, secrets.secret_spans(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("secret scans", secret),
    ("packing", packed),
]

#: Near deduplication, inferred automata and tokenisers take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
