"""Exact duplicates by a tree merge of sorted digest runs.

Texts are equal when they are identical after every white-space character is deleted.
Each input partition makes one run: a row per distinct text, with the best document
seen and the number of documents. Runs are then merged ``FAN_IN`` at a time in rounds,
run ``k`` with its neighbours of the same ``k // FAN_IN ** round``, until one is left.
A run is spread over all shuffle partitions by digest, so a round is one shuffle whose
map side folds what it holds before anything is sent: however many copies a text has,
a run carries it once. Spark sorts each side by digest and merges (the minimum of a
struct is a sort-based aggregate), which spills instead of filling memory.

At every level two texts are merged only if SHA-256, length and a second hash of the
normalised text all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.llm.common import SPACES, rows_staying, text_hash, text_or_empty
from sheaf.session import stage

FAN_IN = 16
#: What identifies a normalised text.
SAME = ["digest", "n_norm", "second_hash"]


def text_keys(docs: DataFrame) -> DataFrame:
    """Per document: id, code points of the text, identity of the normalised text, run and row numbers."""
    norm = F.translate(text_or_empty(), SPACES, "")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(text_or_empty()).alias("n_chars"),
        F.unhex(F.sha2(norm, 256)).alias("digest"),
        F.length(norm).alias("n_norm"),
        F.xxhash64(norm).alias("second_hash"),
        text_hash().alias("text_hash"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def rank() -> Column:
    """Smallest for the document that stays: most code points, then smallest id (null last), then first row."""
    return F.struct(
        (-F.col("n_chars")).alias("less_chars"), F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id"), F.col("row_id"),
    )


def merged_runs(keys: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: its identity, the rank of the document that stays, ``group_size``."""
    last = keys.agg(F.coalesce(F.max("run"), F.lit(0)).alias("last")).first()["last"]
    runs = keys.select(*SAME, "run", rank().alias("best"), F.lit(1).cast("bigint").alias("group_size"))
    while True:
        last //= fan_in
        runs = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).groupBy("run", *SAME).agg(
            F.min("best").alias("best"), F.sum("group_size").alias("group_size")
        )
        if last == 0:
            return runs.drop("run")


def exact_duplicates(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    ``doc_id, keep_id`` (id of the row that stays), ``group_size``, ``kept``,
    ``text_sha256`` (of the normalised text), ``n_chars``, ``n_norm``, ``text_hash``.
    Null text counts as empty; all texts without a visible character are one group.
    Of repeated rows with the same id and text exactly one is kept. A row without an id
    stays only if no row of its group with as many code points has one; ``keep_id`` is
    then null. ``kept`` never is. An empty table gives an empty table.
    """
    keys = stage(text_keys(docs), "dedup-keys")
    # written, so that both sides of the join below are shuffled by it: only then
    # can Spark split the partition of a text with very many copies
    winners = stage(merged_runs(keys, fan_in), "dedup-winners")
    return keys.join(winners, SAME).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_chars", "n_norm", "text_hash",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns.

    Rows with the same id and text can differ in further columns; any one of them stays.
    """
    return rows_staying(docs, exact_duplicates(docs).filter("kept"))
