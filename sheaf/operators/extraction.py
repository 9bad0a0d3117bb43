"""Checking extraction answers and rolling them up per paper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheaf.fixed import IMAGE_MAX_MB, RECORD_KEYS
from sheaf.functions.json_text import object_keys
from sheaf.operators.pages import oversize_error


def with_schema_error(df: DataFrame, kind: str = "json_kind", value: str = "json", out: str = "schema_error") -> DataFrame:
    """Add the reason why an answer is not a complete record, or null.

    Keys count when they are there; their values may be null.
    """
    wanted = F.array(*[F.lit(k) for k in RECORD_KEYS])
    missing = F.array_except(wanted, object_keys(value))
    reason = (
        F.when(F.col(kind).isNull(), "no JSON value in the answer")
        .when(F.col(kind) != "object", "the answer is not an object")
        .when(
            F.size(missing) > 0,
            F.concat(
                F.lit("members are missing from the record: "),
                F.array_join(missing, ", "),
            ),
        )
    )
    return df.withColumn(out, reason)


def batch_outcomes(checked: DataFrame, attempts: int) -> DataFrame:
    """Per batch its ``record_json`` or final ``error``, after ``attempts`` passes.

    ``checked`` has ``text_error``, ``schema_error`` and the decoded answer. A schema
    error names the number of passes; a request that failed does not.
    """
    schema = F.concat(
        F.lit(f"no complete record after {attempts} attempt(s): "), F.col("schema_error")
    )
    error = F.coalesce("text_error", F.when(F.col("schema_error").isNotNull(), schema))
    return checked.select(
        "doc_path", "batch_no", "batch_count", "start_page", "end_page",
        F.when(error.isNull(), F.col("json")).alias("record_json"),
        error.alias("error"),
    )


def error_label(batch_no: Column, batch_count: Column, start_page: Column, end_page: Column, cause: Column) -> Column:
    return F.format_string("part %d/%d (page %d-%d): %s", batch_no, batch_count, start_page, end_page, cause)


def fatal_errors(papers: DataFrame, oversized: DataFrame, max_mb: float = IMAGE_MAX_MB) -> DataFrame:
    """Errors that end a paper: no pages at all, or an oversized page."""
    empty = papers.filter(F.col("page_count") < 1).select(
        "doc_path", F.concat(F.lit("paper without pages: "), "doc_path").alias("error")
    )
    big = oversized.select(
        "doc_path", oversize_error(F.col("first_bad"), F.col("bad_bytes"), max_mb).alias("error")
    )
    return empty.unionByName(big)


def document_errors(outcomes: DataFrame, fatal: DataFrame) -> DataFrame:
    """One row per error in batch order (``batch_no``); a fatal error comes last, without one.

    Errors stay rows: a list per paper would grow with the paper.
    """
    label = error_label(*[F.col(c) for c in ("batch_no", "batch_count", "start_page", "end_page", "error")])
    parts = outcomes.filter(F.col("error").isNotNull()).select("doc_path", "batch_no", label.alias("error"))
    return parts.unionByName(fatal.select("doc_path", F.lit(None).cast("int").alias("batch_no"), "error"))


def document_results(papers: DataFrame, outcomes: DataFrame, fatal: DataFrame) -> DataFrame:
    """Status and counts per paper: success, partial or failed.

    A fatal error makes the paper failed even when earlier batches gave records.
    """
    marks = outcomes.select(
        "doc_path",
        F.col("error").isNull().cast("int").alias("part"),
        F.col("error").isNotNull().cast("int").alias("err"),
        F.lit(0).alias("fatal"),
    ).unionByName(
        fatal.select("doc_path", F.lit(0).alias("part"), F.lit(1).alias("err"), F.lit(1).alias("fatal"))
    ).unionByName(
        papers.select("doc_path", F.lit(0).alias("part"), F.lit(0).alias("err"), F.lit(0).alias("fatal"))
    )
    # one hash aggregate instead of two joins; a paper with very many batches is combined before the shuffle
    sums = marks.groupBy("doc_path").agg(
        F.sum("part").alias("n_parts"), F.sum("err").alias("n_errors"), F.max("fatal").alias("_fatal")
    )
    status = (
        F.when(F.col("_fatal") == 1, "failed")
        .when(F.col("n_errors") == 0, "success")
        .when(F.col("n_parts") > 0, "partial")
        .otherwise("failed")
    )
    return sums.select("doc_path", status.alias("status"), "n_parts", "n_errors")


def extraction_report(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("papers"),
        F.coalesce(F.sum("n_parts"), F.lit(0)).cast("bigint").alias("parts"),
        F.count_if(F.col("n_parts") == 0).alias("papers_without_parts"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "partial").alias("partial"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
