"""Counts over JSON Lines: records, task types, tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sheaf.functions.json_text import string_members
from sheaf.functions.text import count_words, strip

# builds, once per Python worker process, a function from texts to token counts
CounterFactory = Callable[[], Callable[[list[str]], list[int]]]


def count_records(records: DataFrame) -> DataFrame:
    """Number of records. Counts the column itself, so a strict read checks every line."""
    return records.agg(F.count("record").alias("samples"))


def record_task_type(record: Column | str = "record") -> Column:
    """Stripped task type of a JSON record; null when absent, blank or not a string."""
    found = strip(string_members(record, ["task_type"]).getField("task_type"))
    return F.when(found != "", found)


def task_counts(records: DataFrame, task_type: Column, order: str = "record_index") -> DataFrame:
    """Records per task type, null for those without; with the first position of each."""
    return (
        records.select(task_type.alias("task_type"), F.col(order).alias("_at"))
        .groupBy("task_type")
        .agg(F.count(F.lit(1)).alias("count"), F.min("_at").alias("first_at"))
    )


def task_stats(counts: DataFrame) -> DataFrame:
    """Count and share of all records for each task type, most frequent first.

    The share's denominator includes records without a type; ``percent`` shows it with two
    decimals, halves going to the even one. Ties keep the order of first appearance.
    """
    total = counts.agg(F.sum("count")).scalar()
    typed = counts.filter(F.col("task_type").isNotNull())
    share = F.col("count") / total
    return typed.select(
        "task_type", "count", share.alias("proportion"),
        F.concat(F.format_number(100 * share, 2), F.lit("%")).alias("percent"), "first_at",
    ).orderBy(F.desc("count"), "first_at")


def task_totals(counts: DataFrame) -> DataFrame:
    missing = F.sum(F.when(F.col("task_type").isNull(), F.col("count")))
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(missing, F.lit(0)).alias("missing"),
    )


def token_counter(factory: CounterFactory) -> Callable[[Column | str], Column]:
    """Arrow UDF around a tokenizer that each worker process loads once."""

    @F.pandas_udf("bigint")
    def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = factory()
        for texts in batches:
            yield pd.Series(count(texts.tolist()), dtype="int64")

    return count_tokens


def token_stats(lines: DataFrame, text_col: str = "value", counter: Callable[[Column], Column] = count_words) -> DataFrame:
    """Lines, total, mean, smallest and largest number of tokens; zeros without lines.

    The default counter counts runs of non-blank characters and is an approximation.
    """
    zero = F.lit(0)
    return lines.select(counter(F.col(text_col)).cast("bigint").alias("_t")).agg(
        F.count("_t").alias("lines"),
        F.coalesce(F.sum("_t"), zero).cast("bigint").alias("total_tokens"),
        F.coalesce(F.avg("_t"), F.lit(0.0)).alias("mean_tokens"),
        F.coalesce(F.min("_t"), zero).cast("bigint").alias("min_tokens"),
        F.coalesce(F.max("_t"), zero).cast("bigint").alias("max_tokens"),
    )
