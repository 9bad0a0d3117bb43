"""Training samples: cleaning, bounds and first-wins deduplication."""

from __future__ import annotations

import json
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import VariantType

from sheaf.fixed import MAX_SAMPLE_CHARS, SAMPLE_FIELDS, TASKS
from sheaf.functions.json_text import string_members, variant_members
from sheaf.functions.binding import let
from sheaf.functions.text import at_most, strip

# Room for positions inside one response; a position is an int.
_POSITIONS = 1 << 31
_MODEL_TASK = "model_task_type"


def field_columns(method: str) -> list[str]:
    """Columns a candidate table needs. The model's own task type has its own name."""
    return [_MODEL_TASK if f == "task_type" else f for f in SAMPLE_FIELDS[method]]


def candidates_from_items(items: DataFrame, method: str, item_col: str = "item") -> DataFrame:
    """Read the fields of items, JSON texts or variants; absent and non-string members become null."""
    members = variant_members if isinstance(items.schema[item_col].dataType, VariantType) else string_members
    df = items.withColumn("_m", members(item_col, SAMPLE_FIELDS[method]))
    for name, field in zip(field_columns(method), SAMPLE_FIELDS[method]):
        df = df.withColumn(name, F.col(f"_m.{field}"))
    return df.drop("_m", item_col)


def mark_samples(candidates: DataFrame, method: str, max_chars: int = MAX_SAMPLE_CHARS) -> DataFrame:
    """Strip the fields and add ``keep``: all fields filled, pair differs, length in bound.

    The length is that of the compact JSON of the sample as it will be written; the job's
    task type replaces the model's before measuring.
    """
    names = field_columns(method)
    filled = F.lit(True)
    for name in names:
        filled = filled & F.coalesce(F.col(name) != "", F.lit(False))
    df = candidates.withColumns({n: strip(n) for n in names}).withColumn("_filled", filled)
    if _MODEL_TASK in names:
        df = df.drop(_MODEL_TASK)
    keep = F.col("_filled")
    if method == "DPO":
        keep = keep & (F.col("chosen") != F.col("rejected"))
    # a byte is six characters at most, as an escape; only longer samples need encoding
    size = reduce(add, [F.octet_length(f) for f in SAMPLE_FIELDS[method]])
    frame = len(json.dumps(dict.fromkeys(SAMPLE_FIELDS[method], ""), separators=(",", ":")))
    encoded = let(F.to_json(F.struct(*SAMPLE_FIELDS[method])), lambda line: at_most(line, max_chars))
    in_bound = (6 * size.cast("bigint") + frame <= max_chars) | encoded
    # texts longer than the bound need no encoding to be turned away
    short = F.lit(True)
    for field in SAMPLE_FIELDS[method]:
        short = short & at_most(F.col(field), max_chars)
    keep = F.coalesce(keep & short & in_bound, F.lit(False))
    return df.withColumn("keep", keep).drop("_filled")


def normalize_samples(candidates: DataFrame, method: str, max_chars: int = MAX_SAMPLE_CHARS) -> DataFrame:
    return mark_samples(candidates, method, max_chars).filter("keep").drop("keep")


def _task_rank(task_type: Column) -> Column:
    """Position of the task type in alphabetical order."""
    names = F.array(*[F.lit(t) for t in sorted(TASKS.values())])
    return F.array_position(names, task_type)


def _job_number(task_type: Column) -> Column:
    return F.col("paper_index").cast("decimal(38,0)") * (len(TASKS) + 1) + _task_rank(task_type)


def first_wins(samples: DataFrame, method: str) -> DataFrame:
    """Distinct samples, each with the place of its first occurrence.

    Order of occurrence is (``paper_index``, ``task_type`` by name, ``pos``). The order
    key is packed into one decimal: a minimum over a struct would make Spark sort all
    texts before and after the shuffle, a fixed-width minimum is hash aggregated and
    combined before the shuffle, so copies of one sample leave each task only once.
    """
    fields = list(SAMPLE_FIELDS[method])
    packed = _job_number(F.col("task_type")) * _POSITIONS + F.col("pos")
    firsts = samples.groupBy(*fields).agg(F.min(packed).alias("_first"))
    per_paper = (len(TASKS) + 1) * _POSITIONS
    paper = F.expr(f"_first div {per_paper}")
    rest = (F.col("_first") - paper.cast("decimal(38,0)") * per_paper).cast("bigint")
    firsts = firsts.withColumn("paper_index", paper).withColumn("_rest", rest)
    firsts = firsts.withColumn("pos", F.col("_rest").bitwiseAND(F.lit(_POSITIONS - 1)).cast("int"))
    if "task_type" not in fields:
        names = F.array(*[F.lit(t) for t in sorted(TASKS.values())])
        rank = F.shiftright("_rest", 31).cast("int")
        firsts = firsts.withColumn("task_type", F.get(names, rank - 1))
    return firsts.drop("_first", "_rest")


SAMPLE_ORDER = ("paper_index", "task_type", "pos")


def generation_report(results: DataFrame) -> DataFrame:
    """Totals of a run: ``calls``, ``failed_calls``, ``kept`` and ``discarded`` samples."""
    return results.agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("error").isNotNull()).alias("failed_calls"),
        F.coalesce(F.sum("n_samples"), F.lit(0)).cast("bigint").alias("kept"),
        F.coalesce(F.sum("n_discarded"), F.lit(0)).cast("bigint").alias("discarded"),
    )
