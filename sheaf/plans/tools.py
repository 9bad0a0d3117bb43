"""Jobs on finished JSON Lines: merge, count, statistics, calibration, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheaf.fixed import CALIBRATION_SAMPLES, CALIBRATION_SEED, DATASET_VIEWS
from sheaf.functions.json_text import string_members
from sheaf.functions.text import count_words
from sheaf.operators.calibration import calibration_records, seeded_draw, with_messages
from sheaf.operators import record_checks
from sheaf.operators.stats import count_records, record_task_type, task_counts, task_stats, task_totals, token_stats
from sheaf.record_template import TEMPLATE
from sheaf.session import stage
from sheaf.sources.jsonl import (
    count_array_items,
    index_records,
    physical_lines,
    read_jsonl,
    run_strict,
)
from sheaf.sources.sinks import dataset_view, require_new, write_lines


def merge(spark: SparkSession, inputs: Sequence[str], output: str, ordered: bool = True) -> int:
    """Write the records of all inputs, in the given order, as canonical lines.

    Duplicates stay. The ordered form sorts by position; it needs the records landed
    once. ``ordered=False`` copies without sort or shuffle.
    """
    require_new(spark, output)

    def job(python_judges: bool) -> int:
        records = read_jsonl(spark, inputs, python_judges=python_judges)
        if ordered:
            return write_lines(index_records(records), output, "record", ["record_index"])
        return write_lines(records, output, "record")

    return run_strict(spark, inputs, job)


def count(spark: SparkSession, path: str) -> int:
    """Objects in JSON Lines, or items of the array in a ``.json`` file."""
    if path.lower().endswith(".json"):
        return count_array_items(spark, path).first().samples

    def job(python_judges: bool) -> int:
        return count_records(read_jsonl(spark, [path], python_judges=python_judges)).first().samples

    return run_strict(spark, [path], job)


def task_statistics(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(per task type, totals) of JSON Lines. Positions only break ties, so a scan position will do."""
    def job(python_judges: bool) -> DataFrame:
        records = read_jsonl(spark, [path], python_judges=python_judges)
        records = index_records(records.withColumn("record", record_task_type("record")))
        return stage(task_counts(records, F.col("record")), "task-counts")

    counts = run_strict(spark, [path], job)
    return task_stats(counts), task_totals(counts)


def token_statistics(spark: SparkSession, path: str, counter=count_words) -> DataFrame:
    """Token statistics over physical lines, blank ones and line feeds included."""
    return token_stats(physical_lines(spark, path), "value", counter)


def calibration_set(
    spark: SparkSession, path: str, k: int = CALIBRATION_SAMPLES, seed: int = CALIBRATION_SEED
) -> DataFrame:
    """Chat messages of a seeded draw of usable records, in draw order."""
    def job(python_judges: bool) -> DataFrame:
        usable = calibration_records(read_jsonl(spark, [path], "skip", python_judges))
        return index_records(usable, out="usable_index")

    indexed = run_strict(spark, [path], job, skip_others=True)
    if indexed.isEmpty():
        raise RuntimeError("Calibration JSONL has no valid SFT records.")
    return with_messages(seeded_draw(indexed, "usable_index", k, seed)).orderBy("draw_no")


def training_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A JSON Lines file under the column names of the training-set manifest.

    Lines are read as by the other tools: NaN and repeated members are taken, a line that
    is no object ends the job and is named. The view is written once on the way.
    """
    fields = list(DATASET_VIEWS[name].values())

    def job(python_judges: bool) -> DataFrame:
        records = read_jsonl(spark, [path], python_judges=python_judges)
        return stage(records.select(string_members("record", fields).alias("m")).select("m.*"), "view")

    return dataset_view(run_strict(spark, [path], job), name)


def record_reports(records: DataFrame, text: str = "record_json") -> dict[str, DataFrame]:
    """Quality reports on extraction records (their keys and ``record_json``), by name.

    Paths are unfolded once and written; two reports read them. The others decide each
    record within its row.
    """
    paths = record_checks.field_paths(records, text, TEMPLATE)
    return {
        "path_faults": record_checks.path_faults(paths),
        "field_fill": record_checks.field_fill(paths),
        "orphan_samples": record_checks.orphan_samples(records, text),
        "process_params": record_checks.process_param_check(records, text),
        "techniques": record_checks.technique_check(records, text),
    }


def check_records(records: DataFrame, output: str) -> dict[str, int]:
    """Write each report as a folder of JSON Lines in ``output``; returns their row counts."""
    spark = records.sparkSession
    require_new(spark, output)
    written = {}
    for name, report in record_reports(records).items():
        path = f"{output.rstrip('/')}/{name}"
        report.write.mode("errorifexists").json(path)
        written[name] = spark.read.schema(report.schema).json(path).count()
    return written
