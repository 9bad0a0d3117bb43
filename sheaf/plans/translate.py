"""Translate the text members of JSON Lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheaf.fixed import BATCH_CHARS, BATCH_RECORDS
from sheaf.functions.salvage import with_json_value
from sheaf.operators.model import ModelFn, answer
from sheaf.operators.responses import total_usage, with_response_text
from sheaf.operators.translation import (
    apply_translations,
    batch_payloads,
    check_batches,
    payloads,
    translated_rows,
    translation_report,
    translation_requests,
)
from sheaf.session import stage, staged_path
from sheaf.sources.jsonl import index_records, read_jsonl, run_strict
from sheaf.sources.sinks import write_lines


@dataclass
class Translated:
    records: DataFrame  # id, record
    checked: DataFrame  # one row per batch with its fault
    responses: DataFrame

    def report(self) -> dict:
        totals = translation_report(self.checked).first().asDict()
        totals.update(total_usage(self.responses).first().asDict())
        return totals

    def write(self, path: str) -> int:
        return write_lines(self.records, path, "record", order=["id"])


def translate_records(
    records: DataFrame,
    language: str,
    model_fn: ModelFn,
    batch_size: int = BATCH_RECORDS,
    max_chars: int = BATCH_CHARS,
    responses_path: str | None = None,
    concurrency: int | None = None,
    **model_options,
) -> Translated:
    """Translate (``id``, ``record``); ids are dense from 0 in record order."""
    spark = records.sparkSession
    batches = stage(batch_payloads(payloads(records), batch_size, max_chars), "batches")
    requests = translation_requests(batches.repartition(concurrency) if concurrency else batches, language)
    path = responses_path or staged_path(spark, "responses")
    responses = answer(requests, model_fn, path, keys=["batch_no"], wave_by=["batch_no"], **model_options)
    final = with_response_text(responses.filter("final")).select("batch_no", "text", "text_error")
    answers = with_json_value(batches.select("batch_no", "expected").join(final, "batch_no"), "text")
    checked = check_batches(answers).withColumn("fault", F.coalesce("text_error", "fault"))
    checked = stage(checked.select("batch_no", "expected", "fault", "translated"), "checked")
    return Translated(apply_translations(records, translated_rows(checked)), checked, responses)


def translate(spark: SparkSession, inputs: Sequence[str], language: str, model_fn: ModelFn, **options) -> Translated:
    """Translate JSON Lines files, read strictly."""
    def read(python_judges: bool) -> DataFrame:
        indexed = index_records(read_jsonl(spark, inputs, python_judges=python_judges), out="id")
        return indexed.select("id", "record")

    return translate_records(run_strict(spark, inputs, read), language, model_fn, **options)
