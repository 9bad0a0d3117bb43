"""Generate training samples from extraction records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sheaf.fixed import MAX_SAMPLE_CHARS, SAMPLE_FIELDS
from sheaf.functions.salvage import with_json_value
from sheaf.operators.model import ModelFn, answer
from sheaf.operators.requests import generation_requests
from sheaf.operators.responses import total_usage, with_items, with_response_text
from sheaf.operators.samples import (
    SAMPLE_ORDER,
    candidates_from_items,
    first_wins,
    generation_report,
    mark_samples,
)
from sheaf.session import stage, staged_path
from sheaf.sources.sinks import write_jsonl


@dataclass
class Generated:
    samples: DataFrame  # distinct samples with the place of their first occurrence
    results: DataFrame  # one row per call: paper_index, task_type, n_samples, n_discarded, error
    responses: DataFrame  # one row per attempt

    def report(self) -> dict:
        """Totals for the log; a run with failed calls counts as failed."""
        totals = generation_report(self.results).first().asDict()
        totals.update(total_usage(self.responses).first().asDict())
        return totals

    def write(self, path: str, method: str, ordered: bool = True) -> int:
        return write_jsonl(self.samples, path, SAMPLE_FIELDS[method], SAMPLE_ORDER if ordered else ())


def judged_candidates(answers: DataFrame, method: str, max_chars: int) -> DataFrame:
    """One row per call and sample, without the texts of discarded ones; a call without any sample keeps one row with no ``pos``."""
    unwrapped = with_items(answers, variant="json_variant")
    error = F.coalesce("text_error", "items_error")
    rows = unwrapped.select(
        "paper_index", "task_type", error.alias("error"),
        F.posexplode_outer(F.when(error.isNull(), F.col("items"))).alias("pos", "item"),
    )
    marked = mark_samples(candidates_from_items(rows, method), method, max_chars)
    # discarded samples are counted only; their texts, which may be long, are not written
    return marked.withColumns({f: F.when(F.col("keep"), F.col(f)) for f in SAMPLE_FIELDS[method] if f != "task_type"})


def call_results(candidates: DataFrame) -> DataFrame:
    """One row per call. A failed call has exactly one candidate row and needs no grouping."""
    told = F.col("pos").isNotNull()
    answered = candidates.filter("error is null").groupBy("paper_index", "task_type").agg(
        F.count_if(told & F.col("keep")).alias("n_samples"),
        F.count_if(told & ~F.col("keep")).alias("n_discarded"),
    )
    none = F.lit(0).cast("bigint")
    failed = candidates.filter("error is not null").select(
        "paper_index", "task_type", none.alias("n_samples"), none.alias("n_discarded"), "error"
    )
    return answered.withColumn("error", F.lit(None).cast("string")).unionByName(failed)


def generate(
    records: DataFrame,
    prompts: DataFrame,
    method: str,
    model_fn: ModelFn,
    max_chars: int = MAX_SAMPLE_CHARS,
    responses_path: str | None = None,
    concurrency: int | None = None,
    **model_options,
) -> Generated:
    """Run the nine tasks over (``paper_index``, ``record_json``).

    The responses are a table; give ``responses_path`` to continue an earlier run.
    ``concurrency`` sets the number of parallel tasks; otherwise the input's splits do.
    """
    spark = records.sparkSession
    if concurrency:
        # before the records are multiplied by the tasks
        records = records.repartition(concurrency)
    requests = generation_requests(records, prompts, method, max_chars)
    path = responses_path or staged_path(spark, "responses")
    responses = answer(requests, model_fn, path, keys=["paper_index", "task_type"], wave_by=["paper_index"], **model_options)
    answers = with_json_value(with_response_text(responses.filter("final")), "text", variant="json_variant")
    # samples and results both read the decoded answers, which may have needed Python
    candidates = stage(judged_candidates(answers, method, max_chars), "candidates")
    samples = first_wins(candidates.filter("keep").drop("keep"), method)
    return Generated(samples, call_results(candidates), responses)
