"""Extract records from paper pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sheaf.fixed import IMAGE_MAX_MB, PAGES_PER_REQUEST, SCHEMA_RETRIES
from sheaf.functions.salvage import with_json_value
from sheaf.operators.extraction import (
    batch_outcomes,
    document_errors,
    document_results,
    extraction_report,
    fatal_errors,
    with_schema_error,
)
from sheaf.operators.model import ModelFn, answer
from sheaf.operators.pages import extraction_requests, first_oversized_page, guard_oversized, page_batches
from sheaf.operators.responses import total_usage, with_response_text
from sheaf.session import stage, staged_path
from sheaf.sources.papers import append_ledger, pending_papers, read_ledger
from sheaf.sources.sinks import write_records


BATCH_KEYS = ["doc_path", "batch_no", "batch_count", "start_page", "end_page"]


@dataclass
class Extracted:
    parts: DataFrame  # doc_path, batch_no, record_json
    results: DataFrame  # doc_path, status, n_parts, n_errors
    errors: DataFrame  # doc_path, batch_no, error
    responses: DataFrame  # one row per attempt of every pass
    ledger_path: str | None = None
    run_id: str = "run"

    def report(self) -> dict:
        totals = extraction_report(self.results).first().asDict()
        totals.update(total_usage(self.responses).first().asDict())
        return totals

    def write(self, path: str) -> int:
        """Write the records, and only then call their papers finished.

        A paper is skipped by later runs once it is in the ledger, so nothing may be in
        there whose records are not on disk.
        """
        written = write_records(self.parts, path)
        if self.ledger_path:
            append_ledger(self.results, self.ledger_path, self.run_id)
        return written


def extract(
    papers: DataFrame,
    pages: DataFrame,
    prompt: str,
    model_fn: ModelFn,
    pages_per_request: int = PAGES_PER_REQUEST,
    max_mb: float = IMAGE_MAX_MB,
    schema_retries: int = SCHEMA_RETRIES,
    responses_path: str | None = None,
    ledger_path: str | None = None,
    run_id: str = "run",
    concurrency: int | None = None,
    **model_options,
) -> Extracted:
    """Extract from ``papers`` (doc_path, page_count) and their ``pages``.

    ``pages`` has doc_path, page_no, page_count, image_bytes_len, image_url. Batches whose
    answer is not a complete record are asked again with a correction, ``schema_retries``
    times. With ``ledger_path``, finished papers are skipped, and writing the result adds
    the newly finished ones.
    """
    spark = papers.sparkSession
    ledger = read_ledger(spark, ledger_path) if ledger_path else None
    papers = pending_papers(papers, ledger)
    pages = pending_papers(pages, ledger)
    # a batch is a short row and a long call: its bytes alone would let few tasks make all calls
    tasks = concurrency or spark.sparkContext.defaultParallelism
    oversized = first_oversized_page(pages, max_mb)
    batches = guard_oversized(page_batches(pages, pages_per_request), oversized)

    # every pass reads them; the pages are grouped once
    batches = stage(batches, "page-batches")
    path = responses_path or staged_path(spark, "responses")
    checked, todo, passes = None, batches, []
    for attempt in range(schema_retries + 1):
        requests = extraction_requests(todo.repartition(tasks, "doc_path", "batch_no"), prompt, correct=attempt > 0)
        responses = answer(requests, model_fn, f"{path}/pass={attempt}", keys=BATCH_KEYS, wave_by=["doc_path", "batch_no"], **model_options)
        passes.append(responses)
        read = with_response_text(responses.filter("final")).select(*BATCH_KEYS, "text", "text_error")
        answers = stage(with_schema_error(with_json_value(read, "text").drop("text")), "answers")
        wrong = F.col("text_error").isNull() & F.col("schema_error").isNotNull()
        again = answers.filter(wrong)
        if attempt < schema_retries:
            settled = answers.filter(~wrong)
            todo = todo.join(again.select("doc_path", "batch_no"), ["doc_path", "batch_no"], "left_semi")
        else:
            settled = answers
        checked = settled if checked is None else checked.unionByName(settled)

    responses = passes[0]
    for more in passes[1:]:
        responses = responses.unionByName(more)
    outcomes = batch_outcomes(checked, schema_retries + 1)
    fatal = fatal_errors(papers, oversized, max_mb)
    results = stage(document_results(papers, outcomes, fatal), "document-results")
    parts = outcomes.filter("record_json is not null").select("doc_path", "batch_no", "record_json")
    return Extracted(parts, results, document_errors(outcomes, fatal), responses, ledger_path, run_id)
