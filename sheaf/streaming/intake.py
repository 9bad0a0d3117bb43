"""Incremental intake: hand the pages of new papers, once all are there, to the batch job."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sheaf.session import read_table_if_any, stage
from sheaf.sources.papers import pending_papers, read_ledger

PAGES_SCHEMA = "doc_path string, page_no int, page_count int, image_bytes_len bigint, image_url string"


def stream_pages(spark: SparkSession, folder: str, schema: str = PAGES_SCHEMA, files_per_trigger: int = 1000) -> DataFrame:
    """Page tables arriving as Parquet files, a paper's pages in one file or several."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


class Waiting:
    """Pages that wait for the rest of their paper or for another try, beside the ledger.

    A log: each trigger adds the pages that came in it and are left, and the papers it
    tried in vain; nothing that has not changed is written again. What a later batch brings
    replaces what an earlier one brought, and papers in the ledger wait no longer.
    """

    def __init__(self, spark: SparkSession, ledger_path: str, schema: str = PAGES_SCHEMA):
        self.spark, self.schema = spark, schema
        self.ledger_path = ledger_path
        self.pages_path = f"{ledger_path.rstrip('/')}.waiting/pages"
        self.tries_path = f"{ledger_path.rstrip('/')}.waiting/tries"

    def pages(self, before: int | None = None) -> DataFrame | None:
        """Waiting pages, those of batches ``before`` a number only: a replayed batch sees what it saw first."""
        log = read_table_if_any(self.spark, self.pages_path, f"{self.schema}, batch bigint")
        if log is None:
            return None
        if before is not None:
            log = log.filter(F.col("batch") < before)
        columns = [c for c in log.columns if c != "batch"]
        latest = log.groupBy("doc_path", "page_no").agg(F.max_by(F.struct(*columns), "batch").alias("page"))
        return pending_papers(latest.select("page.*"), read_ledger(self.spark, self.ledger_path))

    def put(self, pages: DataFrame, batch: int) -> None:
        """Replaces what the batch put before, if it is replayed."""
        pages.write.mode("overwrite").parquet(f"{self.pages_path}/batch={batch}")

    def tried(self, papers: DataFrame) -> None:
        papers.select("doc_path", F.current_timestamp().alias("tried_at")).write.mode("append").parquet(self.tries_path)

    def due(self, pages: DataFrame, retry_after: float) -> DataFrame:
        """``pages`` without those of papers tried less than ``retry_after`` seconds ago."""
        tries = read_table_if_any(self.spark, self.tries_path, "doc_path string, tried_at timestamp")
        if tries is None:
            return pages
        recent = tries.filter(
            F.col("tried_at") > F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(retry_after)))
        )
        return pages.join(recent.select("doc_path").distinct(), "doc_path", "left_anti")

    def compact(self) -> None:
        """Write the log anew, without finished papers and replaced pages. For use while no stream runs."""
        now = self.pages()
        if now is None:
            return
        last = self.spark.read.schema(f"{self.schema}, batch bigint").parquet(self.pages_path).agg(F.max("batch")).first()[0]
        kept = stage(now, "waiting")
        kept.withColumn("batch", F.lit(last)).write.mode("overwrite").partitionBy("batch").parquet(self.pages_path)


def whole_papers(pages: DataFrame) -> DataFrame:
    """``doc_path`` of papers all of whose pages are there."""
    there = pages.groupBy("doc_path").agg(F.count(F.lit(1)).alias("n"), F.max("page_count").alias("all"))
    return there.filter(F.col("n") >= F.col("all")).select("doc_path")


def start_intake(
    pages: DataFrame,
    run_batch: Callable[[DataFrame, str], None],
    checkpoint: str,
    ledger_path: str,
    trigger: dict | None = None,
    retry_after: float | None = None,
) -> StreamingQuery:
    """Run ``run_batch(pages, run_id)`` on the pages of complete papers that are not finished.

    The stream's checkpoint decides which files are new; the ledger, to which
    ``run_batch`` adds once its records are written, which papers are done. Pages of
    papers that are not all there yet, or that failed, wait (:class:`Waiting`); a page
    sent again replaces the one that waits. Each trigger reads what batches before it
    left, so a batch replayed after a failure sees what it saw before.

    Failed papers come back with the next trigger that has new files. With
    ``retry_after`` they come back that many seconds after they were tried, new files
    or not: those due are run when the intake starts, and, if it runs on by a processing
    time trigger, at every trigger. They come back with their last pages, so a file that
    brings a page again does not have to wait.
    """
    spark = pages.sparkSession
    schema = pages.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    beat = retry_after is not None and "processingTime" in (trigger or {})

    def run(arrived: DataFrame | None, before: int | None, run_id: str) -> DataFrame | None:
        """Try what is whole and due; returns the new pages that are left."""
        waiting = Waiting(spark if arrived is None else arrived.sparkSession, ledger_path, schema)
        held = waiting.pages(before)
        if held is not None and retry_after is not None:
            held = stage(held, "intake-held")
            ready = waiting.due(held.join(whole_papers(held), "doc_path", "left_semi"), retry_after)
            # parts of papers take no time to wait for
            held = ready.unionByName(held.join(whole_papers(held), "doc_path", "left_anti"))
        every = arrived
        if held is not None:
            every = held if arrived is None else arrived.unionByName(
                held.join(arrived.select("doc_path", "page_no"), ["doc_path", "page_no"], "left_anti")
            )
        if every is None:
            return None
        every = stage(pending_papers(every, read_ledger(waiting.spark, ledger_path)), "intake")
        whole = stage(whole_papers(every), "intake-whole")
        if not whole.isEmpty() or retry_after is None:
            run_batch(every.join(whole, "doc_path", "left_semi"), run_id)
        waiting.tried(pending_papers(whole, read_ledger(waiting.spark, ledger_path)))
        return None if arrived is None else pending_papers(arrived, read_ledger(waiting.spark, ledger_path))

    def each(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.filter("doc_path is not null") if beat else batch
        # read for the pages there are, for those they replace and for those that are left
        arrived = stage(arrived.dropDuplicates(["doc_path", "page_no"]), "intake-arrived")
        left = run(arrived, batch_id, f"intake-{batch_id}")
        left = stage(left, "intake-left")
        if not left.isEmpty():
            Waiting(batch.sparkSession, ledger_path, schema).put(left, batch_id)

    if retry_after is not None:
        run(None, None, f"retry-{uuid.uuid4().hex[:12]}")
    if beat:
        # a row a second without any page, so that triggers come without new files too
        ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        pages = pages.unionByName(ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in pages.schema]))
    writer = pages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
