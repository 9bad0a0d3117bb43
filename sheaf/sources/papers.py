"""Paper folders, extraction records, prompts, and the ledger of finished papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.fixed import TASKS
from sheaf.functions.binding import let
from sheaf.functions.json_text import canonical, is_object_variant, root_kind, STRICT
from sheaf.functions.text import is_filled, strip
from sheaf.session import read_table_if_any
from sheaf.sources.json_array import checked_items, read_items

LEDGER_SCHEMA = "doc_path string, run_id string"


class ConfigError(RuntimeError):
    """A prompt file is missing or empty."""


def list_papers(spark: SparkSession, folder: str) -> DataFrame:
    """PDF files directly inside a folder: ``doc_path``, ``length``. Contents are not read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        raise FileNotFoundError(f"no such folder of papers: {folder}")
    if not fs.getFileStatus(where).isDirectory():
        raise NotADirectoryError(f"not a folder of papers: {folder}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select(F.col("path").alias("doc_path"), "length")


def papers_in(spark: SparkSession, folder: str, pages: DataFrame) -> DataFrame:
    """``doc_path, page_count`` of the papers of a folder, by the pages at hand (doc_path, page_count).

    A paper none of whose pages are there has ``page_count`` 0, so that it fails instead of
    vanishing. Papers and pages belong together by file name, as a folder has each once;
    the path is that of the pages where there are any.
    """
    def name(c: str) -> Column:
        return F.regexp_extract(c, r"([^/]*)\z", 1)

    listed = list_papers(spark, folder).select("doc_path", name("doc_path").alias("_name"))
    known = pages.groupBy(name("doc_path").alias("_name")).agg(
        F.max("doc_path").alias("_path"), F.max("page_count").alias("page_count")
    )
    return listed.join(known, "_name", "left").select(
        F.coalesce("_path", "doc_path").alias("doc_path"), F.coalesce("page_count", F.lit(0)).alias("page_count")
    )


def pending_papers(papers: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Papers that no earlier run has finished."""
    if ledger is None:
        return papers
    return papers.join(ledger.select("doc_path"), "doc_path", "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    return read_table_if_any(spark, path, LEDGER_SCHEMA)


def append_ledger(document_results: DataFrame, path: str, run_id: str) -> None:
    """Record the fully successful papers of a run; the others come back next time."""
    done = document_results.filter(F.col("status") == "success")
    done.select("doc_path", F.lit(run_id).alias("run_id")).write.mode("append").parquet(path)


def records_from_text(files: DataFrame, text_col: str = "value") -> DataFrame:
    """Explode files holding one record or an array of records.

    Adds ``item_no`` and ``record_json``. A file that is not valid JSON, has another
    root or holds any item that is not an object ends the job.
    """
    def fault(reason: str) -> Column:
        return F.raise_error(F.lit(reason)).cast("array<string>")

    def items_of(array_text: Column) -> Column:
        # the same array twice: once for the text of each item, once for its type
        types = F.from_json(array_text, "array<variant>")
        good = let(types, lambda t: t.isNotNull() & F.forall(t, is_object_variant))
        return F.when(good, F.from_json(array_text, "array<string>", STRICT)).otherwise(
            fault("an item of the array is not an object")
        )

    def items(text: Column) -> Column:
        def judged(value: Column) -> Column:
            kind = root_kind(text)
            return (
                F.when(value.isNull(), fault("the file is not one JSON value"))
                .when(kind == "array", items_of(value))
                .when(kind == "object", F.array(value))
                .otherwise(fault("the value is neither an object nor an array"))
            )

        return let(canonical(text), judged)

    keep = [c for c in files.columns if c != text_col]
    # the outer form: for an inner one Spark would evaluate the array twice more, to skip empty ones
    rows = files.select(*keep, F.posexplode_outer(let(F.col(text_col), items)).alias("item_no", "record_json"))
    return rows.filter("item_no is not null")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``path, item_no, record_json``: the extraction records of a file or folder.

    Files written by the record sink are JSON Lines and are read with ``read_jsonl``;
    this reads files that hold a single JSON value each, a record or an array of them.
    """
    items = checked_items(read_items(spark, path), objects=True)
    return items.select("path", "item_no", F.col("item").alias("record_json"))


def read_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The nine task prompts of one method: ``prompt_name``, ``task_type``, ``prompt``.

    The folder is small by contract (nine named files), so completeness is checked here.
    """
    files = spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True)
    files = files.select(
        F.regexp_replace(F.col("_metadata.file_name"), r"\.md\z", "").alias("prompt_name"),
        strip("value").alias("prompt"),
    ).filter(F.col("prompt_name").isin(*TASKS))
    wanted = task_table(spark)
    prompts = wanted.join(F.broadcast(files), "prompt_name")
    missing = [r.prompt_name for r in missing_prompts(wanted, files).collect()]
    if missing:
        names = ", ".join(f"{folder}/{n}.md" for n in sorted(missing))
        raise ConfigError(f"prompts not found: {names}")
    empty = prompts.filter(~is_filled("prompt")).first()
    if empty is not None:
        raise ConfigError(f"prompt without text: {folder}/{empty.prompt_name}.md")
    return prompts


def task_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TASKS.items()), "prompt_name string, task_type string")


def missing_prompts(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Catalogue entries without a prompt file."""
    return wanted.join(files.select("prompt_name"), "prompt_name", "left_anti").select("prompt_name")
