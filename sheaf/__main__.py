"""Command line: spark-submit with this package, or ``python -m sheaf <command> ...``.

A model is named as ``module:function``; see ``sheaf.operators.model`` for its contract.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from pyspark.sql import SparkSession

from sheaf import fixed
from sheaf.functions.text import count_words
from sheaf.operators.ordering import with_dense_index
from sheaf.operators.responses import total_usage
from sheaf.operators.stats import token_counter
from sheaf.plans import tools
from sheaf.plans.extract import extract
from sheaf.plans.generate import generate
from sheaf.plans.translate import translate
from sheaf.session import JOB_CONF
from sheaf.sources.jsonl import index_records, read_jsonl, run_strict
from sheaf.sources.papers import papers_in, read_prompts, read_records
from sheaf.sources.sinks import require_new


def positive(text: str) -> int:
    value = int(text)
    if value < 1:
        raise argparse.ArgumentTypeError("must be at least 1")
    return value


def named(text: str):
    module, _, name = text.partition(":")
    return getattr(importlib.import_module(module), name)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sheaf", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, model: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        if model:
            sub.add_argument("--model", type=named, required=True, metavar="MODULE:FUNCTION")
            sub.add_argument("--concurrency", type=positive, help="parallel tasks calling the model")
            sub.add_argument("--threads", type=positive, default=1, help="calls at a time inside a task")
            sub.add_argument("--max-retries", type=int, default=fixed.MAX_RETRIES)
            sub.add_argument("--waves", type=positive, default=1, help="number of commits of the responses")
            sub.add_argument("--resume", action="store_true", help="go on with the unfinished waves of a lost run")
            sub.add_argument("--responses", help="response table, by default beside the output; an existing one is continued")
            sub.add_argument("--errors", help="folder for one JSON line per paper, call or batch that failed")
            sub.add_argument("-o", "--output", required=True)
        return sub

    sub = command("extract", "records from page tables", model=True)
    sub.add_argument("pages", help="Parquet table of pages")
    sub.add_argument("--papers", help="Parquet table of papers (doc_path, page_count); needed for papers without pages to fail")
    sub.add_argument("--folder", help="folder of the papers' PDF files, in place of --papers")
    sub.add_argument("--prompt", required=True, help="file with the extraction prompt")
    sub.add_argument("--pages-per-request", type=positive, default=fixed.PAGES_PER_REQUEST)
    sub.add_argument("--image-max-mb", type=float, default=fixed.IMAGE_MAX_MB)
    sub.add_argument("--ledger", help="table of finished papers")
    sub.add_argument("--run-id", default="run")

    sub = command("generate", "training samples from records", model=True)
    sub.add_argument("input", help="JSON file with records, or JSON Lines (.jsonl file or folder)")
    sub.add_argument("--method", type=str.upper, choices=tuple(fixed.SAMPLE_FIELDS), required=True)
    sub.add_argument("--prompts", required=True, help="folder with the nine prompts of the method")
    sub.add_argument("--max-sample-chars", type=positive, default=fixed.MAX_SAMPLE_CHARS)
    sub.add_argument("--unordered", action="store_true")

    sub = command("translate", "translate text members of JSON Lines", model=True)
    sub.add_argument("input")
    sub.add_argument("--language", choices=tuple(fixed.LANGUAGES), required=True)
    sub.add_argument("--batch-size", type=positive, default=fixed.BATCH_RECORDS)
    sub.add_argument("--max-batch-chars", type=positive, default=fixed.BATCH_CHARS)

    sub = command("merge", "merge JSON Lines in order")
    sub.add_argument("inputs", nargs="+")
    sub.add_argument("-o", "--output", required=True)
    sub.add_argument("--unordered", action="store_true")
    command("count", "count records").add_argument("input")
    sub = command("task-stats", "records per task type")
    sub.add_argument("input")
    sub.add_argument("-o", "--output", help="folder for the table; without it every type is printed")
    sub = command("tokens", "token statistics per line")
    sub.add_argument("input")
    sub.add_argument("--counter", type=named, metavar="MODULE:FACTORY", help="builds a function from texts to counts")
    command("usage", "token usage of a response table").add_argument("input")
    sub = command("calibration-set", "seeded draw of chat messages")
    sub.add_argument("input")
    sub.add_argument("--calibration-samples", type=positive, default=fixed.CALIBRATION_SAMPLES)
    sub.add_argument("-o", "--output", required=True)
    sub = command("dataset-view", "columns of the training-set manifest")
    sub.add_argument("input")
    sub.add_argument("--name", choices=tuple(fixed.DATASET_VIEWS), required=True)
    sub.add_argument("-o", "--output", required=True)
    sub = command("check-records", "reports on the fields of extraction records")
    sub.add_argument("input", help="JSON file with records, or JSON Lines (.jsonl file or folder)")
    sub.add_argument("-o", "--output", required=True, help="folder for one table per report")
    return top


def records_of(spark: SparkSession, path: str):
    """(``paper_index``, ``record_json``) of a JSON file or of JSON Lines."""
    if path.lower().endswith(".json"):
        indexed = with_dense_index(read_records(spark, path), ["path", "item_no"], out="paper_index")
    else:
        def read(python_judges: bool):
            return index_records(read_jsonl(spark, [path], python_judges=python_judges), out="paper_index")

        indexed = run_strict(spark, [path], read)
        indexed = indexed.withColumnRenamed("record", "record_json")
    return indexed.select("paper_index", "record_json")


def write_errors(errors, path: str | None) -> None:
    if path:
        errors.write.json(path)


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[dict, int]:
    """The command's report and its exit code."""
    model = {}
    for target in (getattr(args, "output", None), getattr(args, "errors", None)):
        if target:
            require_new(spark, target)
    if hasattr(args, "model"):
        args.responses = args.responses or f"{args.output.rstrip('/')}.responses"
        print(f"responses: {args.responses}", file=sys.stderr)
        model = {
            "concurrency": args.concurrency, "threads": args.threads, "max_retries": args.max_retries,
            "waves": args.waves, "resume": args.resume, "responses_path": args.responses,
        }
    match args.command:
        case "extract":
            pages = spark.read.parquet(args.pages)
            if args.folder:
                papers = papers_in(spark, args.folder, pages)
            else:
                papers = spark.read.parquet(args.papers) if args.papers else pages
            papers = papers.select("doc_path", "page_count").distinct()
            prompt = spark.read.text(args.prompt, wholetext=True).first().value.strip()
            done = extract(
                papers, pages, prompt, args.model, args.pages_per_request, args.image_max_mb,
                ledger_path=args.ledger, run_id=args.run_id, **model,
            )
            written = done.write(args.output)
            write_errors(done.errors, args.errors)
            return {"written": written, **done.report()}, 0
        case "generate":
            done = generate(
                records_of(spark, args.input), read_prompts(spark, args.prompts), args.method, args.model,
                args.max_sample_chars, **model,
            )
            report = {"written": done.write(args.output, args.method, not args.unordered), **done.report()}
            write_errors(done.results.filter("error is not null").select("paper_index", "task_type", "error"), args.errors)
            return report, 1 if report["failed_calls"] else 0
        case "translate":
            done = translate(
                spark, [args.input], args.language, args.model, batch_size=args.batch_size,
                max_chars=args.max_batch_chars, **model,
            )
            written = done.write(args.output)
            write_errors(done.checked.filter("fault is not null").select("batch_no", "fault"), args.errors)
            return {"written": written, **done.report()}, 0
        case "merge":
            written = tools.merge(spark, args.inputs, args.output, not args.unordered)
            return {"files": len(args.inputs), "written": written}, 0
        case "count":
            return {"samples": tools.count(spark, args.input)}, 0
        case "task-stats":
            stats, totals = tools.task_statistics(spark, args.input)
            if args.output:
                stats.write.json(args.output)
            else:
                for row in stats.toLocalIterator():
                    print(json.dumps(row.asDict(), ensure_ascii=False))
            return totals.first().asDict(), 0
        case "tokens":
            counter = token_counter(args.counter) if args.counter else count_words
            return tools.token_statistics(spark, args.input, counter).first().asDict(), 0
        case "usage":
            return total_usage(spark.read.parquet(args.input)).first().asDict(), 0
        case "calibration-set":
            drawn = tools.calibration_set(spark, args.input, args.calibration_samples)
            drawn.select("draw_no", "messages").write.mode("errorifexists").json(args.output)
            return {}, 0
        case "dataset-view":
            tools.training_view(spark, args.input, args.name).write.mode("errorifexists").json(args.output)
            return {}, 0
        case "check-records":
            return tools.check_records(records_of(spark, args.input), args.output), 0


def main() -> int:
    args = parser().parse_args()
    builder = SparkSession.builder.appName(f"sheaf {args.command}")
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    report, code = run(builder.getOrCreate(), args)
    print(json.dumps(report, ensure_ascii=False))
    return code


if __name__ == "__main__":
    sys.exit(main())
