"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheaf.fixed import RECORD_KEYS, SAMPLE_FIELDS, TASKS
from sheaf.functions.binding import with_kept
from sheaf.functions.salvage import with_fast_json, with_json_value
from sheaf.functions.json_text import patched_object, quoted
from sheaf.operators import calibration, extraction, pages as page_ops, record_checks, requests, responses as resp
from sheaf.operators import samples, stats
from sheaf.operators import translation
from sheaf.operators.model import with_retry_class
from sheaf.operators.ordering import running_sums
from sheaf.plans.extract import extract
from sheaf.plans.generate import generate
from sheaf.plans.translate import translate_records
from sheaf.plans import tools
from sheaf.record_template import TEMPLATE
from sheaf.session import stage, staged_path
from sheaf.sources.jsonl import count_array_items as json_array_count
from sheaf.sources.jsonl import array_length, bad_lines, index_records, scan_lines, read_jsonl, require_objects, with_record
from sheaf.sources.papers import missing_prompts, pending_papers, read_ledger, read_records, records_from_text, task_table
from sheaf.sources.sinks import dataset_view, write_lines
from sheaf.streaming.intake import Waiting, start_intake, stream_pages
from workload import fixtures as fx, stubs


# -- samples --------------------------------------------------------------------------
def cpt_samples(spark, sf_dir) -> DataFrame:
    return samples.first_wins(samples.normalize_samples(fx.cpt_candidates(spark, sf_dir), "CPT"), "CPT")


def sft_samples(spark, sf_dir) -> DataFrame:
    return samples.first_wins(samples.normalize_samples(fx.sft_candidates(spark, sf_dir), "SFT"), "SFT")


def dpo_samples(spark, sf_dir) -> DataFrame:
    return samples.first_wins(samples.normalize_samples(fx.dpo_candidates(spark, sf_dir), "DPO"), "DPO")


def sample_verdicts(spark, sf_dir) -> DataFrame:
    """Kept and discarded candidates per task."""
    marked = samples.mark_samples(fx.cpt_candidates(spark, sf_dir), "CPT")
    return marked.groupBy("task_type").agg(
        F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("discarded")
    )


# -- generation requests ------------------------------------------------------------------
def _matrix(spark, sf_dir, method) -> DataFrame:
    asked = requests.generation_requests(fx.paper_records(spark, sf_dir), fx.prompts(spark), method)
    return asked.select(
        "paper_index", "task_type",
        F.length("input").cast("bigint").alias("input_chars"), F.sha2("input", 256).alias("input_sha"),
    )


def task_request_matrix(spark, sf_dir) -> DataFrame:
    return _matrix(spark, sf_dir, "SFT")


def task_request_matrix_cpt(spark, sf_dir) -> DataFrame:
    return _matrix(spark, sf_dir, "CPT")


def planned_calls(spark, sf_dir) -> DataFrame:
    return requests.planned_calls(fx.paper_records(spark, sf_dir))


def prompt_completeness(spark, sf_dir) -> DataFrame:
    """Tasks without a prompt, when the documents between them bring five of the nine."""
    five = F.array(*[F.lit(n) for n in list(TASKS)[:5]])
    names = fx.table(spark, sf_dir, "documents").select(
        F.get(five, F.pmod("doc_id", F.lit(5)).cast("int")).alias("prompt_name")
    )
    return missing_prompts(task_table(spark), names.distinct())


# -- pages -----------------------------------------------------------------------------------
def page_batches(spark, sf_dir) -> DataFrame:
    b = page_ops.page_batches(fx.pages(spark, sf_dir))
    return b.select(
        "doc_path", "batch_no", "batch_count", "start_page", "end_page",
        F.array_join("image_urls", "\n").alias("image_urls"),
    )


def page_keys(spark, sf_dir) -> DataFrame:
    p = fx.pages(spark, sf_dir)
    return p.select("doc_path", "page_no", page_ops.page_key("doc_path", "page_no").alias("object_key"))


def _guarded(spark, sf_dir):
    p = fx.pages(spark, sf_dir)
    oversized = page_ops.first_oversized_page(p)
    return page_ops.guard_oversized(page_ops.page_batches(p), oversized), oversized


def oversized_guard(spark, sf_dir) -> DataFrame:
    kept, _ = _guarded(spark, sf_dir)
    return kept.select("doc_path", "batch_no", "start_page", "end_page")


def extraction_requests(spark, sf_dir) -> DataFrame:
    kept, _ = _guarded(spark, sf_dir)
    both = [
        page_ops.extraction_requests(kept, "Read the pages.", correct).withColumn("corrected", F.lit(correct))
        for correct in (False, True)
    ]
    return both[0].unionByName(both[1]).select(
        "doc_path", "batch_no", "corrected", F.sha2("input", 256).alias("input_sha"), "max_output_tokens"
    )


def _documents(spark, sf_dir):
    kept, oversized = _guarded(spark, sf_dir)
    doc_id = F.regexp_extract("doc_path", r"(\d+)", 1).cast("bigint")
    failed = (doc_id + F.col("batch_no")) % 5 == 0
    outcomes = kept.select(
        "doc_path", "batch_no", "batch_count", "start_page", "end_page",
        F.when(failed, F.lit("no answer")).alias("error"),
    )
    papers = fx.papers(spark, sf_dir)
    fatal = extraction.fatal_errors(papers, oversized)
    return papers, outcomes, fatal


def document_status(spark, sf_dir) -> DataFrame:
    return extraction.document_results(*_documents(spark, sf_dir))


def document_errors(spark, sf_dir) -> DataFrame:
    _, outcomes, fatal = _documents(spark, sf_dir)
    return extraction.document_errors(outcomes, fatal)


def extraction_report(spark, sf_dir) -> DataFrame:
    return extraction.extraction_report(document_status(spark, sf_dir))


def pending_documents(spark, sf_dir) -> DataFrame:
    """Ledger: successful papers whose label says good quality."""
    papers = fx.papers(spark, sf_dir)
    good = fx.table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    named = papers.join(good, "doc_id", "left_semi").select("doc_path")
    done = document_status(spark, sf_dir).filter("status = 'success'").join(named, "doc_path", "left_semi")
    return pending_papers(papers, done).select("doc_path", "page_count")


def required_keys(spark, sf_dir) -> DataFrame:
    read = with_fast_json(fx.damaged_records(spark, sf_dir), "answer", "json_kind", "json")
    return extraction.with_schema_error(read).select("doc_id", "schema_error")


def record_items(spark, sf_dir) -> DataFrame:
    """Files of records: every document is one file, alternately an object and an array."""
    recs = fx.paper_records(spark, sf_dir)
    pair = F.concat(F.lit("[ "), "record_json", F.lit(" , "), "record_json", F.lit(" ]"))
    files = recs.select(
        "paper_index", F.when(F.col("paper_index") % 2 == 0, F.col("record_json")).otherwise(pair).alias("value")
    )
    return records_from_text(files).select("paper_index", "item_no", "record_json")


def array_file_records(spark, sf_dir) -> DataFrame:
    """Every item of files that hold one array of all documents' records each, as a task wrote it."""
    records = read_records(spark, fx.array_files(spark, sf_dir))
    told = F.from_json("record_json", "id bigint, text string, of array<string>")
    return records.select(told.alias("t"), "record_json").select(
        F.col("t.id").alias("doc_id"), F.sha2("t.text", 256).alias("text_sha"), F.size("t.of").alias("n_of"),
        F.length("record_json").alias("chars"),
    )


def count_array_files(spark, sf_dir) -> DataFrame:
    return json_array_count(spark, fx.array_files(spark, sf_dir))


# -- fields of records ---------------------------------------------------------------------------
def _paths(spark, sf_dir) -> DataFrame:
    return record_checks.field_paths(fx.section_records(spark, sf_dir), template=TEMPLATE)


def field_paths(spark, sf_dir) -> DataFrame:
    """Every path of every record with the kinds of its values, absent members included."""
    return _paths(spark, sf_dir)


def path_faults(spark, sf_dir) -> DataFrame:
    """Members that a record lacks, and members that its template does not know."""
    return record_checks.path_faults(_paths(spark, sf_dir))


def field_fill(spark, sf_dir) -> DataFrame:
    """How the number fields of all records are filled."""
    return record_checks.field_fill(_paths(spark, sf_dir))


def section_items(spark, sf_dir) -> DataFrame:
    return record_checks.section_items(fx.section_records(spark, sf_dir))


def orphan_samples(spark, sf_dir) -> DataFrame:
    return record_checks.orphan_samples(fx.section_records(spark, sf_dir))


def process_param_check(spark, sf_dir) -> DataFrame:
    return record_checks.process_param_check(fx.section_records(spark, sf_dir))


def technique_check(spark, sf_dir) -> DataFrame:
    return record_checks.technique_check(fx.section_records(spark, sf_dir))


# -- responses -----------------------------------------------------------------------------------
def response_text(spark, sf_dir) -> DataFrame:
    read = resp.with_response_text(fx.responses(spark, sf_dir))
    return read.select("doc_id", "text", F.col("text_error").isNotNull().alias("failed"))


def _answers(spark, sf_dir):
    told = resp.response_text("body", "error").getField("text")
    return with_kept(fx.responses(spark, sf_dir), "text", told).select("doc_id", "text")


def salvage_fast_path(spark, sf_dir) -> DataFrame:
    read = with_fast_json(_answers(spark, sf_dir), "text", "kind", "value")
    return read.select("doc_id", "kind", "value")


def salvage_answers(spark, sf_dir) -> DataFrame:
    read = with_json_value(fx.noisy_answers(spark, sf_dir), "answer", "kind", "value")
    return read.select("doc_id", "kind", "value")


def envelope_unwrap(spark, sf_dir) -> DataFrame:
    read = with_fast_json(_answers(spark, sf_dir), "text", "json_kind", "json")
    items = resp.with_items(read).select("doc_id", F.posexplode_outer("items").alias("pos", "item"))
    return items.filter("pos is not null")


def token_usage(spark, sf_dir) -> DataFrame:
    return resp.total_usage(fx.responses(spark, sf_dir))


def retry_class(spark, sf_dir) -> DataFrame:
    c = with_retry_class(fx.attempts(spark, sf_dir))
    return c.select("doc_id", "attempt", "accepted", "named_retryable", "retry", "backoff_s")


# -- translation ------------------------------------------------------------------------------------
def _payloads(spark, sf_dir) -> DataFrame:
    recs = fx.translation_input(spark, sf_dir)
    return translation.payloads(recs.select("id", fx.as_record(recs).alias("record")))


def translate_payloads(spark, sf_dir) -> DataFrame:
    return _payloads(spark, sf_dir).select("id", "payload", F.array_join("names", ",").alias("names"), "chars")


def _batches(spark, sf_dir, **limits) -> DataFrame:
    b = translation.batch_payloads(_payloads(spark, sf_dir), **limits)
    return b.select(
        "batch_no", F.size("expected").cast("bigint").alias("n_records"),
        F.get("expected", F.lit(0))["id"].alias("first_id"), F.sha2("source_json", 256).alias("source_sha"),
    )


def translate_batches(spark, sf_dir) -> DataFrame:
    return _batches(spark, sf_dir)


def translate_batches_tight(spark, sf_dir) -> DataFrame:
    return _batches(spark, sf_dir, max_chars=2000, chunk_rows=64)


def translate_requests(spark, sf_dir) -> DataFrame:
    asked = translation.translation_requests(translation.batch_payloads(_payloads(spark, sf_dir)), "en")
    return asked.select("batch_no", F.sha2("input", 256).alias("input_sha"))


def _checked(spark, sf_dir) -> DataFrame:
    """Answers derived from the batches, with a fault by batch number."""
    b = translation.batch_payloads(_payloads(spark, sf_dir), max_chars=2000)
    items = F.from_json("source_json", "array<struct<id:bigint,fields:struct<instruction:string,input:string,output:string>>>")
    no = F.col("batch_no") % 5

    def told(item, i):
        said = F.struct(*[F.concat(F.lit("T:"), item["fields"][f]).alias(f) for f in ("instruction", "input", "output")])
        extra = F.when((no == 1) & (i == 0), F.lit("x"))
        return F.struct(item["id"].alias("id"), F.struct(*[said[f].alias(f) for f in ("instruction", "input", "output")], extra.alias("extra")).alias("fields"))

    all_told = F.transform(items, told)
    cut = F.slice(all_told, F.lit(1), F.greatest(F.size(all_told) - 1, F.lit(0)))
    repeated = F.concat(all_told, F.slice(all_told, 1, 1))
    answer = F.when(no == 0, cut).when(no == 2, repeated).otherwise(all_told)
    answers = b.withColumn("json", F.to_json(answer)).withColumn("json_kind", F.lit("array"))
    return translation.check_batches(answers)


def translate_validate(spark, sf_dir) -> DataFrame:
    return _checked(spark, sf_dir).select("batch_no", F.size("expected").cast("bigint").alias("n_records"), "fault")


def translate_apply(spark, sf_dir) -> DataFrame:
    recs = fx.translation_input(spark, sf_dir)
    recs = recs.select("id", fx.as_record(recs).alias("record"))
    return translation.apply_translations(recs, translation.translated_rows(_checked(spark, sf_dir))).select("id", "record")


def record_patch(spark, sf_dir) -> DataFrame:
    """Overwrite one member of every line that has it, append it to the others; the rest and key order stay."""
    lines = require_objects(with_record(fx.json_lines(spark, sf_dir)))
    changed = patched_object("record", F.create_map(F.lit("input"), F.lit('new "input"')))
    return lines.select("src_ordinal", "line_key", changed.alias("record"))


def translate_formulas(spark, sf_dir) -> DataFrame:
    """Texts that name NaNO3 or Infinity, and numbers in exponent form, are ordinary to a translation."""
    docs = fx.documents(spark, sf_dir)
    name = F.when(F.col("doc_id") % 2 == 0, "NaNO3 ").otherwise("Infinity ")
    record = F.concat(F.lit('{"n":1.0E-7,"text":'), quoted(F.concat(name, "text")), F.lit(',"k":[null,true]}'))
    records = docs.select(F.col("doc_id").alias("id"), record.alias("record"))
    changes = docs.select(F.col("doc_id").alias("id"), F.create_map(F.lit("text"), F.concat(F.lit("new "), "lang")).alias("fields"))
    return translation.apply_translations(records, changes)


# -- files: lines written, read, merged and counted -----------------------------------------------
def _line_files(spark, sf_dir) -> list[str]:
    """The lines of each source as files of their own, in order."""
    lines = fx.json_lines(spark, sf_dir)
    folders = [staged_path(spark, f"lines-{k}") for k in range(3)]
    for k, folder in enumerate(folders):
        write_lines(lines.filter(F.col("src_ordinal") == k), folder, "value", ["line_key"])
    return folders


def merge_files(spark, sf_dir) -> DataFrame:
    """Files of lines merged into one, and read back with their positions."""
    merged = staged_path(spark, "merged")
    tools.merge(spark, _line_files(spark, sf_dir), merged)
    return index_records(read_jsonl(spark, [merged])).select("record_index", "record")


def merge_repeated_keys(spark, sf_dir) -> DataFrame:
    """Of the repeated members of a line the last counts, in the place of the first."""
    events = fx.table(spark, sf_dir, "events")
    line = F.format_string('{"a":%d,"props":%s,"a":%d}', F.col("event_id"), F.col("props"), F.col("user_id"))
    path, merged = staged_path(spark, "repeated"), staged_path(spark, "merged")
    write_lines(events.withColumn("line", line), path, "line", ["event_id"])
    tools.merge(spark, [path], merged)
    return index_records(read_jsonl(spark, [merged])).select("record_index", "record")


def count_files(spark, sf_dir) -> DataFrame:
    """Lines of each file, as the count command counts them."""
    files = _line_files(spark, sf_dir)
    found = [(k, tools.count(spark, path)) for k, path in enumerate(files)]
    return spark.createDataFrame(found, "src_ordinal int, samples bigint")


def bad_line_files(spark, sf_dir) -> DataFrame:
    """Every line of a file that is not an object, by its number and value: texts of documents between objects."""
    docs = fx.documents(spark, sf_dir)
    value = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('{"n":'), quoted("text"), F.lit("}")))
        .when(F.col("doc_id") % 3 == 1, quoted("text")).otherwise(F.concat(F.lit('{"n":'), quoted("text")))
    )
    path = staged_path(spark, "bad")
    write_lines(docs.withColumn("value", value), path, "value", ["doc_id"])
    # a line's number is its own file's; the files, read by name, are in order
    sizes = scan_lines(spark, [path]).groupBy("path").count()
    before = running_sums(stage(sizes, "sizes"), ["path"], {"count": "before"}).select("path", "before")
    return bad_lines(spark, [path]).join(before, "path").select(
        (F.col("before") + F.col("line_no")).alias("line"), "problem", F.sha2("value", 256).alias("value_sha")
    )


def ledger_round(spark, sf_dir) -> DataFrame:
    """Papers by what the ledger says once the records are on disk."""
    ledger = staged_path(spark, "ledger")
    done = _extracted(spark, sf_dir, ledger_path=ledger)
    path = staged_path(spark, "records")
    done.write(path)
    written = read_jsonl(spark, [path]).count()
    papers = fx.papers(spark, sf_dir).select("doc_path")
    pending = pending_papers(papers, read_ledger(spark, ledger)).withColumn("pending", F.lit(True))
    return papers.join(pending, "doc_path", "left").select(
        "doc_path", F.coalesce("pending", F.lit(False)).alias("pending"), F.lit(written).cast("bigint").alias("records_on_disk")
    )


def intake_rounds(spark, sf_dir) -> DataFrame:
    """Papers by the ledger of a streamed intake: odd pages come first, then the rest, then only another try."""
    folder, ledger, checkpoint = (staged_path(spark, n) for n in ("pages", "ledger", "intake"))

    def run_batch(pages, run_id):
        papers = pages.select("doc_path", "page_count").distinct()
        done = extract(papers, pages, "|".join(RECORD_KEYS), stubs.read_pages, backoff_s=0.0, ledger_path=ledger, run_id=run_id)
        done.write(staged_path(spark, "records"))

    pages = fx.pages(spark, sf_dir).drop("doc_id")
    for arrived in (pages.filter("page_no % 2 = 1"), pages.filter("page_no % 2 = 0"), None):
        if arrived is not None:
            arrived.write.mode("append").parquet(folder)
        start_intake(stream_pages(spark, folder), run_batch, checkpoint, ledger, retry_after=0).awaitTermination()
    papers = fx.papers(spark, sf_dir).select("doc_path")
    waiting = Waiting(spark, ledger).pages().groupBy("doc_path").agg(F.count(F.lit(1)).alias("pages"))
    pending = pending_papers(papers, read_ledger(spark, ledger)).withColumn("pending", F.lit(True))
    return papers.join(pending, "doc_path", "left").join(waiting, "doc_path", "left").select(
        "doc_path", F.coalesce("pending", F.lit(False)).alias("pending"),
        F.coalesce("pages", F.lit(0).cast("bigint")).alias("waiting_pages"),
    )


# -- JSON lines -------------------------------------------------------------------------------------------
def merge_jsonl(spark, sf_dir) -> DataFrame:
    return require_objects(with_record(fx.json_lines(spark, sf_dir))).select("src_ordinal", "line_key", "record")


def count_records(spark, sf_dir) -> DataFrame:
    return stats.count_records(require_objects(with_record(fx.json_lines(spark, sf_dir))))


def count_array_items(spark, sf_dir) -> DataFrame:
    """One JSON array per document, holding as many items as the document number says."""
    docs = fx.documents(spark, sf_dir)
    items = F.array_repeat(F.concat(quoted("text"), F.lit(" , [1,{}]")), (F.col("doc_id") % 4).cast("int"))
    arrays = docs.select("doc_id", F.concat(F.lit(" ["), F.array_join(items, ","), F.lit("]")).alias("value"))
    counted = arrays.select("doc_id", array_length("value", F.col("doc_id").cast("string")).alias("n"))
    return counted.groupBy("n").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("samples"))


def sample_lines(spark, sf_dir) -> DataFrame:
    """The lines a writer would put out."""
    kept = samples.normalize_samples(fx.dpo_candidates(spark, sf_dir), "DPO")
    return kept.select("paper_index", "pos", F.to_json(F.struct(*SAMPLE_FIELDS["DPO"])).alias("line"))


def _task_counts(spark, sf_dir):
    lines = require_objects(with_record(fx.json_lines(spark, sf_dir)))
    lines = lines.withColumn("record_index", F.col("src_ordinal") * F.lit(10**12) + F.col("line_key"))
    # read twice below: for the shares and for their denominator
    return stage(stats.task_counts(lines, stats.record_task_type()), "task-counts")


def task_stats(spark, sf_dir) -> DataFrame:
    return stats.task_stats(_task_counts(spark, sf_dir)).select(
        "task_type", "count", "proportion", "percent", "first_at"
    )


def task_totals(spark, sf_dir) -> DataFrame:
    return stats.task_totals(_task_counts(spark, sf_dir))


def token_stats(spark, sf_dir) -> DataFrame:
    lines = fx.json_lines(spark, sf_dir).select(F.concat("value", F.lit("\n")).alias("value"))
    return stats.token_stats(lines)


def record_index(spark, sf_dir) -> DataFrame:
    from sheaf.operators.ordering import with_dense_index

    return with_dense_index(fx.table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id", "event_id"])


# -- calibration and views ------------------------------------------------------------------------------------
def _calibration(spark, sf_dir) -> DataFrame:
    lines = require_objects(with_record(fx.json_lines(spark, sf_dir)), skip_others=True)
    return calibration.calibration_records(lines.select("src_ordinal", "line_key", "record"))


def calibration_pairs(spark, sf_dir) -> DataFrame:
    m = calibration.with_messages(_calibration(spark, sf_dir))
    return m.select("line_key", *[
        F.get("messages", F.lit(i))["content"].alias(name) for i, name in enumerate(("asked", "answered"))
    ])


def calibration_sample(spark, sf_dir) -> DataFrame:
    from sheaf.operators.ordering import with_dense_index

    usable = _calibration(spark, sf_dir).select("line_key", "instruction", "input", "output")
    # range partitioning samples its input first, so parse the lines only once
    indexed = with_dense_index(stage(usable, "usable"), ["line_key"], out="usable_index")
    return calibration.seeded_draw(indexed, "usable_index").select("draw_no", "usable_index", "line_key", "instruction")


def calibration_draw(spark, sf_dir) -> DataFrame:
    """What holds for any seeded draw: how many, numbered without gaps, distinct, all of them usable records."""
    drawn = stage(calibration_sample(spark, sf_dir), "drawn")
    usable = _calibration(spark, sf_dir).select("line_key", F.lit(1).alias("usable"))
    return drawn.join(usable, "line_key", "left").agg(
        F.count(F.lit(1)).alias("drawn"), F.count_distinct("draw_no").alias("numbers"),
        F.min("draw_no").cast("bigint").alias("least"), F.max("draw_no").cast("bigint").alias("most"),
        F.count_distinct("line_key").alias("records"), F.count("usable").alias("usable"),
    )


def dataset_view_files(spark, sf_dir) -> DataFrame:
    """The training view of a file of lines, some with repeated members and NaN, which other tools take too."""
    docs = fx.documents(spark, sf_dir)
    value = F.concat(
        F.lit('{"text":'), F.when(F.col("doc_id") % 4 == 0, F.lit('"first","n":NaN,"text":')).otherwise(F.lit("")),
        quoted("text"), F.lit("}"),
    )
    path = staged_path(spark, "view")
    write_lines(docs.withColumn("value", value), path, "value")
    return tools.training_view(spark, path, "cpt").select(F.sha2("prompt", 256).alias("prompt_sha"))


def dataset_view_sft(spark, sf_dir) -> DataFrame:
    return dataset_view(sft_samples(spark, sf_dir), "sft")


def dataset_view_cpt(spark, sf_dir) -> DataFrame:
    return dataset_view(cpt_samples(spark, sf_dir), "cpt")


# -- whole jobs with a deterministic model -----------------------------------------------------------------------
def _generated(spark, sf_dir):
    return generate(
        fx.paper_records(spark, sf_dir), fx.prompts(spark), "CPT", stubs.write_samples, max_retries=1, backoff_s=0.0
    )


def generated_samples(spark, sf_dir) -> DataFrame:
    return _generated(spark, sf_dir).samples


def generation_report(spark, sf_dir) -> DataFrame:
    return samples.generation_report(_generated(spark, sf_dir).results)


def generated_calls(spark, sf_dir) -> DataFrame:
    r = _generated(spark, sf_dir).results
    return r.select("paper_index", "task_type", "n_samples", "n_discarded", F.col("error").isNotNull().alias("failed"))


def _extracted(spark, sf_dir, **options):
    pages = fx.pages(spark, sf_dir).drop("doc_id")
    papers = fx.papers(spark, sf_dir).drop("doc_id")
    return extract(papers, pages, "|".join(RECORD_KEYS), stubs.read_pages, backoff_s=0.0, **options)


def extracted_status(spark, sf_dir) -> DataFrame:
    return _extracted(spark, sf_dir).results


def extracted_parts(spark, sf_dir) -> DataFrame:
    return _extracted(spark, sf_dir).parts


def _translated(spark, sf_dir):
    recs = fx.translation_input(spark, sf_dir)
    recs = recs.select("id", fx.as_record(recs).alias("record"))
    return translate_records(recs, "zh", stubs.translate_batch, max_chars=2000, backoff_s=0.0)


def translated_records(spark, sf_dir) -> DataFrame:
    return _translated(spark, sf_dir).records


def translation_report(spark, sf_dir) -> DataFrame:
    return translation.translation_report(_translated(spark, sf_dir).checked)


QUERIES = [
    cpt_samples, sft_samples, dpo_samples, sample_verdicts,
    task_request_matrix, task_request_matrix_cpt, planned_calls, prompt_completeness,
    page_batches, page_keys, oversized_guard, extraction_requests,
    document_status, document_errors, extraction_report, pending_documents, required_keys, record_items,
    array_file_records, count_array_files,
    field_paths, path_faults, field_fill, section_items, orphan_samples, process_param_check, technique_check,
    response_text, salvage_fast_path, salvage_answers, envelope_unwrap, token_usage, retry_class,
    translate_payloads, translate_batches, translate_batches_tight, translate_requests,
    translate_validate, translate_apply, translate_formulas, record_patch,
    merge_files, merge_repeated_keys, count_files, bad_line_files, ledger_round, intake_rounds,
    merge_jsonl, count_records, count_array_items, sample_lines, task_stats, task_totals, token_stats, record_index,
    calibration_pairs, calibration_sample, calibration_draw, dataset_view_files, dataset_view_sft, dataset_view_cpt,
    generated_samples, generated_calls, generation_report, extracted_status, extracted_parts,
    translated_records, translation_report,
]
