"""Whole jobs with a deterministic model, on small inputs."""

import json
import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sheaf.fixed import CORRECTION_TEXT, RECORD_KEYS, TASKS, TRANSLATION_TEXT
from sheaf.operators.requests import generation_requests, planned_calls
from sheaf.operators.translation import check_batches
from sheaf.plans.extract import extract
from sheaf.plans.generate import generate
from sheaf.plans.translate import translate
from sheaf.plans.tools import merge
from sheaf.session import staged_path
from sheaf.sources.jsonl import JsonlError
from sheaf.streaming.intake import Waiting, start_intake, stream_pages

cloudpickle.register_pickle_by_value(sys.modules[__name__])
WHOLE = json.dumps({k: None for k in RECORD_KEYS}, ensure_ascii=False, separators=(",", ":"))


def said(text, **more):
    return 200, json.dumps({"output_text": text, "usage": {"input_tokens": 3, "output_tokens": 2}, **more})


def prompts_of(spark):
    return spark.createDataFrame([(n, t, f"P {t}") for n, t in TASKS.items()], "prompt_name string, task_type string, prompt string")


def test_generation_request_text(spark):
    records = spark.createDataFrame([(3, ' { "b" : "é", "a":[1] } ')], "paper_index bigint, record_json string")
    rows = {r.task_type: r for r in generation_requests(records, prompts_of(spark), "SFT", 500).collect()}
    assert set(rows) == set(TASKS.values()) and len({r.request_id for r in rows.values()}) == 9
    content = json.loads(rows["literature_qa"].input)[0]["content"]
    assert content.startswith("P literature_qa\n\n硬性要求：\n1. ")
    assert "不得超过 500 个字符" in content
    assert '格式必须为：[{"task_type":"literature_qa","instruction":"...","input":"...","output":"..."}]\n\n' in content
    assert content.endswith('文献 JSON：\n{"b":"é","a":[1]}')
    assert planned_calls(records).first().calls == 9


def test_generate(spark, tmp_path):
    def model(request):
        content = json.loads(request["input"])[0]["content"]
        task, paper = content.split("\n")[0][2:], json.loads(content.split("\n")[-1])["id"]
        if task == "anomaly_detection":
            return said("x", status="failed", error={"message": "no"})
        if task == "literature_qa":
            return said("nothing to say")
        if task == "mechanism_explanation":
            return said("[]")
        return said("Well: " + json.dumps([{"text": f" p{paper} "}, {"text": "same"}, 5, {"text": ""}]))

    records = spark.createDataFrame([(i, json.dumps({"id": i})) for i in range(3)], "paper_index bigint, record_json string")
    done = generate(records, prompts_of(spark), "CPT", model, backoff_s=0.0, concurrency=2)
    assert done.report() == {
        "calls": 27, "failed_calls": 6, "kept": 3 * 6 * 2, "discarded": 18,
        "regular_input_tokens": 81, "cached_input_tokens": 0, "output_tokens": 54,
    }
    results = {(r.paper_index, r.task_type): r for r in done.results.collect()}
    assert len(results) == 27
    assert "reported an error" in results[0, "anomaly_detection"].error and "no JSON" in results[0, "literature_qa"].error
    empty = results[1, "mechanism_explanation"]
    assert (empty.n_samples, empty.n_discarded, empty.error) == (0, 0, None)
    out = str(tmp_path / "out")
    assert done.write(out, "CPT") == 4
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    lines = "".join(open(os.path.join(out, p), encoding="utf-8").read() for p in parts).split("\n")
    assert lines == ['{"text":"p0"}', '{"text":"same"}', '{"text":"p1"}', '{"text":"p2"}', ""]


def page_rows(spec):
    return [(p, i + 1, n, 10, f"u/{p}/{i + 1}") for p, n in spec.items() for i in range(n)]


PAGES = "doc_path string, page_no int, page_count int, image_bytes_len bigint, image_url string"


def reading_model(request):
    content = json.loads(request["input"])[0]["content"]
    first = content[0]["image_url"]
    corrected = content[-1]["text"] == CORRECTION_TEXT
    if "/mended/" in first and not corrected:
        return said('{"文献元数据":1}')
    if "/never/" in first:
        return said("[]" if corrected else "prose")
    if "/down/" in first:
        return 500, "down"
    return said("```json\n" + WHOLE + "\n```")


def test_extract(spark, tmp_path):
    spec = {"ok": 3, "mended": 2, "never": 1, "down": 1, "none": 0}
    pages = spark.createDataFrame(page_rows(spec), PAGES)
    papers = spark.createDataFrame(list(spec.items()), "doc_path string, page_count int")
    ledger = staged_path(spark, "ledger")
    got = extract(papers, pages, "read", reading_model, pages_per_request=2, ledger_path=ledger, max_retries=1, backoff_s=0.0)
    assert {r.doc_path: r.status for r in got.results.collect()} == {
        "ok": "success", "mended": "success", "never": "failed", "down": "failed", "none": "failed"}
    errors = {r.doc_path: r.error for r in got.errors.collect()}
    assert errors["never"].startswith("part 1/1 (page 1-1): no complete record after 2 attempt(s): ")
    assert "not an object" in errors["never"] and "HTTP 500" in errors["down"] and "2 attempt" not in errors["down"]
    assert sorted((r.doc_path, r.batch_no) for r in got.parts.collect()) == [("mended", 1), ("ok", 1), ("ok", 2)]
    assert got.parts.first().record_json == WHOLE
    report = got.report()
    assert (report["papers"], report["parts"], report["papers_without_parts"]) == (5, 3, 3)
    assert report["output_tokens"] == 2 * (2 + 2 + 2)  # both passes count, failed transport does not
    assert got.write(str(tmp_path / "records")) == 3
    again = extract(papers, pages, "read", reading_model, pages_per_request=2, ledger_path=ledger, max_retries=0, backoff_s=0.0)
    assert sorted(r.doc_path for r in again.results.collect()) == ["down", "never", "none"]


def test_calls_are_spread_however_short_their_batches(spark, tmp_path):
    """Batches of a few bytes would share one partition, and one task would make all calls."""
    tasks = str(tmp_path / "tasks")

    def model(request):
        from pyspark import TaskContext

        with open(tasks, "a") as f:
            f.write(f"{TaskContext.get().partitionId()}\n")
        return said("prose")

    spec = {f"p{i}": 1 for i in range(40)}
    papers = spark.createDataFrame(list(spec.items()), "doc_path string, page_count int")
    got = extract(papers, spark.createDataFrame(page_rows(spec), PAGES), "read", model, max_retries=0, backoff_s=0.0)
    assert got.results.count() == 40
    told = open(tasks).read().split()
    # both passes: the second asks all of them again
    assert len(told) == 80
    assert all(len(set(told[k : k + 40])) > 1 for k in (0, 40))


def test_intake_hands_over_new_pages_of_unfinished_papers(spark, tmp_path):
    folder, ledger = str(tmp_path / "pages"), staged_path(spark, "ledger")
    seen = []

    def run_batch(pages, run_id):
        papers = pages.select("doc_path", "page_count").distinct()
        seen.append(sorted(r.doc_path for r in papers.collect()))
        done = extract(papers, pages, "read", reading_model, ledger_path=ledger, run_id=run_id, max_retries=0, backoff_s=0.0)
        done.write(str(tmp_path / run_id))

    def arrive(spec):
        spark.createDataFrame(page_rows(spec), PAGES).coalesce(1).write.mode("append").parquet(folder)

    def run():
        query = start_intake(stream_pages(spark, folder), run_batch, str(tmp_path / "cp"), ledger)
        query.awaitTermination()

    arrive({"a": 1, "down": 1})
    run()
    arrive({"a": 1, "b": 2, "down": 1})
    run()
    run()
    assert seen == [["a", "down"], ["b", "down"]]
    assert sorted(r.doc_path for r in spark.read.parquet(ledger).collect()) == ["a", "b"]
    # a paper whose pages come in two files waits for the second; a failed one comes back unasked
    rows = page_rows({"split": 2})
    for part in (rows[:1], rows[1:]):
        spark.createDataFrame(part, PAGES).coalesce(1).write.mode("append").parquet(folder)
        run()
    assert seen[2:] == [["down"], ["down", "split"]]
    assert spark.read.parquet(ledger).filter("doc_path = 'split'").count() == 1


def test_failed_papers_come_back_without_new_files(spark, tmp_path):
    folder, ledger = str(tmp_path / "pages"), staged_path(spark, "ledger")
    seen, up = [], tmp_path / "up"

    def model(request):
        return reading_model(request) if up.exists() or "down" not in request["input"] else (500, "down")

    def run_batch(pages, run_id):
        papers = pages.select("doc_path", "page_count").distinct()
        seen.append(sorted(r.doc_path for r in papers.collect()))
        if "down" in seen[-1] and up.exists():
            pages = pages.withColumn("image_url", F.regexp_replace("image_url", "down", "ok"))
        done = extract(papers, pages, "read", model, ledger_path=ledger, run_id=run_id, max_retries=0, backoff_s=0.0)
        done.write(str(tmp_path / run_id))

    def run(retry_after):
        start_intake(stream_pages(spark, folder), run_batch, str(tmp_path / "cp"), ledger, retry_after=retry_after).awaitTermination()

    rows = page_rows({"a": 1, "down": 1, "split": 2})
    spark.createDataFrame(rows[:-1], PAGES).coalesce(1).write.mode("append").parquet(folder)
    run(3600)
    assert seen == [["a", "down"]]
    waiting = Waiting(spark, ledger)
    assert sorted((r.doc_path, r.page_no) for r in waiting.pages().collect()) == [("down", 1), ("split", 1)]
    logged = sorted(os.listdir(waiting.pages_path))
    run(3600)  # no new file, and it is too early to try again
    assert seen == [["a", "down"]]
    run(0)  # no new file; the model is still down
    assert seen[1:] == [["down"]]
    up.touch()
    run(0)
    assert seen[2:] == [["down"]] and spark.read.parquet(ledger).filter("doc_path = 'down'").count() == 1
    run(0)
    assert len(seen) == 3 and sorted(os.listdir(waiting.pages_path)) == logged  # nothing unchanged was written again
    waiting.compact()
    assert [(r.doc_path, r.page_no) for r in waiting.pages().collect()] == [("split", 1)]
    spark.createDataFrame(rows[-1:], PAGES).coalesce(1).write.mode("append").parquet(folder)
    run(3600)
    assert seen[3:] == [["split"]]


def test_a_running_intake_tries_again_by_itself(spark, tmp_path):
    folder, ledger = str(tmp_path / "pages"), staged_path(spark, "ledger")
    seen = []
    spark.createDataFrame(page_rows({"x": 1}), PAGES).coalesce(1).write.parquet(folder)
    query = start_intake(
        stream_pages(spark, folder), lambda pages, run_id: seen.append([r.doc_path for r in pages.collect()]),
        str(tmp_path / "cp"), ledger, trigger={"processingTime": "1 second"}, retry_after=0,
    )
    end = time.monotonic() + 60
    while len(seen) < 3 and time.monotonic() < end and query.isActive:
        time.sleep(0.5)
    query.stop()
    assert len(seen) >= 3 and all(s == ["x"] for s in seen)


def test_papers_stay_pending_until_their_records_are_written(spark, tmp_path):
    pages = spark.createDataFrame(page_rows({"a": 1, "b": 2}), PAGES)
    papers = pages.select("doc_path", "page_count").distinct()
    ledger = staged_path(spark, "ledger")
    (tmp_path / "there").mkdir()
    done = extract(papers, pages, "read", reading_model, ledger_path=ledger, backoff_s=0.0)
    with pytest.raises(FileExistsError):
        done.write(str(tmp_path / "there"))
    again = extract(papers, pages, "read", reading_model, ledger_path=ledger, backoff_s=0.0)
    assert again.write(str(tmp_path / "records")) == 2
    assert extract(papers, pages, "read", reading_model, ledger_path=ledger, backoff_s=0.0).results.count() == 0


def test_translations_are_joined_once(spark, tmp_path):
    from sheaf.operators.translation import apply_translations

    rows = [(i, json.dumps({"text": f"t{i}", "x": float("nan") if i % 3 else "NaN"})) for i in range(6)]
    spark.createDataFrame(rows, "id bigint, record string").write.parquet(str(tmp_path / "r"))
    spark.createDataFrame([(i, {"text": f"T{i}"}) for i in range(5)], "id bigint, fields map<string,string>").write.parquet(str(tmp_path / "t"))
    got = apply_translations(spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "t")))
    assert {r.id: json.loads(r.record)["text"] for r in got.collect()} == {i: f"T{i}" for i in range(5)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and plan.count("Join") == 1


def test_translate(spark, tmp_path):
    def model(request):
        items = json.loads(json.loads(request["input"])[0]["content"].split("Source JSON:\n")[1])
        for item in items:
            item["fields"] = {k: v.upper() for k, v in item["fields"].items()}
        if any(i["id"] == 7 for i in items):
            items[0]["fields"]["extra"] = "x"
        return said(json.dumps(items + items[:1]))

    records = [{"n": i, "text": f"t{i}", "z": {"text": "keep"}, "prompt": " "} for i in range(11)] + [{"only": 1}]
    records[4]["z"] = {"x": [float("-inf"), "NaN"], "text": 1}
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    done = translate(spark, [str(path)], "en", model, batch_size=3, backoff_s=0.0)
    got = [json.loads(r.record) for r in done.records.orderBy("id").collect()]
    assert got == [{**r, "text": r["text"].upper()} if "text" in r else r for r in records if r.get("n") not in (6, 7, 8)]
    report = done.report()
    assert {k: report[k] for k in ("records", "batches", "failed_batches", "translated", "untranslated")} == {
        "records": 12, "batches": 4, "failed_batches": 1, "translated": 9, "untranslated": 3}
    assert done.write(str(tmp_path / "out")) == 9
    path.write_text('{"a":1}\n[2]\n', encoding="utf-8")
    with pytest.raises(JsonlError, match="in.jsonl:2"):
        translate(spark, [str(path)], "en", model)


def test_translation_checks(spark):
    sent = [(0, ["text"]), (1, ["input", "text"]), (2, [])]
    good = [{"id": 0, "fields": {"text": "T"}}, {"id": 1, "fields": {"text": "U", "input": "I"}}, {"id": 2, "fields": {}}]

    def changed(i, **kw):
        return [{**g, **kw} if g["id"] == i else g for g in good]

    cases = {
        "good": (good, None),
        "other order": (good[::-1], None),
        "repeated": (good + [{"id": 0, "fields": {"text": "last"}}], None),
        "true is one": (changed(1, id=True), None),
        "missing": (good[:2], "missing"),
        "text id": (changed(0, id="0"), "no usable id"),
        "float id": (changed(0, id=0.0), "no usable id"),
        "no id": ([{"fields": {}}], "no usable id"),
        "not an object": (good + ["x"], "no usable id"),
        "foreign id": (good + [{"id": 9, "fields": {}}], "not asked for: 9"),
        "no fields": (changed(2, fields=None), "not asked for: 2"),
        "list fields": (changed(2, fields=[]), "not asked for: 2"),
        "number": (changed(0, fields={"text": 5}), "than were sent for id 0"),
        "lacks one": (changed(1, fields={"text": "U"}), "than were sent for id 1"),
        "has one more": (changed(2, fields={"text": "U"}), "than were sent for id 2"),
        "bad repeat": (good + [{"id": 0, "fields": {"text": None}}], "than were sent for id 0"),
        "object": ({"id": 0}, "not an array"),
    }
    rows = [(n, sent, "object" if isinstance(c[0], dict) else "array", json.dumps(c[0])) for n, c in cases.items()]
    schema = "n string, expected array<struct<id:bigint,names:array<string>>>, json_kind string, json string"
    for r in check_batches(spark.createDataFrame([*rows, ("none", sent, None, None)], schema)).collect():
        fault = "no JSON" if r.n == "none" else cases[r.n][1]
        assert (r.fault is None) == (fault is None) and (fault or "") in (r.fault or ""), (r.n, r.fault)
        assert (r.translated is None) == (fault is not None)
        if r.n == "repeated":
            assert [(t.id, t.fields) for t in r.translated] == [(0, {"text": "last"}), (1, {"text": "U", "input": "I"}), (2, {})]


def test_nothing_to_do(spark, tmp_path):
    pages = spark.createDataFrame([], PAGES)
    done = extract(pages.select("doc_path", "page_count"), pages, "read", reading_model, ledger_path=staged_path(spark, "ledger"))
    assert done.report()["papers"] == 0 and done.write(str(tmp_path / "records")) == 0
    records = spark.createDataFrame([], "paper_index bigint, record_json string")
    none = generate(records, prompts_of(spark), "SFT", reading_model)
    assert none.report()["calls"] == 0 and none.write(str(tmp_path / "samples"), "SFT") == 0
    (tmp_path / "empty.jsonl").write_text("\n \n")
    empty = [str(tmp_path / "empty.jsonl")]
    blank = translate(spark, empty, "zh", reading_model)
    assert blank.report()["batches"] == 0 and blank.write(str(tmp_path / "zh")) == 0
    assert merge(spark, empty, str(tmp_path / "merged")) == 0


def test_a_third_of_all_samples_may_be_one_sample(spark):
    """Copies are combined before the shuffle: what leaves a task does not grow with them."""
    hot = "x" * 200
    rows = spark.range(30000).selectExpr(
        "id AS paper_index", "'literature_qa' AS task_type", "0 AS pos",
        f"IF(id % 3 = 0, '{hot}', concat('t', id)) AS text")
    from sheaf.operators.samples import first_wins

    df = first_wins(rows, "CPT")
    assert df.count() == 20001
    assert df.filter(F.col("text") == hot).first().paper_index == 0
