"""The command line, argument by argument."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle

from sheaf.__main__ import parser, run
from sheaf.fixed import RECORD_KEYS, TASKS

cloudpickle.register_pickle_by_value(sys.modules[__name__])
HERE = __name__


def model(request):
    content = json.loads(request["input"])[0]["content"]
    if isinstance(content, list):
        answer = json.dumps({k: [] for k in RECORD_KEYS}, ensure_ascii=False)
    elif "Source JSON:\n" in content:
        answer = content.split("Source JSON:\n")[1]
    else:
        answer = '[{"prompt":"p","chosen":"c","rejected":"r"}]'
    return 200, json.dumps({"output_text": answer, "usage": {"output_tokens": 1}})


def characters():
    return lambda texts: [len(t) for t in texts]


def call(spark, *words):
    return run(spark, parser().parse_args([str(w) for w in words]))


def lines_in(folder):
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    return [json.loads(l) for p in parts for l in open(os.path.join(folder, p), encoding="utf-8")]


def test_extract_generate_translate(spark, tmp_path):
    rows = [(f"d{d}", p, 3, 10, f"u/{d}/{p}") for d in range(2) for p in (1, 2, 3)]
    spark.createDataFrame(
        rows, "doc_path string, page_no int, page_count int, image_bytes_len bigint, image_url string"
    ).write.parquet(str(tmp_path / "pages"))
    (tmp_path / "prompt.md").write_text("read", encoding="utf-8")
    prompts = tmp_path / "DPO"
    prompts.mkdir()
    for name in TASKS:
        (prompts / f"{name}.md").write_text(name, encoding="utf-8")
    using = ("--model", f"{HERE}:model")

    report, code = call(spark, "extract", tmp_path / "pages", "--prompt", tmp_path / "prompt.md", "--pages-per-request", 2,
                        "-o", tmp_path / "records", "--responses", tmp_path / "told", *using)
    assert (report["written"], report["parts"], report["successful"], code) == (4, 4, 2, 0)
    assert call(spark, "usage", tmp_path / "told")[0]["output_tokens"] == 4

    report, code = call(spark, "generate", tmp_path / "records", "--method", "dpo", "--prompts", prompts, "-o", tmp_path / "out", *using)
    assert (report["written"], report["calls"], report["kept"], code) == (1, 36, 36, 0)
    assert lines_in(tmp_path / "out") == [{"prompt": "p", "chosen": "c", "rejected": "r"}]

    (tmp_path / "one.json").write_text('{"a":1}', encoding="utf-8")
    report, _ = call(spark, "generate", tmp_path / "one.json", "--method", "CPT", "--prompts", prompts, "-o", tmp_path / "none", *using)
    assert (report["written"], report["calls"], report["discarded"]) == (0, 9, 9)

    report, _ = call(spark, "translate", tmp_path / "out", "--language", "zh", "-o", tmp_path / "zh", *using)
    assert (report["written"], report["translated"]) == (1, 1)
    assert lines_in(tmp_path / "zh") == lines_in(tmp_path / "out")


def test_tools(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    records = [{"task_type": "t", "instruction": f"i{n}", "input": "", "output": "o"} for n in range(3)]
    path.write_text("".join(json.dumps(r) + "\n" for r in records), encoding="utf-8")
    assert call(spark, "count", path)[0] == {"samples": 3}
    assert call(spark, "task-stats", path)[0] == {"total": 3, "missing": 0}
    assert call(spark, "merge", path, path, "-o", tmp_path / "m")[0] == {"files": 2, "written": 6}
    assert lines_in(tmp_path / "m") == records * 2
    assert call(spark, "tokens", path, "--counter", f"{HERE}:characters")[0]["total_tokens"] == path.stat().st_size
    call(spark, "calibration-set", path, "--calibration-samples", 2, "-o", tmp_path / "c")
    assert len(lines_in(tmp_path / "c")) == 2
    call(spark, "dataset-view", path, "--name", "sft", "-o", tmp_path / "v")
    assert lines_in(tmp_path / "v") == [{"prompt": f"i{n}", "query": "", "response": "o"} for n in range(3)]


def test_records_are_checked(spark, tmp_path):
    records = [{k: None for k in RECORD_KEYS}, {"喷涂工艺参数": [{"样品/涂层编号": "S1", "喷涂技术类型": "x"}], "热物理性能": [{"样品/涂层编号": "S2"}]}]
    path = tmp_path / "records.json"
    path.write_text(json.dumps(records, ensure_ascii=False), encoding="utf-8")
    report, _ = call(spark, "check-records", path, "-o", tmp_path / "checked")
    assert (report["orphan_samples"], report["techniques"], report["process_params"]) == (1, 1, 0)
    orphan = lines_in(tmp_path / "checked" / "orphan_samples")
    assert orphan == [{"paper_index": 1, "section": "热物理性能", "sample_no": "S2", "n": 1}]
    assert {"paper_index": 1, "path": "/文献元数据", "fault": "absent", "kind": "absent", "n": 1} in lines_in(tmp_path / "checked" / "path_faults")
    with pytest.raises(FileExistsError):
        call(spark, "check-records", path, "-o", tmp_path / "checked")


def test_papers_of_a_folder_fail_without_pages(spark, tmp_path):
    spark.createDataFrame(
        [("/scans/a.pdf", 1, 1, 10, "u")], "doc_path string, page_no int, page_count int, image_bytes_len bigint, image_url string"
    ).write.parquet(str(tmp_path / "pages"))
    (tmp_path / "prompt.md").write_text("read", encoding="utf-8")
    (tmp_path / "pdf").mkdir()
    for name in ("a.pdf", "empty.pdf", "note.txt"):
        (tmp_path / "pdf" / name).write_text("x", encoding="utf-8")
    report, _ = call(spark, "extract", tmp_path / "pages", "--folder", tmp_path / "pdf", "--prompt", tmp_path / "prompt.md",
                     "-o", tmp_path / "records", "--errors", tmp_path / "errors", "--model", f"{HERE}:model")
    assert (report["papers"], report["successful"], report["written"]) == (2, 1, 1)
    (error,) = lines_in(tmp_path / "errors")
    assert error["doc_path"].endswith("/empty.pdf")


def test_every_task_type_is_printed(spark, tmp_path, capsys):
    path = tmp_path / "many.jsonl"
    path.write_text("".join(json.dumps({"task_type": f"type {n}"}) + "\n" for n in range(1500)), encoding="utf-8")
    assert call(spark, "task-stats", path)[0]["total"] == 1500
    assert len({json.loads(x)["task_type"] for x in capsys.readouterr().out.splitlines()}) == 1500
    call(spark, "task-stats", path, "-o", tmp_path / "table")
    assert len(lines_in(tmp_path / "table")) == 1500


def test_existing_targets_are_refused_before_any_call(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text":"x"}\n', encoding="utf-8")
    (tmp_path / "there").mkdir()
    for more in (("-o", tmp_path / "there"), ("-o", tmp_path / "new", "--errors", tmp_path / "there")):
        with pytest.raises(FileExistsError):
            call(spark, "translate", tmp_path / "a.jsonl", "--language", "zh", "--model", f"{HERE}:never", *more)
    assert sorted(os.listdir(tmp_path)) == ["a.jsonl", "there"]


def never(request):
    raise AssertionError("no call was to be made")


def test_papers_without_pages_fail_and_errors_are_written(spark, tmp_path):
    spark.createDataFrame(
        [("a", 1, 1, 10, "u")], "doc_path string, page_no int, page_count int, image_bytes_len bigint, image_url string"
    ).write.parquet(str(tmp_path / "pages"))
    spark.createDataFrame([("a", 1), ("empty", 0)], "doc_path string, page_count int").write.parquet(str(tmp_path / "papers"))
    (tmp_path / "prompt.md").write_text("read", encoding="utf-8")
    report, _ = call(spark, "extract", tmp_path / "pages", "--papers", tmp_path / "papers", "--prompt", tmp_path / "prompt.md",
                     "-o", tmp_path / "records", "--errors", tmp_path / "errors", "--model", f"{HERE}:model")
    assert (report["papers"], report["written"]) == (2, 1)
    assert [e["doc_path"] for e in lines_in(tmp_path / "errors")] == ["empty"]
    assert (tmp_path / "records.responses").is_dir()
