"""Page batches, keys, guards and the roll-up per paper."""

import hashlib
import json

from pyspark.sql import functions as F

from sheaf.fixed import CORRECTION_TEXT, RECORD_KEYS
from sheaf.operators import extraction
from sheaf.operators.pages import (
    extraction_requests,
    first_oversized_page,
    guard_oversized,
    image_limit,
    page_batches,
    page_key,
)

MB = 1024 * 1024


def pages_of(spark, spec):
    """spec: path -> list of page sizes."""
    rows = [(p, i + 1, len(s), n, f"u/{p}/{i + 1}") for p, s in spec.items() for i, n in enumerate(s)]
    return spark.createDataFrame(rows, "doc_path string, page_no int, page_count int, image_bytes_len bigint, image_url string")


def test_batches_cover_pages_in_order(spark):
    pages = pages_of(spark, {"a": [1] * 41, "b": [1] * 20, "c": [1]})
    got = {(r.doc_path, r.batch_no): r for r in page_batches(pages.repartition(5), 20).collect()}
    assert {k: (r.batch_count, r.start_page, r.end_page) for k, r in got.items()} == {
        ("a", 1): (3, 1, 20), ("a", 2): (3, 21, 40), ("a", 3): (3, 41, 41), ("b", 1): (1, 1, 20), ("c", 1): (1, 1, 1),
    }
    assert got["a", 2].image_urls == [f"u/a/{i}" for i in range(21, 41)]


def test_page_key(spark):
    df = spark.createDataFrame([("/x/ä.pdf", 7), ("/x/ä.pdf", 12345)], "p string, n int")
    digest = hashlib.sha256("/x/ä.pdf".encode()).hexdigest()[:16]
    keys = [tuple(r) for r in df.select(page_key("p", "n"), page_key("p", "n", ""), page_key("p", "n", "/a/b/")).collect()]
    assert keys[0] == (f"pdf-pages/{digest}/page-0007.png", f"{digest}/page-0007.png", f"a/b/{digest}/page-0007.png")
    assert keys[1][0].endswith("/page-12345.png")


def test_oversized_page_stops_its_paper_only(spark):
    limit = image_limit(1.5)
    pages = pages_of(spark, {
        "ok": [limit] * 5, "late": [1, 1, 1, limit + 1, limit + 9], "first": [limit + 1, 1, 1],
    })
    bad = first_oversized_page(pages, 1.5)
    assert {(r.doc_path, r.first_bad, r.bad_bytes) for r in bad.collect()} == {("late", 4, limit + 1), ("first", 1, limit + 1)}
    kept = guard_oversized(page_batches(pages, 2), bad)
    assert {(r.doc_path, r.batch_no) for r in kept.collect()} == {("ok", 1), ("ok", 2), ("ok", 3), ("late", 1)}


def test_request_input(spark):
    batches = page_batches(pages_of(spark, {"a": [1, 1]}), 20)
    for correct in (False, True):
        row = extraction_requests(batches, "Do\nit", correct).first()
        content = [{"type": "input_image", "image_url": f"u/a/{i}"} for i in (1, 2)]
        content.append({"type": "input_text", "text": "Do\nit"})
        if correct:
            content.append({"type": "input_text", "text": CORRECTION_TEXT})
        assert json.loads(row.input) == [{"role": "user", "content": content}]
        assert (row.reasoning_effort, row.max_output_tokens) == ("none", 524288)


def test_schema_errors(spark):
    whole = {k: None for k in RECORD_KEYS}
    lacking = {k: 1 for k in RECORD_KEYS[2:-1]}
    cases = [("object", json.dumps(whole, ensure_ascii=False)), ("object", json.dumps(lacking, ensure_ascii=False)),
             ("array", "[]"), ("scalar", "7"), (None, None), ("object", json.dumps({**whole, "x": 1}, ensure_ascii=False)),
             ("object", json.dumps({**whole, "x": float("nan")}, ensure_ascii=False)), ("object", '{"x":NaN}')]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, json_kind string, json string")
    got = {r.i: r.schema_error for r in extraction.with_schema_error(df).collect()}
    assert got[0] is None and got[5] is None and got[6] is None
    assert got[7].endswith("record: " + ", ".join(RECORD_KEYS))
    assert got[1].endswith("record: " + ", ".join([*RECORD_KEYS[:2], RECORD_KEYS[-1]]))
    assert "not an object" in got[2] and "not an object" in got[3] and got[4]


def test_status_and_errors(spark):
    papers = spark.createDataFrame([(p, n) for p, n in [("good", 2), ("some", 2), ("none", 1), ("empty", 0), ("big", 2)]],
                                   "doc_path string, page_count int")
    outcomes = spark.createDataFrame(
        [("good", 1, 1, 1, 2, None), ("some", 1, 2, 1, 1, None), ("some", 2, 2, 2, 2, "boom"), ("none", 1, 1, 1, 1, "bust"),
         ("big", 1, 2, 1, 1, None)],
        "doc_path string, batch_no int, batch_count int, start_page int, end_page int, error string")
    bad = spark.createDataFrame([("big", 2, 11 * MB)], "doc_path string, first_bad int, bad_bytes bigint")
    fatal = extraction.fatal_errors(papers, bad)
    results = extraction.document_results(papers, outcomes, fatal)
    assert {r.doc_path: (r.status, r.n_parts, r.n_errors) for r in results.collect()} == {
        "good": ("success", 1, 0), "some": ("partial", 1, 1), "none": ("failed", 0, 1), "empty": ("failed", 0, 1),
        "big": ("failed", 1, 1),
    }
    errors = {(r.doc_path, r.batch_no): r.error for r in extraction.document_errors(outcomes, fatal).collect()}
    assert errors["some", 2] == "part 2/2 (page 2-2): boom"
    assert errors["empty", None] == "paper without pages: empty"
    assert errors["big", None] == "image of page 2 has 11.00 MB, the limit is 10.00 MB"
    report = extraction.extraction_report(results).first()
    assert (report.papers, report.parts, report.papers_without_parts) == (5, 3, 2)
