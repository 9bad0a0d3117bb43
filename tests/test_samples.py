"""Cleaning, bounds and deduplication of samples."""

import json

import pytest
from pyspark.sql import functions as F

from sheaf.fixed import SAMPLE_FIELDS, TASKS
from sheaf.functions.salvage import with_json_value
from sheaf.operators.responses import total_usage, with_items, with_response_text
from sheaf.operators.samples import candidates_from_items, first_wins, generation_report, mark_samples, normalize_samples

A, B = "anomaly_detection", "literature_qa"


def rule(sample, method, task, max_chars):
    """The sample as it may be written, or None."""
    out = {}
    for f in SAMPLE_FIELDS[method]:
        if not isinstance(sample.get(f), str) or sample[f].strip() == "":
            return None
        out[f] = sample[f].strip()
    if method == "SFT":
        out["task_type"] = task
    if method == "DPO" and out["chosen"] == out["rejected"]:
        return None
    return out if len(json.dumps(out, ensure_ascii=False, separators=(",", ":"))) <= max_chars else None


CASES = {
    "CPT": [{"text": " a "}, {"text": ""}, {"text": 5}, {"text": None}, {}, {"text": "x" * 39}, {"text": "x" * 40},
            {"text": '"' * 20}, {"text": "😀" * 39}, {"text": " b　"}, {"text": "t", "more": 1}, {"text": "{}"}],
    "SFT": [{"task_type": "m", "instruction": "i", "input": "j", "output": "o"},
            {"task_type": " ", "instruction": "i", "input": "j", "output": "o"},
            {"instruction": "i", "input": "j", "output": "o"},
            {"task_type": "m", "instruction": "i", "input": "", "output": "o"},
            {"task_type": 1, "instruction": "i", "input": "j", "output": "o"}],
    "DPO": [{"prompt": "p", "chosen": "c", "rejected": "r"}, {"prompt": "p", "chosen": " c", "rejected": "c "},
            {"prompt": "p", "chosen": "c"}, {"prompt": ["p"], "chosen": "c", "rejected": "r"}],
}


@pytest.mark.parametrize("method,limit", [("CPT", 50), ("SFT", 90), ("SFT", 80), ("DPO", 50), ("DPO", 40)])
def test_rule_per_sample(spark, method, limit):
    rows = [(0, A, i, json.dumps(s, ensure_ascii=False)) for i, s in enumerate(CASES[method])]
    df = spark.createDataFrame(rows, "paper_index bigint, task_type string, pos int, item string")
    marked = {r.pos: r for r in mark_samples(candidates_from_items(df, method), method, limit).collect()}
    for i, sample in enumerate(CASES[method]):
        expected = rule(sample, method, A, limit)
        assert marked[i].keep == (expected is not None), sample
        if expected:
            assert {f: marked[i][f] for f in SAMPLE_FIELDS[method]} == expected


def test_length_bound_is_inclusive(spark):
    size = len(json.dumps({"text": "é" * 10}, ensure_ascii=False, separators=(",", ":")))
    df = spark.createDataFrame([(0, A, 0, "é" * 10)], "paper_index bigint, task_type string, pos int, text string")
    assert normalize_samples(df, "CPT", size).count() == 1
    assert normalize_samples(df, "CPT", size - 1).count() == 0


def test_first_occurrence_wins_by_paper_then_task_name_then_position(spark):
    # task names in catalogue order differ from alphabetical order
    assert list(TASKS.values()) != sorted(TASKS.values())
    rows = [
        (1, A, 0, "x"), (0, B, 3, "x"), (0, "forward_property_prediction", 9, "x"),
        (0, B, 1, "y"), (0, B, 0, "y"), (2**40, A, 2**31 - 1, "far"),
    ]
    df = spark.createDataFrame(rows, "paper_index bigint, task_type string, pos int, text string")
    got = {r.text: (r.paper_index, r.task_type, r.pos) for r in first_wins(df, "CPT").collect()}
    assert got == {
        "x": (0, "forward_property_prediction", 9), "y": (0, B, 0), "far": (2**40, A, 2**31 - 1),
    }


def test_instruction_samples_of_two_tasks_stay_apart(spark):
    rows = [(0, A, 0, "i", "j", "o"), (1, B, 0, "i", "j", "o"), (2, B, 0, "i", "j", "o")]
    df = spark.createDataFrame(rows, "paper_index bigint, task_type string, pos int, instruction string, input string, output string")
    got = sorted((r.task_type, r.paper_index) for r in first_wins(df, "SFT").collect())
    assert got == [(A, 0), (B, 1)]


def test_dedup_is_idempotent_and_independent_of_partitions(spark):
    rows = [(i % 7, list(TASKS.values())[i % 9], i % 5, f"t{i % 13}") for i in range(500)]
    df = spark.createDataFrame(rows, "paper_index bigint, task_type string, pos int, text string")
    once = first_wins(df.repartition(7), "CPT")
    want = {tuple(r) for r in once.select("text", "paper_index", "task_type", "pos").collect()}
    for n in (1, 3):
        again = first_wins(once.unionByName(df.select(*once.columns)).repartition(n), "CPT")
        assert {tuple(r) for r in again.select("text", "paper_index", "task_type", "pos").collect()} == want


def test_dedup_is_hash_aggregated_with_one_shuffle(spark):
    df = spark.createDataFrame([(0, A, 0, "x")], "paper_index bigint, task_type string, pos int, text string")
    plan = first_wins(df, "CPT")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan


def test_envelopes(spark):
    cases = [
        ("array", '[{"a":1},2,"{}",{"b":2}]', ['{"a":1}', '{"b":2}']),
        ("object", '{"samples":5,"data":[{"a":1}],"items":[{"c":1}]}', ['{"a":1}']),
        ("object", '{"items":[],"x":1}', []),
        ("object", '{"data":[1],"samples":[{"s":1}]}', ['{"s":1}']),
        ("object", '{"text":"t"}', ['{"text":"t"}']),
        ("object", '{"samples":{"a":1}}', ['{"samples":{"a":1}}']),
    ]
    df = spark.createDataFrame([(i, k, v) for i, (k, v, _) in enumerate(cases)], "i int, json_kind string, json string")
    got = {r.i: r["items"] for r in with_items(df).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}
    wrong = spark.createDataFrame([("scalar", "7"), (None, None)], "json_kind string, json string")
    assert all(r.items_error and r["items"] is None for r in with_items(wrong).collect())


def test_response_text_and_errors(spark):
    def message(*parts):
        return {"type": "message", "content": list(parts)}

    said = {"type": "output_text", "text": " hi "}
    cases = [
        ({"output_text": " a ", "output": [message(said)]}, "a", None),
        ({"output_text": " ", "output": [message(said)]}, "hi", None),
        ({"output_text": 5, "output": [{"type": "x", "content": [said]}, message({"type": "output_text", "text": ""}, said)]}, "hi", None),
        ({"output": [7, "s", {"type": "message", "content": "no"}, message(3, {"type": "output_text", "text": 4}, said)]}, "hi", None),
        ({"status": "failed", "output_text": "a", "error": {"code": 1}}, None, "reported an error"),
        ({"status": "incomplete", "output_text": "a"}, None, "cut short"),
        ({"status": "completed", "error": "boom"}, None, "boom"),
        ({"output": "text", "id": 1}, None, "members: id, output"),
        ({"error": {}}, None, "no text in the answer"),
    ]
    rows = [(i, json.dumps(c[0]), None) for i, c in enumerate(cases)] + [(99, None, "no route")]
    df = spark.createDataFrame(rows, "i int, body string, error string")
    got = {r.i: (r.text, r.text_error) for r in with_response_text(df).collect()}
    for i, (_, text, error) in enumerate(cases):
        assert got[i][0] == text, cases[i]
        assert (error is None) == (got[i][1] is None) and (error or "") in (got[i][1] or "")
    assert got[99] == (None, "no route")


def test_usage_counts_whole_numbers_only(spark):
    bodies = [
        {"usage": {"input_tokens": 10, "output_tokens": 3, "input_tokens_details": {"cached_tokens": 4}}},
        {"usage": {"input_tokens": 5, "input_tokens_details": {"cached_tokens": 9}}},
        {"usage": {"input_tokens": True, "output_tokens": "7"}},
        {"usage": {"input_tokens": 1.5, "output_tokens": 2, "input_tokens_details": 3}},
        {"usage": None}, {},
        {"status": "failed", "usage": {"input_tokens": 100}},
    ]
    rows = [(json.dumps(b), None) for b in bodies] + [(json.dumps(bodies[0]), "HTTP 500")]
    got = total_usage(spark.createDataFrame(rows, "body string, error string")).first()
    assert (got.regular_input_tokens, got.cached_input_tokens, got.output_tokens) == (6 + 0 + 100, 4 + 5, 5)
    empty = total_usage(spark.createDataFrame([], "body string, error string")).first()
    assert tuple(empty) == (0, 0, 0)


def test_report(spark):
    df = spark.createDataFrame([(2, 1, None), (0, 0, "e")], "n_samples bigint, n_discarded bigint, error string")
    assert generation_report(df).first().asDict() == {"calls": 2, "failed_calls": 1, "kept": 2, "discarded": 1}


def test_items_as_variants_are_the_items_as_texts(spark):
    """The one parse of an answer tells the members that the texts of its items tell."""
    answers = [
        '[{"text":"a\\u00e9\\ud83d\\ude00"},{"text":5},"x",null,{"other":[{"text":"b"}]}]', "```json\n[{\"text\":\"é 😀\"}]\n```",
        "```\r\n{\"samples\":[{\"text\":\"c\"},[1]]}\r\n```", '{"samples":5,"items":[{"text":"d"}]}', '{"data":null,"text":"e"}',
        'See {"samples":[{"text":"f","n":NaN},{"text":"g"}]}', '{"text":"h","text":"i"}', '{"text":"j","n":NaN}', "[]", "{}", "null", "7",
        '[{"text":"k"}] [{"text":"l"}]', "nothing", "", None, '[{"text":"\\ud800"}]', "```json\n[{\"text\":\"m \"}]\n``` end",
    ]
    df = spark.createDataFrame(list(enumerate(answers)), "i int, answer string")

    def told(**variant):
        items = with_items(with_json_value(df, "answer", **variant), **variant)
        rows = items.select("i", "items_error", F.posexplode_outer("items").alias("pos", "item"))
        found = candidates_from_items(rows, "CPT").select("i", "items_error", "pos", "text").collect()
        return sorted(map(tuple, found), key=str)

    assert told(variant="parsed") == told()
    assert len(told()) > len(answers)


def test_usual_bodies_are_not_taken_apart(spark):
    """The texts of usual bodies, which one parse tells, are those that the general rules find."""
    from sheaf.operators.responses import response_text

    def message(text, kind="output_text", **more):
        return {"type": "message", "content": [{"type": kind, "text": text}, {"type": "output_text", "text": "later"}], **more}

    cases = [
        ({"status": "completed", "output": [message(" hi\n", role="assistant")]}, "hi", None),
        ({"output": [message("é \ud83d\ude00")], "error": {"code": 1}}, "é 😀", None),
        ({"output": [message(" "), message("x")]}, "later", None),
        ({"output": [message("no", kind="refusal")]}, "later", None),
        ({"output": [message(5)]}, "later", None),
        ({"output": [{"type": "reasoning"}, message("b")]}, "b", None),
        ({"output": [message("b")], "output_text": "a"}, "a", None),
        ({"output": [message("b")], "output_text": None}, "b", None),
        ({"output": [message("b")], "status": ["failed"]}, "b", None),
        ({"output": [message("b")], "status": "failed", "error": "e"}, None, 'the model reported an error: "e"'),
        ({"output": [message("b")], "status": "incomplete"}, None, "the answer was cut short: null"),
        ({"status": "incomplete", "incomplete_details": {"reason": "max"}}, None, 'the answer was cut short: {"reason":"max"}'),
    ]
    bodies = [json.dumps(c[0]) for c in cases]
    # a repeated member sends a body the general way
    twice = [b[:-1] + ',"id":1,"id":2}' for b in bodies]
    df = spark.createDataFrame(list(enumerate(bodies + twice)), "i int, body string").withColumn("error", F.lit(None).cast("string"))
    for r in with_response_text(df).collect():
        assert (r.text, r.text_error) == cases[r.i % len(cases)][1:], (bodies + twice)[r.i]
    plan = df.select(response_text("body", "error"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("parseJson") < plan.index("from_json")


def test_texts_of_discarded_samples_are_counted_and_not_written(spark):
    from sheaf.plans.generate import call_results, judged_candidates
    from sheaf.session import stage

    said = ['[{"text":" a "},{"text":"%s"},{"text":"%s"},{"text":5}]' % ("x" * 39, "x" * 40), "no", '[{"text":" "}]']
    df = spark.createDataFrame([(i, A, None, t) for i, t in enumerate(said)], "paper_index bigint, task_type string, text_error string, text string")
    rows = stage(judged_candidates(with_json_value(df, "text", variant="json_variant"), "CPT", 50), "candidates")
    got = sorted((r.paper_index, -1 if r.pos is None else r.pos, r.text, r.keep) for r in rows.collect())
    assert got == [(0, 0, "a", True), (0, 1, "x" * 39, True), (0, 2, None, False), (0, 3, None, False), (1, -1, None, False), (2, 0, None, False)]
    told = {r.paper_index: (r.n_samples, r.n_discarded, r.error is None) for r in call_results(rows).collect()}
    assert told == {0: (2, 2, True), 1: (0, 0, False), 2: (0, 1, True)}


@pytest.mark.parametrize("char", ["\x01", '"', "\n", "é", "😀", "x"])
def test_the_length_is_that_of_the_encoded_sample(spark, char):
    text = "-" + char * 9 + "-"
    size = len(json.dumps({"text": text}, ensure_ascii=False, separators=(",", ":")))
    df = spark.createDataFrame([(0, A, 0, text)], "paper_index bigint, task_type string, pos int, text string")
    assert [normalize_samples(df, "CPT", size + more).count() for more in (-1, 0, 40)] == [0, 1, 1]
