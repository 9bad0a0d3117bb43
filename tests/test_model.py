"""The model stage: retries, failures, resuming."""

import json
import sys

import pytest
from pyspark import cloudpickle

from sheaf.operators.model import answer, call_model, with_retry_class
from sheaf.session import staged_path


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def requests(spark, ids):
    return spark.createDataFrame([(i, f"in-{i}", "none", None, n) for n, i in enumerate(ids)],
                                 "request_id string, input string, reasoning_effort string, max_output_tokens int, n int")


def by_name(request):
    """Behaviour by request id; a file counts the calls."""
    name = request["request_id"]
    if name.startswith("boom"):
        raise OSError("no route")
    if name.startswith("busy"):
        return 503, "later"
    if name.startswith("list"):
        return 200, "[1]"
    return 200, json.dumps({"output_text": request["input"], "effort": request["reasoning_effort"]})


def test_every_attempt_is_a_row_and_no_failure_ends_the_job(spark):
    df = call_model(requests(spark, ["ok", "boom", "busy", "list"]), by_name, keys=["n"], max_retries=2, threads=3, backoff_s=0.0)
    rows = df.collect()
    per = {}
    for r in rows:
        per.setdefault(r.request_id, []).append(r)
    assert {k: [a.attempt for a in sorted(v)] for k, v in per.items()} == {
        "ok": [0], "boom": [0, 1, 2], "busy": [0, 1, 2], "list": [0, 1, 2]}
    last = {k: max(v, key=lambda a: a.attempt) for k, v in per.items()}
    assert all(sum(a.final for a in v) == 1 and last[k].final for k, v in per.items())
    assert last["ok"].error is None and last["ok"].n == 0
    assert "no route" in last["boom"].error and last["boom"].http_status is None
    assert "HTTP 503" in last["busy"].error and last["busy"].body == "later"
    assert "not a JSON object" in last["list"].error


def test_answers_are_not_asked_twice(spark, tmp_path):
    log = str(tmp_path / "calls")

    def logged(request):
        with open(log, "a") as f:
            f.write(request["request_id"] + "\n")
        return by_name(request)

    path = staged_path(spark, "responses")
    first = answer(requests(spark, ["a", "b", "busy1"]), logged, path, max_retries=0, backoff_s=0.0)
    assert first.filter("final").count() == 3
    second = answer(requests(spark, ["b", "c"]), logged, path, waves=3, max_retries=0, backoff_s=0.0)
    assert {r.request_id for r in second.collect()} == {"b", "c"}
    assert sorted(open(log).read().split()) == ["a", "b", "busy1", "c"]


@pytest.mark.parametrize("waves", [1, 3])
def test_failures_are_asked_again_and_the_latest_round_counts(spark, waves):
    path = staged_path(spark, "responses")
    names = [f"r{i}" for i in range(12)]

    def moody(bad):
        def model(request):
            return (503, "later") if int(request["request_id"][1:]) in bad else by_name(request)

        return model

    for bad, failed in [({1, 2, 3}, 3), ({2, 3, 7}, 2), (set(), 0), ({1, 2, 3, 4}, 0)]:
        got = answer(requests(spark, names), moody(bad), path, keys=["n"], waves=waves, max_retries=1, backoff_s=0.0)
        final = got.filter("final").collect()
        assert sorted(r.request_id for r in final) == sorted(names)
        assert sum(r.error is not None for r in final) == failed


@pytest.mark.parametrize("waves", [1, 4])
def test_waves_answer_everything(spark, waves):
    names = [f"r{i}" for i in range(40)]
    got = answer(requests(spark, names), by_name, staged_path(spark, "responses"), keys=["n"], waves=waves, backoff_s=0.0)
    assert sorted((r.request_id, r.n) for r in got.collect()) == sorted((n, i) for i, n in enumerate(names))


def test_a_lost_run_goes_on_with_its_open_waves(spark, tmp_path):
    log = str(tmp_path / "calls")
    names = [f"r{i}" for i in range(60)]
    path = staged_path(spark, "responses")

    def logged(request):
        with open(log, "a") as f:
            f.write(request["request_id"] + "\n")
        return (503, "later") if int(request["request_id"][1:]) % 10 == 0 else by_name(request)

    class Lost(Exception):
        pass

    asked = requests(spark, names)
    built = []

    class Watched:
        """The requests, noting which waves are built; the third one is lost."""

        sparkSession, schema = asked.sparkSession, asked.schema

        def select(self, *c):
            return asked.select(*c)

        def filter(self, condition):
            built.append(str(condition))
            if len(built) == 3:
                raise Lost
            return asked.filter(condition)

    with pytest.raises(Lost):
        answer(Watched(), logged, path, keys=["n"], waves=4, max_retries=0, backoff_s=0.0, wave_by=["n"])
    first = set(open(log).read().split())
    assert 0 < len(first) < 60
    built.extend(["x", "y"])  # no wave is lost from here on
    got = answer(Watched(), logged, path, keys=["n"], waves=4, max_retries=0, backoff_s=0.0, wave_by=["n"], resume=True)
    assert len(built) == 3 + 2 + 2  # two waves were left
    calls = open(log).read().split()
    assert sorted(calls) == sorted(names)  # failed ones of finished waves included: none is asked twice
    final = got.filter("final").collect()
    assert sorted(r.request_id for r in final) == sorted(names) and {r["round"] for r in final} == {0}
    # a further run, not a resumed one, asks the failed ones again
    answer(asked, logged, path, keys=["n"], waves=4, max_retries=0, backoff_s=0.0, wave_by=["n"], resume=True)
    assert len(open(log).read().split()) == 66


def test_a_wave_skips_rows_before_they_are_multiplied(spark, tmp_path):
    from pyspark.sql import functions as F
    from sheaf.operators.requests import generation_requests
    from workload import fixtures as fx

    spark.createDataFrame([(i, '{"a":1}') for i in range(9)], "paper_index bigint, record_json string").write.parquet(str(tmp_path / "r"))
    asked = generation_requests(spark.read.parquet(str(tmp_path / "r")), fx.prompts(spark), "SFT")
    wave = asked.filter(F.pmod(F.xxhash64("paper_index"), F.lit(4)) == 2)
    plan = wave._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("xxhash64") > plan.index("Generate")  # the filter is below the generator


def test_a_record_is_escaped_once_and_not_once_per_task(spark, tmp_path):
    from sheaf.operators.requests import generation_requests
    from workload import fixtures as fx

    texts = ['{"a":"q\\"\\\\ \\n é 😀"}', '{"a":NaN}', None, '["\\u0001"]']
    spark.createDataFrame(list(enumerate(texts)), "paper_index bigint, record_json string").write.parquet(str(tmp_path / "r"))
    asked = generation_requests(spark.read.parquet(str(tmp_path / "r")), fx.prompts(spark), "SFT")
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    assert "StructsToJson" not in plan[: plan.index("Generate")]
    sent = {(r.paper_index, r.task_type): json.loads(r.input)[0] for r in asked.collect()}
    assert len(sent) == 36
    for (i, task), message in sent.items():
        if texts[i] is None:
            assert message == {"role": "user"}
        else:
            head, _, record = message["content"].rpartition("文献 JSON：\n")
            assert f'[{{"task_type":"{task}"' in head and head.startswith("Task: ")
            assert record == texts[i] if "NaN" in texts[i] else json.loads(record) == json.loads(texts[i])


def test_retry_class(spark):
    ok, bad = '{"a":1}', '{"error":{"message":"Disallowed URL: x"}}'
    cases = [
        (0, 200, ok, (True, False, False, None)),
        (0, 200, "[1]", (False, False, True, 1.0)),
        (1, 200, "oops", (False, False, True, 2.0)),
        (2, 503, "", (False, True, False, None)),
        (0, 400, bad, (False, True, True, 1.0)),
        (0, 400, '{"error":"disallowed url: x"}', (False, False, True, 1.0)),
        (0, 404, bad, (False, False, True, 1.0)),
        (0, 429, ok, (False, True, True, 1.0)),
        (0, None, None, (False, False, True, 1.0)),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, attempt int, http_status int, body string")
    for r in with_retry_class(df).collect():
        assert (r.accepted, r.named_retryable, r.retry, r.backoff_s) == cases[r.i][3], cases[r.i]


def test_no_pause_where_none_is_asked_for(monkeypatch):
    import time

    import pyarrow as pa

    from sheaf.operators.model import REQUEST_FIELDS, _caller

    slept = []
    monkeypatch.setattr(time, "sleep", slept.append)
    asked = pa.RecordBatch.from_pydict(
        {"request_id": ["busy", "ok"], "input": ["é", None], "reasoning_effort": ["none", None],
         "max_output_tokens": pa.array([None, 7], pa.int32()), "n": [1, None]})
    assert tuple(asked.schema.names[:4]) == REQUEST_FIELDS
    seen = []

    def model(request):
        seen.append(request)
        return by_name(request)

    for pause, pauses in [(0.0, []), (0.5, [0.5, 1.0])]:
        seen.clear()
        told = [r for b in _caller(model, ["n"], 2, 1, pause, 0)(iter([asked])) for r in b.to_pylist()]
        assert slept == pauses
        assert seen == [asked.to_pylist()[0]] * 3 + [asked.to_pylist()[1]]
        assert [(r["request_id"], r["attempt"], r["n"]) for r in told] == [("busy", 0, 1), ("busy", 1, 1), ("busy", 2, 1), ("ok", 0, None)]
