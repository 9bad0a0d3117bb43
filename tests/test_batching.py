"""Greedy batching against a plain loop."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sheaf.operators import batching
from sheaf.operators.ordering import with_dense_index
from sheaf.operators.translation import batch_payloads, payloads


def greedy(chars, batch_size, max_chars):
    out, n, used, no = [], 0, 0, 0
    for c in chars:
        if n and (n >= batch_size or used + c > max_chars):
            no, n, used = no + 1, 0, 0
        out.append(no)
        n, used = n + 1, used + c
    return out


def assigned(spark, chars, *args, **kwargs):
    rows = list(enumerate(chars))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id bigint, chars bigint").repartition(3)
    return [r.batch_no for r in batching.assign_batches(df, *args, **kwargs).orderBy("id").collect()]


@pytest.mark.parametrize("n,batch_size,max_chars,chunk_rows,fan_in", [
    (1, 10, 100, 16, 4), (500, 10, 300, 16, 4), (500, 10, 300, 16, 1000), (333, 7, 10**9, 10, 2),
    (200, 1, 50, 8, 3), (120, 50, 400, 8, 2), (64, 10, 1, 16, 2), (160, 16, 10**9, 16, 3),
])
def test_equals_the_plain_loop(spark, n, batch_size, max_chars, chunk_rows, fan_in):
    rnd = random.Random(n * batch_size)
    chars = [rnd.choice([5, 20, 40, 90, 350]) for _ in range(n)]
    got = assigned(spark, chars, batch_size, max_chars, chunk_rows=chunk_rows, fan_in=fan_in)
    assert got == greedy(chars, batch_size, max_chars)


def test_limits_are_inclusive(spark):
    assert assigned(spark, [10, 10, 10, 10], 10, 20) == [0, 0, 1, 1]
    assert assigned(spark, [10, 11, 10], 10, 20) == [0, 1, 2]
    assert assigned(spark, [99, 1, 1], 10, 20) == [0, 1, 1]
    assert assigned(spark, [1] * 5, 2, 100) == [0, 0, 1, 1, 2]


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(1, 60), min_size=1, max_size=120), st.integers(1, 9), st.integers(1, 150),
    st.integers(1, 20), st.integers(2, 5),
)
def test_functions_compose_to_the_plain_loop(chars, batch_size, max_chars, chunk_rows, fan_in):
    """The task-side functions alone, chained as the job chains them."""
    import pandas as pd

    chunk_rows = max(chunk_rows, batch_size)
    ids = list(range(len(chars)))
    chunks = sorted({i // chunk_rows for i in ids})
    summarise = batching._summarise(batch_size, max_chars, chunk_rows)
    maps = []
    for c in chunks:
        shown = [i for i in ids if i // chunk_rows == c or (i // chunk_rows == c + 1 and i % chunk_rows < batch_size - 1)]
        maps.append(summarise((c,), pd.DataFrame({"id": shown, "chars": [chars[i] for i in shown]})))
    maps = pd.concat(maps)
    runs = maps["chunk"] // fan_in
    composed = pd.concat([batching._compose((r,), maps[runs == r]) for r in sorted(set(runs))])
    start = pd.DataFrame({"entry": [0], "base": [0]})
    run_entries = batching._walk((0,), start, composed)
    got = {}
    for _, e in run_entries.iterrows():
        entries = batching._walk((0,), pd.DataFrame({"entry": [e.entry], "base": [e.base]}), maps[runs == e.chunk])
        for _, c in entries.iterrows():
            own = [i for i in ids if i // chunk_rows == c.chunk]
            out = batching._number(batch_size, max_chars)(
                (c.chunk,), pd.DataFrame({"entry": [c.entry], "base": [c.base]}),
                pd.DataFrame({"id": own, "chars": [chars[i] for i in own]}))
            got.update(zip(out["id"], out["batch_no"]))
    assert [got[i] for i in ids] == greedy(chars, batch_size, max_chars)


def test_payload_size_is_that_of_spaced_json(spark):
    records = [
        {"text": "a", "n": 1}, {"input": " ", "output": "é\n"}, {"x": "y"}, {"instruction": 5},
        {"instruction": " i ", "input": "j", "output": "o", "text": "t", "prompt": "p", "chosen": "c", "rejected": "r"},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "id bigint, record string")
    for row in payloads(df).collect():
        kept = {k: v for k, v in records[row.id].items() if isinstance(v, str) and v.strip() and k != "x"}
        payload = {"id": row.id, "fields": kept}
        assert json.loads(row.payload) == payload
        assert row.chars == len(json.dumps(payload, ensure_ascii=False))
        assert row.names == list(kept)


def test_batches_hold_their_records_in_order(spark):
    rows = [(i, json.dumps({"text": "x" * (i % 50)})) for i in range(45)]
    df = spark.createDataFrame(rows, "id bigint, record string").repartition(4)
    batches = batch_payloads(payloads(df), 10, 400, chunk_rows=16).orderBy("batch_no").collect()
    ids = [[item["id"] for item in json.loads(b.source_json)] for b in batches]
    assert [i for b in ids for i in b] == list(range(45))
    assert [[e.id for e in b.expected] for b in batches] == ids


def test_dense_index_follows_the_key(spark):
    rows = [(i * 7919 % 1009, chr(97 + i % 3)) for i in range(1000)]
    df = spark.createDataFrame(rows, "k bigint, v string").repartition(6)
    got = with_dense_index(df, ["v", "k"], partitions=5).orderBy("record_index").collect()
    assert [r.record_index for r in got] == list(range(1000))
    assert [(r.v, r.k) for r in got] == sorted((v, k) for k, v in rows)
