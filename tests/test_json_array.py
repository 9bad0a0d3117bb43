"""Arrays read by several tasks, against Python's decoder; running sums in groups."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sheaf.operators import ordering
from sheaf.sources import json_array as ja
from sheaf.sources.jsonl import count_array_items
from sheaf.sources.papers import read_records

TRICKY = [
    'a,b', '],[', '"', '\\', '\\\\', '\\"', '{"a":[', '",', '\\",', ' \n\t ', 'é中😀', '[[[', ',,,', '\\\\"],', "",
]


def value(rng, deep=0):
    kind = rng.randrange(8 if deep < 4 else 5)
    if kind < 3:
        return "".join(rng.choice(TRICKY) for _ in range(rng.randrange(4)))
    if kind < 5:
        return rng.choice([None, True, 1.5, -3, 10**12])
    if kind < 6:
        return [value(rng, deep + 1) for _ in range(rng.randrange(4))]
    return {f"{rng.choice(TRICKY)}{k}": value(rng, deep + 1) for k in range(rng.randrange(4))}


def spread(rng, v, indent):
    """JSON text with blanks where they may be."""
    text = json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=indent, separators=None if indent else (",", ":"))
    return rng.choice(["", " ", "\n\t", "﻿"]) + text + rng.choice(["", "\n", "  "])


@pytest.fixture
def tiny_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "120")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield
    for k in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{k}")


def items_by_range(text, cuts):
    """The task-side functions alone: stretches between commas dealt into ranges, as Spark deals them."""
    stretches = text.encode().split(b",")
    ranges = [stretches[a:b] for a, b in zip([0, *cuts], [*cuts, len(stretches)]) if a < b]
    inside = depth = 0
    root = text.encode().removeprefix(ja.BOM).lstrip(ja.BLANKS)[:1]
    fragments, base = {}, 0
    for k, own in enumerate(ranges):
        cutter = ja._Cutter(k, inside, depth, root == b"[")
        # the first stretch alone, then the rest: a range may come in several batches
        parts = [own[:1], own[1:]] if len(own) > 1 else [own]
        for n, part in enumerate(parts):
            piece = (b"," if n else b"") + b",".join(part)
            found = ja.Structure.of(piece)
            if k == 0 and n == 0:
                cutter.read(piece.removeprefix(ja.BOM))
            else:
                cutter.read(piece)
            depth, inside = depth + found.change(inside), found.leaves_inside(inside)
        ended = 0
        for nth, begins, ends, junk, item in cutter.finish():
            assert not junk
            fragments.setdefault(base + nth, []).append((item, begins, ends))
            ended += ends
        base += ended
    assert (inside, depth) == (0, 0)
    out = []
    for k in sorted(fragments):
        got = fragments[k]
        assert [b for _, b, _ in got] == [True] + [False] * (len(got) - 1)
        out.append(b",".join(item for item, _, _ in got).decode())
    return out


@pytest.mark.parametrize("seed", range(40))
def test_ranges_cut_their_items_wherever_they_begin(seed):
    rng = random.Random(seed)
    for _ in range(25):
        items = [value(rng) for _ in range(rng.randrange(8))]
        whole = rng.choice([items, items, items, {"only": items}, "text, [", 7])
        text = spread(rng, whole, rng.choice([None, 1]))
        n = text.count(",") + 1
        got = items_by_range(text, sorted(rng.sample(range(1, n), rng.randrange(min(n, 6)))))
        want = whole if isinstance(whole, list) else [whole]
        if not want:
            assert [g.strip() for g in got] == [""]
        else:
            assert [json.loads(g) for g in got] == want


@pytest.mark.parametrize("most", [ja.MAX_BROADCAST_RANGES, 0])
def test_items_equal_the_whole_text_reader(spark, tmp_path, tiny_ranges, most):
    rng = random.Random(most)
    want = {}
    for k, whole in enumerate([[value(rng) for _ in range(25)], [], {"only": [1, ",]", {"a": 2}]}, ["x, y"]]):
        (tmp_path / f"f{k}.json").write_text(spread(rng, whole, k % 2 or None), encoding="utf-8")
        want[f"f{k}.json"] = whole if isinstance(whole, list) else [whole]
    got = {name: [] for name in want}
    for r in ja.read_items(spark, str(tmp_path), most).orderBy("path", "item_no").collect():
        name = r["path"].rsplit("/", 1)[1]
        assert r["item_no"] == len(got[name])
        got[name].append(json.loads(r["item"]))
    assert got == want


def test_one_long_item_in_many_ranges(spark, tmp_path, tiny_ranges):
    long = {"t": ", ".join(["x" * 10, '"', "\\"] * 30), "l": list(range(60))}
    path = tmp_path / "a.json"
    path.write_text(json.dumps([1, long, long, "y"]), encoding="utf-8")
    rows = ja.read_items(spark, str(path)).orderBy("item_no").collect()
    assert [json.loads(r["item"]) for r in rows] == [1, long, long, "y"]


BROKEN = [
    " ", "[1,2", "[1,2],", "[1,2],3", "[1],[2]", "[1][2]", "x[1]", "[1]x", '["a]', '["a\\"]', "[1}", "{1]", "[1,,2]", "[1,]",
    "[,1]", "[1 2]", "[1],{}", "1,2", "{},{}", '{"a":1', "[[1]", "[1]]", "[tru]", "[01]", '["\\x"]', "[{]}",
]


def test_what_is_not_one_value_is_told(spark, tmp_path):
    path = tmp_path / "a.json"
    for text in ("[1,2", "[1,2],", "[1],[2]", "x[1]", "[1,,2]", '["\\x"]'):
        path.write_text(text, encoding="utf-8")
        with pytest.raises(Exception, match="not one JSON value"):
            ja.checked_items(ja.read_items(spark, str(path))).collect()


@pytest.mark.parametrize("text", BROKEN)
def test_no_broken_text_passes_the_task_side(text):
    try:
        found = items_by_range(text, [])
        if text.endswith(","):
            raise AssertionError("a comma at the end is told by the size of the file")
        for item in found:
            json.loads(item)
    except (AssertionError, ValueError):
        return
    raise AssertionError(f"taken: {text}")


def test_counts_take_arrays_only(spark, tmp_path):
    for text, n in (("[]", 0), ("[ \n ]", 0), ('[1, "a,b", null, {"c": [1, 2]}, []]', 5), ("﻿[[], {}]", 2)):
        (tmp_path / "a.json").write_text(text, encoding="utf-8")
        assert count_array_items(spark, str(tmp_path / "a.json")).first().samples == n
    for text in ('{"a":1}', "3"):
        (tmp_path / "a.json").write_text(text, encoding="utf-8")
        with pytest.raises(Exception, match="no JSON array in"):
            count_array_items(spark, str(tmp_path / "a.json")).first()


def test_records_of_a_folder(spark, tmp_path, tiny_ranges):
    folder = tmp_path / "two words, 文件"
    folder.mkdir()
    (folder / "a b%20.json").write_text('[{"a": "x,y"}]', encoding="utf-8")
    assert [r["record_json"] for r in read_records(spark, str(folder)).collect()] == ['{"a":"x,y"}']
    (folder / "a b%20.json").unlink()
    tmp_path = tmp_path / "records"
    tmp_path.mkdir()
    (tmp_path / "a.json").write_text('[{"a": "x,y"}, {"b": [1, {"c": ", "}]}]', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"c": 1,\n "d": [2]}', encoding="utf-8")
    rows = read_records(spark, str(tmp_path)).orderBy("path", "item_no").collect()
    assert [(r["path"][-6:], r["item_no"], r["record_json"]) for r in rows] == [
        ("a.json", 0, '{"a":"x,y"}'), ("a.json", 1, '{"b":[1,{"c":", "}]}'), ("b.json", 0, '{"c":1,"d":[2]}'),
    ]
    for text, reason in (('[{"a":1},2]', "not an object"), ("7", "neither an object nor an array")):
        (tmp_path / "b.json").write_text(text, encoding="utf-8")
        with pytest.raises(Exception, match=reason):
            read_records(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("most", [10, 10_000])
def test_running_sums_in_groups(spark, within, most):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), k, rng.randrange(-5, 9), rng.randrange(3)) for k in rng.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "g string, k bigint, x bigint, y bigint").repartition(5)
    got = ordering.running_sums(df, ["k"], {"x": "sx", "y": "sy"}, within, most)
    want, sums = {}, {}
    for g, k, x, y in sorted(rows, key=lambda r: ((r[0],) if within else ()) + (r[1],)):
        a, b = sums.get(g if within else "", (0, 0))
        want[k] = (a, b)
        sums[g if within else ""] = (a + x, b + y)
    assert {r["k"]: (r["sx"], r["sy"]) for r in got.collect()} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    if most == 10:
        assert "SinglePartition" not in plan and "hashpartitioning(true" not in plan
        assert plan.count("Window") >= 1 and "_group" in plan


def test_positions_with_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "MAX_WINDOW_ROWS", 5)
    monkeypatch.setattr(ordering.running_sums, "__defaults__", ((), 5))
    monkeypatch.setattr(ordering, "MAX_BROADCAST_RANGES", 3)
    df = spark.createDataFrame([(k * 7919 % 1009,) for k in range(1009)], "k bigint").repartition(3)
    got = ordering.with_dense_index(df, ["k"], partitions=9).collect()
    assert all(r["record_index"] == r["k"] for r in got)
    assert df.select(F.max("k")).first()[0] == 1008
