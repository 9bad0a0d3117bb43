import json
from collections import Counter

import pytest

from sheaf.fixed import RECORD_KEYS
from sheaf.operators import record_checks as rc
from sheaf.record_template import SPRAY_SECTION, TECHNIQUES, TEMPLATE


def records(spark, *values):
    rows = [(i, v if isinstance(v, str) or v is None else json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "paper_index bigint, record_json string")


def walked(value, path=""):
    """(path, kind) of a value and everything inside it."""
    if isinstance(value, dict):
        yield path, "object"
        for k, v in value.items():
            yield from walked(v, f"{path}/{rc.escaped(k)}")
    elif isinstance(value, list):
        yield path, "array"
        for v in value:
            yield from walked(v, path + "/*")
    elif isinstance(value, bool):
        yield path, "boolean"
    elif value is None:
        yield path, "null"
    elif isinstance(value, str):
        try:
            float(value)
            yield path, "numeric text"
        except ValueError:
            yield path, "text"
    else:
        yield path, "number"


def paths_of(df, i):
    return {(r["path"], r["kind"]): r["n"] for r in df.collect() if r["paper_index"] == i}


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_paths_of_open_json(spark, levels):
    deep = "end"
    for k in range(23):
        deep = {"a": deep, "n": k} if k % 2 else [deep, None]
    values = [
        {"x": [1, 2.5, "3", " -4e2 ", "5 kg", None, True, {"y": []}], "a/b": {"~": 1, "*": {"*": 2}}, "": {"": 0}},
        deep, [], {}, [[[1], [2]], {"k": "v"}], 7, "text", None, [1e300, 12345678901234567890123],
    ]
    df = rc.field_paths(records(spark, *[json.dumps(v) for v in values]), levels=levels)
    for i, v in enumerate(values):
        assert paths_of(df, i) == Counter(walked(v))


def test_broken_texts_are_told(spark):
    df = rc.field_paths(records(spark, None, "", "{", '{"a":1,"a":2}', '{"a":NaN}', "[1] 2"), template=TEMPLATE)
    assert [(r["path"], r["kind"], r["n"]) for r in df.orderBy("paper_index").collect()] == [("", "broken", 1)] * 6


def test_absent_is_not_null(spark):
    whole = {k: None for k in RECORD_KEYS}
    item = {"样品/涂层编号": "S1", "孔隙率(%)": None}
    partly = whole | {"微观组织结构": [item, {**item, "相组成": "x"}], "基体信息": {}}
    df = rc.field_paths(records(spark, whole, partly, {}), template=TEMPLATE)
    absent = lambda i: {p: n for (p, k), n in paths_of(df, i).items() if k == "absent"}
    assert absent(0) == {}
    members = [rc.escaped(m) for m in TEMPLATE["微观组织结构"][0]]
    want = {f"/微观组织结构/*/{m}": 2 for m in members[2:]} | {"/微观组织结构/*/相组成": 1}
    assert absent(1) == want | {f"/基体信息/{rc.escaped(m)}": 1 for m in TEMPLATE["基体信息"]}
    assert absent(2) == {f"/{k}": 1 for k in RECORD_KEYS}


def test_foreign_members(spark):
    record = {k: None for k in RECORD_KEYS} | {
        "extra": {"in": [1]}, "文献元数据": {"标题": "t", "页码": 3, "作者": [{"名": "x"}]},
        SPRAY_SECTION: [{"工艺参数": {"any": {"thing": 1}}}],
    }
    faults = rc.path_faults(rc.field_paths(records(spark, record), template=TEMPLATE))
    foreign = {r["path"]: r["kind"] for r in faults.filter("fault = 'foreign'").collect()}
    assert foreign == {"/extra": "object", "/文献元数据/页码": "number"}
    wrong = {**record, "文献元数据": [{"标题": 1}], "粉末属性": {"粉末编号": "p"}, "基体信息": {"基体材料": {"x": 1}}, "摩擦学性能": [[]]}
    shapes = rc.path_faults(rc.field_paths(records(spark, wrong, [], "x"), template=TEMPLATE)).filter("fault = 'shape'")
    assert {(r["paper_index"], r["path"], r["kind"]) for r in shapes.collect()} == {
        (0, "/文献元数据", "array"), (0, "/粉末属性", "object"), (0, "/基体信息/基体材料", "object"), (0, "/摩擦学性能/*", "array"),
        (1, "", "array"), (2, "", "broken"),
    }
    plan = faults._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Exchange hashpartitioning" not in plan


def test_fill_of_number_fields(spark):
    base = {k: None for k in RECORD_KEYS}
    rows = [base | {"文献元数据": {"发表年份": v}} for v in (2020, "2020", " 1.5e3 ", None, "n/a", [1], True)]
    fill = {r["path"]: r for r in rc.field_fill(rc.field_paths(records(spark, *rows, base | {"文献元数据": {}}), template=TEMPLATE)).collect()}
    year = fill["/文献元数据/发表年份"]
    assert (year["absent"], year["null_values"], year["numbers"], year["numeric_texts"], year["others"]) == (1, 1, 1, 2, 3)
    assert len(fill) == sum(k == "number" for _, k in rc.template_paths())
    assert sum(fill["/腐蚀性能/*/温度(℃)"][1:]) == 0


def spray(*items):
    return [{"样品/涂层编号": n, "喷涂技术类型": t, "工艺参数": p} for n, t, p in items]


def test_section_items_in_one_scan(spark, tmp_path):
    values = [
        {SPRAY_SECTION: spray((" s1 ", "APS", {})), "力学性能参数": [{"样品/涂层编号": 7, "b": 1, "a": [None]}, 3, None], "粉末属性": [{"粉末编号": "p"}]},
        {SPRAY_SECTION: {"样品/涂层编号": "S1"}, "摩擦学性能": None}, [1], '{"粉末属性":[{"粉末编号":"p"}', None,
    ]
    records(spark, *values).write.parquet(str(tmp_path / "r"))
    df = rc.section_items(spark.read.parquet(str(tmp_path / "r")))
    rows = {(r["paper_index"], r["section"], r["position"]): (r["sample_no"], r["item"]) for r in df.collect()}
    assert set(rows) == {(0, SPRAY_SECTION, 0), (0, "力学性能参数", 0), (0, "力学性能参数", 1), (0, "力学性能参数", 2), (0, "粉末属性", 0)}
    assert rows[0, SPRAY_SECTION, 0][0] == "S1" and rows[0, "粉末属性", 0][0] == "P"
    assert rows[0, "力学性能参数", 0] == ("7", '{"样品/涂层编号":7,"b":1,"a":[null]}')
    assert rows[0, "力学性能参数", 1][0] is None
    for out in (df, rc.orphan_samples(spark.read.parquet(str(tmp_path / "r")))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan and plan.count("Generate") == 1


def test_orphan_samples(spark):
    made = spray(("S1", "APS", {}), ("S1", "APS", {}), ("C 2", "APS", {}))
    prop = lambda *numbers: [{"样品/涂层编号": n} for n in numbers]
    df = rc.orphan_samples(records(
        spark,
        {SPRAY_SECTION: made, "力学性能参数": prop("s1", "S3", "s3 ", None, " "), "热物理性能": prop("c 2", "S3"), "粉末属性": [{"粉末编号": "P9"}]},
        {"力学性能参数": prop("S1")}, {SPRAY_SECTION: made}, "[",
    ))
    assert {(r["paper_index"], r["section"], r["sample_no"], r["n"]) for r in df.collect()} == {
        (0, "力学性能参数", "S3", 2), (0, "力学性能参数", None, 2), (0, "热物理性能", "S3", 1), (1, "力学性能参数", "S1", 1),
    }


def test_parameters_of_techniques(spark):
    full = {p.split("|")[-1]: None for p in TECHNIQUES["HVOF"][0]}
    df = records(
        spark, {SPRAY_SECTION: spray(("1", "HVOF", full | {"步距(mm)": 1}), ("2", " HVOF ", {**full, "电流(A)": 5}), ("3", "APS", None))},
        {SPRAY_SECTION: spray(("1", "laser", {"电流(A)": 1}), ("2", None, {}))}, {SPRAY_SECTION: [7]}, "x",
    )
    found = Counter((r["paper_index"], r["position"], r["fault"], r["parameter"]) for r in rc.process_param_check(df).collect())
    assert found == Counter(
        [(0, 1, "foreign", "电流(A)")] + [(0, 2, "missing", p) for p in TECHNIQUES["APS"][0]]
    )
    odd = {(r["paper_index"], r["position"], r["technique"]) for r in rc.technique_check(df).collect()}
    assert odd == {(1, 0, "laser"), (1, 1, None), (2, 0, None)}


def test_no_records(spark):
    none = records(spark).limit(0)
    for check in (rc.section_items, rc.orphan_samples, rc.process_param_check, rc.technique_check, rc.field_paths):
        assert check(none).count() == 0
    assert rc.path_faults(rc.field_paths(none, template=TEMPLATE)).count() == 0
    assert rc.field_fill(rc.field_paths(none, template=TEMPLATE)).filter("absent > 0").count() == 0
