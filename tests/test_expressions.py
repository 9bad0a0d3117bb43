"""Text and JSON expressions against plain Python."""

import json

import pytest
from pyspark.sql import functions as F

from sheaf.fixed import WHITESPACE
from sheaf.functions.json_text import canonical, canonical_object, escaped, patched_object, quoted, root_kind, string_members
from sheaf.functions.salvage import _first_value, unfenced, with_fast_json, with_json_value
from sheaf.functions.text import at_most, count_words, is_filled, strip


def column(spark, values, expr, name="v"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {name} string")
    return [r[0] for r in df.select(expr.alias("out"), "i").orderBy("i").collect()]


def test_strip_removes_what_python_removes(spark):
    chars = [chr(c) for c in range(1, 0x3100)]
    values = [c * 2 + "a" + c + "b" + c for c in chars]
    assert column(spark, values, strip("v")) == [v.strip() for v in values]


def test_whitespace_is_complete():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_is_filled(spark):
    assert column(spark, ["a", " ", "", None, " "], is_filled("v")) == [True, False, False, False, False]


def test_count_words(spark):
    assert column(spark, ["a b\n", "", " \n", "one"], count_words("v")) == [2, 0, 0, 1]


VALID = ['{"b":1,"a":[1, 2 ,{"z":null}]}', "[1]", " {} ", '{"k":"\\u00e9"}', '{"n":12345678901234567890}', "null"]
INVALID = ['{"a":1} x', '{"a":1},{"b":2}', '{"a":', "", "{'a':1}", '{"a":NaN}', "[1] [2]", '{"a":01}', '{"a":"\t"}']


def test_canonical_accepts_exactly_one_value(spark):
    dumped = [json.dumps(json.loads(v), ensure_ascii=False, separators=(",", ":")) for v in VALID]
    assert column(spark, VALID, canonical("v")) == dumped
    assert column(spark, INVALID, canonical("v")) == [None] * len(INVALID)


def test_canonical_object(spark):
    assert column(spark, ['{"a":1}', "[1]", '"{}"', "7", None], canonical_object("v")) == ['{"a":1}', None, None, None, None]


def test_string_members_tell_types_apart(spark):
    values = ['{"t":"5"}', '{"t":5}', '{"t":null}', "{}", '{"t":true}', '{"t":{"a":1}}', '{"t":"{}"}', '{"t":["x"]}']
    got = column(spark, values, string_members("v", ["t"]).getField("t"))
    assert got == ["5", None, None, None, None, None, "{}", None]


def test_patched_object_keeps_order_and_other_members(spark):
    record = '{"z":{"y":1,"x":[null,"q"]},"text":"old","n":5,"s":"5","t":true,"e":null,"input":"i"}'
    changes = F.create_map(F.lit("text"), F.lit('new "é"\n'), F.lit("input"), F.lit("j"))
    got = column(spark, [record], patched_object("v", changes))[0]
    expected = json.loads(record)
    expected.update({"text": 'new "é"\n', "input": "j"})
    assert got == json.dumps(expected, ensure_ascii=False, separators=(",", ":"))


ANSWERS = {
    '{"a":1}': ("object", '{"a":1}'),
    "  [1,2]\n": ("array", "[1,2]"),
    '```json\n{"a":1}\n```': ("object", '{"a":1}'),
    '```\r\n{"a":1}\r\n```  ': ("object", '{"a":1}'),
    '```\n{"a":1}\n': ("object", '{"a":1}'),
    "```json": None,
    "```": None,
    'Sure: {"a":1} bye': ("object", '{"a":1}'),
    'See [1] and {"a":1}': ("array", "[1]"),
    '[{"a":1},{"b":': ("object", '{"a":1}'),
    "[oops] {bad} [2]": ("array", "[2]"),
    '```\n{"a":1}\n``` more': ("object", '{"a":1}'),
    "plain": None,
    "": None,
    "7": ("scalar", "7"),
    '"[1]"': ("scalar", '"[1]"'),
    '{"a":NaN}': ("object", '{"a":NaN}'),
    '{"a":1,"b":2,"a":3}': ("object", '{"a":3,"b":2}'),
    '{"a":"퟿ x"}': ("object", '{"a":"퟿ x"}'),
    '```\n{"a":"x y"}\n```': None,
    '{"k":"\\ud800"}': ("object", '{"k":"\\uD800"}'),
    'so {"k":"\\ud800"}': ("object", '{"k":"\\uD800"}'),
}


def test_salvage(spark):
    rows = [(i, a) for i, a in enumerate(ANSWERS)]
    df = spark.createDataFrame([*rows, (len(rows), None)], "i int, a string")
    got = {r.i: (r.kind, r.value) for r in with_json_value(df, "a", "kind", "value").collect()}
    for i, answer in rows:
        kind, value = ANSWERS[answer] or (None, None)
        if kind == "scalar":
            assert got[i][0] == "scalar", answer
        else:
            assert got[i] == (kind, value), answer
    assert got[len(rows)] == (None, None)


def test_fast_path_agrees_where_it_answers(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ANSWERS)], "i int, a string")
    both = with_json_value(with_fast_json(df, "a", "fk", "fv"), "a", "kind", "value")
    for r in both.filter("fk is not null").collect():
        assert (r.fk, r.fv) == (r.kind, r.value)


@pytest.mark.parametrize("text", VALID)
def test_reading_back_keeps_the_value(spark, text):
    assert json.loads(column(spark, [text], canonical("v"))[0]) == json.loads(text)


def test_values_after_other_words_are_decoded_without_python(spark):
    """``json`` holds what Python found; it had these values, and the variant column was null."""
    words = ['Answer: {"a":[1]}', 'See below.\n[{"a":1},{"b":"é"}]\n', "```\nso: [7]\n```"]
    others = ['Sure: {"a":1} bye', "see [1] and [2]", '"a [1]"', 'x {"a":1,"a":2}', "no value", "[oops] [2]", 'so {"a":NaN}', ""]
    df = spark.createDataFrame(list(enumerate(words + others)), "i int, a string")
    told = with_json_value(df, "a", "kind", "json", variant="parsed").withColumn("parsed", F.to_json("parsed"))
    got = {r.i: r for r in told.collect()}
    for i, text in enumerate(words + others):
        body = text.strip().removeprefix("```").removesuffix("```").strip()
        kind, value = _first_value(body, inside=True) or (None, None)
        assert got[i].kind == kind, text
        if i < len(words):
            assert got[i].json is None and got[i].parsed == value, text
        else:
            assert value in (got[i].json, got[i].parsed), text


def test_fences_with_any_line_ends(spark):
    """What is read with line feeds alone is what all line ends give."""
    ends = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
    values = ['{"a":1}', "[1]\n[2]", '[1,"x\x85y"]', '["p\u2028q"]', "[1,\r2]", "[1]\x0b[2]", ""]
    texts = [f"```{tag}{a}{v}{b}{end}" for tag in ("", "json", "js [3]\x0c") for a in ends for v in values
             for b in ("\n", "\x85") for end in ("```", "\x1c```", "")]

    def rule(text):
        lines = text.strip().splitlines()
        closed = len(lines) > 1 and lines[-1].strip() == "```"
        return "\n".join(lines[1 : -1 if closed else None]).strip()

    df = spark.createDataFrame(list(enumerate(texts)), "i int, a string")
    told = with_fast_json(df.withColumn("body", unfenced("a")), "a", "kind", "value")
    for r in told.collect():
        assert r.body == rule(texts[r.i]), repr(texts[r.i])
        found = _first_value(r.body, inside=False)
        assert (r.kind, r.value) == (found or (None, None)), repr(texts[r.i])


def test_literals_and_kinds(spark):
    values = ["a", "", '"q"\\ \n \x01 é 😀', "[x]", None]
    assert column(spark, values, quoted("v")) == [json.dumps(v, ensure_ascii=False) for v in values]
    assert column(spark, values, escaped("v")) == [v if v is None else json.dumps(v, ensure_ascii=False)[1:-1] for v in values]
    texts = ["{", " \t{}", "[1]", "\n[", "7", "", None, "　[1]"]
    assert column(spark, texts, root_kind("v")) == ["object", "object", "array", "array", *["scalar"] * 4]


def test_at_most_counts_characters(spark):
    values = [c * n for c in "aé漢😀" for n in (4, 5, 6, 40)] + ["", None]
    assert column(spark, values, at_most(F.col("v"), 5)) == [None if v is None else len(v) <= 5 for v in values]
