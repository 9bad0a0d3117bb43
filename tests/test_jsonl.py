"""JSON Lines files: strict reading, numbering, merging, counting, statistics."""

import json
import random

import pytest

from sheaf.functions.text import count_words
from sheaf.operators.stats import task_totals, token_counter
from sheaf.plans import tools
from sheaf.sources.jsonl import JsonlError, bad_lines, index_records, read_jsonl, scan_lines
from sheaf.sources.papers import ConfigError, list_papers, missing_prompts, read_prompts, read_records, task_table
from sheaf.sources.sinks import write_jsonl
from sheaf.fixed import TASKS


def write(path, data):
    path.write_bytes(data if isinstance(data, bytes) else data.encode("utf-8"))
    return str(path)


def text_of(folder):
    import glob

    return b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{folder}/part-*"))).decode("utf-8")


@pytest.fixture
def small_splits(spark):
    """Cut files into many byte ranges."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bom_crlf_and_blank_lines(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", "\ufeff{\"a\": 1}\r\n\r\n \t\u3000\n{\"b\":[ ]}\n{\"c\":\"é\"}".encode("utf-8"))
    rows = index_records(read_jsonl(spark, [path])).orderBy("record_index").collect()
    assert [(r.record_index, r.record) for r in rows] == [(0, '{"a":1}'), (1, '{"b":[]}'), (2, '{"c":"é"}')]


def test_index_over_many_splits_and_files(spark, tmp_path, small_splits):
    rnd = random.Random(3)
    paths, expected = [], []
    for f in range(3):
        lines = []
        for i in range(400):
            if rnd.random() < 0.2:
                lines.append("  ")
            record = {"f": f, "i": i, "pad": "é" * rnd.randrange(60)}
            lines.append(json.dumps(record, ensure_ascii=False))
            expected.append((f, i))
        paths.append(write(tmp_path / f"{9 - f}.jsonl", "\n".join(lines) + "\n"))
    rows = index_records(read_jsonl(spark, paths)).orderBy("record_index").collect()
    assert scan_lines(spark, paths).rdd.getNumPartitions() > 3
    assert [r.record_index for r in rows] == list(range(len(expected)))
    assert [(json.loads(r.record)["f"], json.loads(r.record)["i"]) for r in rows] == expected


def test_bad_lines_are_numbered_per_file(spark, tmp_path, small_splits):
    good = '{"a":"%s"}' % ("x" * 100)
    lines = [good] * 300
    lines[7], lines[150], lines[299] = "[1]", '{"a":', '{"a":1} tail'
    lines[8] = ""
    a, b = write(tmp_path / "a.jsonl", "\n".join(lines)), write(tmp_path / "b.jsonl", "\n7\n" + good)
    rows = bad_lines(spark, [a, b]).orderBy("src_ordinal", "line_no").collect()
    assert [(r.src_ordinal, r.line_no, r.problem) for r in rows] == [
        (0, 8, "not a JSON object"), (0, 151, "broken JSON"), (0, 300, "broken JSON"), (1, 2, "not a JSON object")]
    assert read_jsonl(spark, [a, b], mode="quarantine").count() == 296 + 1
    with pytest.raises(JsonlError, match=r"not a JSON object at .*a\.jsonl:8"):
        tools.count(spark, a)
    with pytest.raises(JsonlError, match=r"b\.jsonl:2"):
        tools.merge(spark, [b], str(tmp_path / "out"))


def test_merge_keeps_order_and_duplicates(spark, tmp_path, small_splits):
    a = write(tmp_path / "z.jsonl", "".join('{"k": %d, "s":"%s"}\n' % (i, "p" * 50) for i in range(200)))
    b = write(tmp_path / "a.jsonl", '{"b": "\\u00e9/", "a": null}\n\n')
    out = str(tmp_path / "merged")
    assert tools.merge(spark, [a, b, a], out) == 401
    one = "".join('{"k":%d,"s":"%s"}\n' % (i, "p" * 50) for i in range(200))
    assert text_of(out) == one + '{"b":"é/","a":null}\n' + one
    with pytest.raises(Exception, match="(?i)already exists"):
        tools.merge(spark, [b], out)
    assert tools.merge(spark, [b, b], str(tmp_path / "any"), ordered=False) == 2


def test_a_failed_merge_leaves_nothing_and_lines_come_once(spark, tmp_path):
    inputs = [write(tmp_path / f"{k}.jsonl", "".join('{"k":%d}\n' % i for i in range(100))) for k in range(5)]
    broken = write(tmp_path / "broken.jsonl", '{"k":\n')
    conf = "mapreduce.fileoutputcommitter.algorithm.version"
    hadoop = spark._jsc.hadoopConfiguration()
    before = hadoop.get(conf)
    try:
        for version in ("1", "2"):
            hadoop.set(conf, version)
            for ordered in (True, False):
                out = tmp_path / f"out-{version}-{ordered}"
                write(tmp_path / "broken.jsonl", '{"k":\n')
                with pytest.raises(JsonlError, match="broken.jsonl:1"):
                    tools.merge(spark, [*inputs, broken], str(out), ordered)
                assert not [p for p in tmp_path.iterdir() if "out-" in p.name and p.name.lstrip(".").startswith(out.name)]
                write(tmp_path / "broken.jsonl", '{"k":NaN}\n')
                assert tools.merge(spark, [*inputs, broken], str(out), ordered) == 501
                assert len(text_of(str(out)).splitlines()) == 501
    finally:
        hadoop.set(conf, before or "1")


def test_of_repeated_members_the_last_counts(spark, tmp_path):
    path = write(tmp_path / "twice.jsonl", '{"a":1,"text":"x","a":2}\n{"b":{"c":1,"c":[2]}}\n')
    out = str(tmp_path / "merged")
    assert tools.merge(spark, [path], out) == 2
    assert text_of(out) == '{"a":2,"text":"x"}\n{"b":{"c":[2]}}\n'
    assert bad_lines(spark, [path]).count() == 0


def test_lines_only_python_decodes_pass(spark, tmp_path):
    path = write(tmp_path / "n.jsonl", '{"a":NaN}\n{"b":1}\n \n{"c":-Infinity,"d":"é"}\n')
    assert tools.count(spark, path) == 3
    for ordered in (True, False):
        out = str(tmp_path / f"out{ordered}")
        assert tools.merge(spark, [path], out, ordered) == 3
        assert sorted(text_of(out).split()) == ['{"a":NaN}', '{"b":1}', '{"c":-Infinity,"d":"é"}']
    assert bad_lines(spark, [path]).collect() == []
    worse = write(tmp_path / "w.jsonl", '{"a":NaN}\nNaN\n{"a":nan}\n')
    assert [(r.line_no, r.problem) for r in bad_lines(spark, [worse]).orderBy("line_no").collect()] == [
        (2, "not a JSON object"), (3, "broken JSON")]
    with pytest.raises(JsonlError, match="w.jsonl:2"):
        tools.count(spark, worse)


def test_count(spark, tmp_path):
    assert tools.count(spark, write(tmp_path / "a.jsonl", '{"a":1}\n\n{}\n')) == 2
    assert tools.count(spark, write(tmp_path / "b.JSON", '\ufeff[1, "x", {"a":[2]}, null, []]\n')) == 5
    assert tools.count(spark, write(tmp_path / "c.json", "[]")) == 0
    assert tools.count(spark, write(tmp_path / "e.jsonl", "")) == 0
    for name, data, reason in [("d.json", '{"a":1}', "no JSON array"), ("f.json", "[1] x", "broken JSON")]:
        with pytest.raises(Exception, match=reason):
            tools.count(spark, write(tmp_path / name, data))


def test_task_statistics(spark, tmp_path):
    kinds = ["b", " a ", "a", None, " ", 5, "b", "c", "a\u3000", "absent"]
    lines = [json.dumps({"x": 1} if k == "absent" else {"task_type": k}) for k in kinds]
    stats, totals = tools.task_statistics(spark, write(tmp_path / "s.jsonl", "\n".join(lines)))
    rows = [(r.task_type, r["count"], r.proportion) for r in stats.collect()]
    assert rows == [("a", 3, 0.3), ("b", 2, 0.2), ("c", 1, 0.1)]
    assert tuple(totals.first()) == (10, 4)
    stats, totals = tools.task_statistics(spark, write(tmp_path / "tie.jsonl", '{"task_type":"z"}\n{"task_type":"y"}\n'))
    assert [r.task_type for r in stats.collect()] == ["z", "y"]
    stats, totals = tools.task_statistics(spark, write(tmp_path / "none.jsonl", ""))
    assert stats.collect() == [] and tuple(totals.first()) == (0, 0)


def test_token_statistics(spark, tmp_path):
    path = write(tmp_path / "t.jsonl", "a b c\n\nnot json\r\nlast line here ok")
    assert tuple(tools.token_statistics(spark, path).first()) == (4, 9, 2.25, 0, 4)
    assert tuple(tools.token_statistics(spark, write(tmp_path / "e", "")).first()) == (0, 0, 0.0, 0, 0)


@pytest.mark.parametrize("data", ["ab\ncd", "ab\ncd\n", "\n\n", "a\r\nb\rc\r\n\r", "\ufeffab\r\nc", "x", "\n", "\ufeff\n"])
def test_tokens_see_each_physical_line_as_it_is(spark, tmp_path, data):
    """A counter of characters notices every line feed; the last line may lack one."""
    path = tmp_path / "t"
    path.write_bytes(data.encode("utf-8"))
    with open(path, encoding="utf-8-sig") as f:
        sizes = [len(line) for line in f]
    lengths = token_counter(lambda: lambda texts: [len(t) for t in texts])
    got = tools.token_statistics(spark, str(path), lengths).first()
    assert (got.lines, got.total_tokens, got.min_tokens, got.max_tokens) == (len(sizes), sum(sizes), min(sizes), max(sizes))


def test_calibration_set(spark, tmp_path):
    records = [
        {"instruction": f" i{n} ", "input": None if n == 3 else (" " if n % 2 else f"in{n}"), "output": f"o{n}"}
        for n in range(150)
    ]
    odd = ['[1]', '"x"', '{"instruction":"","output":"o"}', '{"instruction":"i"}', '{"instruction":null,"output":true}',
           '{"instruction":7,"output":"o","input":[1,"a"]}', '  ']
    lines = [json.dumps(r) for r in records]
    path = write(tmp_path / "c.jsonl", "\n".join(odd[:3] + lines[:70] + odd[3:] + lines[70:]))

    def usable():
        for line in open(path, encoding="utf-8"):
            if not line.strip():
                continue
            record = json.loads(line)
            if isinstance(record, dict):
                i, u, o = (str(record.get(k, "")).strip() for k in ("instruction", "input", "output"))
                if i and o:
                    yield i, u.replace("[1, 'a']", '[1,"a"]'), o

    pool = list(usable())
    for k in (64, 5, 1000):
        drawn = random.Random(42).sample(pool, min(k, len(pool)))
        expected = [[("user", i if not u else f"{i}\n\n{u}"), ("assistant", o)] for i, u, o in drawn]
        got = tools.calibration_set(spark, path, k).collect()
        assert [[tuple(m) for m in r.messages] for r in got] == expected
    with pytest.raises(RuntimeError, match="no valid"):
        tools.calibration_set(spark, write(tmp_path / "n.jsonl", "[1]\n"))
    with pytest.raises(JsonlError):
        tools.calibration_set(spark, write(tmp_path / "b.jsonl", '{"instruction":"i","output":"o"}\n{"a'))


def test_training_view(spark, tmp_path):
    path = write(tmp_path / "sft.jsonl", '{"task_type":"t","instruction":"i","input":"j","output":"o"}\n')
    row = tools.training_view(spark, path, "sft").first()
    assert row.asDict() == {"prompt": "i", "query": "j", "response": "o"}


def test_write_jsonl(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b\n"), (1, 'é"'), (3, "😀")], "n int, text string")
    out = str(tmp_path / "out")
    assert write_jsonl(rows, out, ["text"], ["n"]) == 3
    assert text_of(out) == '{"text":"é\\""}\n{"text":"b\\n"}\n{"text":"😀"}\n'
    with pytest.raises(Exception, match="(?i)already exists"):
        write_jsonl(rows, out, ["text"])


def test_list_papers(spark, tmp_path):
    for name in ("b.pdf", "a.pdf", "c.txt"):
        write(tmp_path / name, b"x")
    (tmp_path / "processed_1").mkdir()
    write(tmp_path / "processed_1" / "d.pdf", b"x")
    got = [r.doc_path.rsplit("/", 1)[1] for r in list_papers(spark, str(tmp_path)).orderBy("doc_path").collect()]
    assert got == ["a.pdf", "b.pdf"]
    with pytest.raises(FileNotFoundError):
        list_papers(spark, str(tmp_path / "none"))
    with pytest.raises(NotADirectoryError):
        list_papers(spark, str(tmp_path / "a.pdf"))


def test_read_records(spark, tmp_path):
    one = write(tmp_path / "one.json", '\ufeff{ "a" : "é" }')
    many = write(tmp_path / "many.json", '[{"b":1},\n {"b":{"z":1,"a":2}}]')
    assert [r.record_json for r in read_records(spark, one).collect()] == ['{"a":"é"}']
    assert [(r.item_no, r.record_json) for r in read_records(spark, many).collect()] == [(0, '{"b":1}'), (1, '{"b":{"z":1,"a":2}}')]
    assert read_records(spark, write(tmp_path / "empty.json", "[]")).collect() == []
    for name, data, reason in [("s.json", '[{"a":1},"{}"]', "an item of the array"), ("n.json", "7", "neither an object nor an array"),
                               ("j.json", '{"a":1} x', "not one JSON value")]:
        with pytest.raises(Exception, match=reason):
            read_records(spark, write(tmp_path / name, data)).collect()


def test_prompts(spark, tmp_path):
    folder = tmp_path / "SFT"
    folder.mkdir()
    for name in TASKS:
        write(folder / f"{name}.md", f"\u3000 {name} 提示\n\n")
    write(folder / "extra.md", "unused")
    got = {r.prompt_name: (r.task_type, r.prompt) for r in read_prompts(spark, str(folder)).collect()}
    assert got == {n: (t, f"{n} 提示") for n, t in TASKS.items()}
    first = next(iter(TASKS))
    write(folder / f"{first}.md", " \n")
    with pytest.raises(ConfigError, match="without text"):
        read_prompts(spark, str(folder))
    two = list(TASKS)[3:5]
    names = spark.createDataFrame([(n,) for n in TASKS if n not in two], "prompt_name string")
    assert sorted(r.prompt_name for r in missing_prompts(task_table(spark), names).collect()) == two
    other = tmp_path / "DPO"
    other.mkdir()
    write(other / f"{first}.md", "x")
    with pytest.raises(ConfigError, match="prompts not found: .*02_.*09_"):
        read_prompts(spark, str(other))
