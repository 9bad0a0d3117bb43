import re

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from sheaf.llm import queries

NAMES = [f"op{n}" for n in range(1, 14)]


def test_all_are_registered():
    assert [q.__name__.split("_")[0] for q in queries.QUERIES] == NAMES
    assert {q.__name__ for q in queries.QUERIES} | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = con.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    df = contract.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_stages_of_the_pipeline(spark, sf_dir):
    """Each stage against what its operator decides on the stage's own input, by brute force."""
    from tests.llm.test_near_dedup import brute as near_brute
    from tests.llm.test_quality_rules import brute as measure
    from sheaf.llm.quality_rules import RULES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.stage(function(spark, docs, sf_dir), f"test-stage-{k}")
        kept.append((docs.collect(), out.collect()))
        if k < 4:
            assert out.columns == columns
        docs = out
    before, after = kept[0]
    good = {
        r["doc_id"] for r in before
        if not any(eval(rule.replace(" = ", " == "), {}, measure(r["text"])) for rule in RULES.values())
    }
    assert {r["doc_id"] for r in after} == good
    before, after = kept[1]
    norm = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r["text"])
    assert sorted(map(norm, after)) == sorted(set(map(norm, before)))
    before, after = kept[2]
    components, groups = near_brute(before, 5)
    assert {r["doc_id"] for r in after} == {c for _, _, c in components} and len(after) == groups
    before, after = kept[3]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    changed = {r["doc_id"]: r for r in after}
    secret = re.compile(r"(?ai)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{12,}|[0-9a-f]{16,}")
    for r in before:
        now = changed[r["doc_id"]]
        assert not secret.search(now["text"])
        if now["text"] == r["text"]:
            assert now == r
    before, after = kept[4]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(rows.columns)
    assert rows.count() > 0
