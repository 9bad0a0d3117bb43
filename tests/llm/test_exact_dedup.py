import hashlib
import re
from collections import defaultdict

import pytest

from sheaf.llm import exact_dedup as ed


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("fan_in", [2, 16])
def test_matches_brute_force(spark, odd, sf_dir, fan_in):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").repartition(7)
    docs = docs.unionByName(odd.select("doc_id", "text"))
    groups = defaultdict(list)
    for r in docs.collect():
        groups[norm(r["text"])].append((-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
    rows = ed.exact_duplicates(docs, fan_in).collect()
    assert len(rows) == docs.count()
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in rows:
        best = min(by_hash[r["text_sha256"]])
        assert r["keep_id"] == (None if best[1] else best[2])
        assert r["group_size"] == len(by_hash[r["text_sha256"]])
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_one_row_of_each_group_stays(odd):
    kept = ed.without_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [norm(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({norm(r["text"]) for r in odd.collect()})


def test_no_rows(nothing):
    assert ed.exact_duplicates(nothing).count() == 0
    assert ed.without_duplicates(nothing).columns == nothing.columns


def test_a_hot_text_leaves_a_run_once(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot  text', concat('t', id)) AS text").repartition(8)
    rows = ed.exact_duplicates(docs, 2)
    assert rows.filter("group_size = 1000").count() == 1000
    assert rows.filter("kept").count() == 2001
