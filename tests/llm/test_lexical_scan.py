import math
import re
from collections import Counter

import numpy as np
import pytest

from sheaf.llm import lexical_scan as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return TERM.findall(lower)


def brute(docs, items):
    """Rows of docs and items are (id, text); results are (item number, rank, doc_id, score)."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    n_all = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for k, (_, text) in enumerate(items):
        scores = []
        for i, c in counted:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // max(n_all, 1)
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda r: r[:3])[:10], 1):
            out.append((items[k][0], rank, i, -s))
    return out


def check(spark, docs, items, **kw):
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string").coalesce(1)
    rows = ls.ranked(table, asked, **kw).collect()
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows]
    assert sorted(got, key=repr) == sorted(brute(docs, items), key=repr)


@pytest.mark.parametrize("block_bytes", [ls.BLOCK_BYTES, 20_000])
def test_matches_brute_force(spark, sf_dir, block_bytes):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    check(spark, docs, items, block_bytes=block_bytes)


def test_ties_repeats_and_odd_texts(spark):
    docs = [(k, "same words here") for k in range(30, 0, -1)]
    docs += [(5, "same words here"), (None, "same words here"), (100, None), (101, ""), (102, " \t-_"), (103, "ÄÖ ä naïve中文 X9"),
             (104, "word " * 40_000), (105, "x" * 200_000), (106, "SAME-same\x00same\x7fsame")]
    items = [(0, "Same words"), (0, "Same words"), (1, None), (2, "..."), (3, "naïve中文 naïve中文 Ä ÄÖ"), (4, "word word"),
             (5, "x" * 200_000), (6, "absent"), (7, "x9"), (None, "here")]
    check(spark, docs, items)


def test_extra_columns_and_empty_tables(spark, odd, nothing):
    items = spark.createDataFrame([(1, "one two"), (2, "same line")], "item_id bigint, text string")
    wide = odd.selectExpr("*", "1 AS n", "2 AS `a.b`", "3 AS terms", "4 AS item", "5 AS rank")
    got = ls.ranked(wide, items.selectExpr("*", "1 AS item", "2 AS times")).collect()
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()], [(1, "one two"), (2, "same line")])
    assert sorted((r["item_id"], r["rank"], r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in got) == sorted(
        (a, b, c is None, c or 0, d) for a, b, c, d in want
    )
    assert ls.ranked(nothing, items).count() == 0
    assert ls.ranked(odd, items.limit(0)).count() == 0


def test_best_keeps_the_same_rows_in_any_order():
    rng = np.random.default_rng(3)
    scores = rng.integers(0, 6, (500, 7))
    ids = rng.permutation(500)
    best = ls.Best(7, 10)
    for part in np.array_split(rng.permutation(500), 60):
        best.add(scores[part], ids[part], np.zeros(len(part), np.int64))
    found = best.thin()
    for item in range(7):
        want = sorted((-s, i) for s, i in zip(scores[:, item].tolist(), ids.tolist()) if s > 0)[:10]
        assert [(r[1], r[3]) for r in found.tolist() if r[0] == item] == want
