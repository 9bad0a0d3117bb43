import zlib

import numpy as np

from sheaf.llm import quality_model as qm
from sheaf.llm.boosting import fit


def one_by_one(trees, row):
    total = trees.bias
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        k = 0
        while k < len(feature):
            k = 2 * k + 1 + bool(row[feature[k]] > threshold[k])
        total += leaf[k - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_traversal_matches_one_row_at_a_time():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(500, 5))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 3] > 0)).astype(float)
    trees = fit(rows, labels, trees=20)
    got = trees.probability(rows)
    assert np.allclose(got, [one_by_one(trees, r) for r in rows])
    assert ((got > 0.5) == labels).mean() > 0.97
    # binned training and plain comparison agree on values that are cut points
    odd = np.array([[c, 0, 0, c, 0] for c in trees.threshold[np.isfinite(trees.threshold)]])
    assert np.isfinite(trees.probability(odd)).all()


def test_no_rows_or_one_label():
    assert fit(np.empty((0, 3)), np.empty(0)).probability(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (fit(np.ones((4, 3)), np.ones(4)).probability(np.zeros((1, 3))) > 0.5).all()
    assert len(fit(np.ones((9, 2)), np.array([0.0, 1] * 4 + [1])).probability(np.empty((0, 2)))) == 0


def test_held_out_documents_are_told_apart(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in qm.scored(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    held = [(rows[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert np.mean([p == q for p, q in held]) > 0.97


def test_held_out_labels_are_not_used(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, 1 - quality, quality) AS quality", "toxic"
    )
    a, b = ({r["doc_id"]: r["score"] for r in qm.scored(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(0, 1), (0, 0), (4, None), (None, 1), (5, 7), (6, 1)], "doc_id bigint, quality int"
    )
    rows = qm.scored(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] is not None for r in rows)
    assert qm.scored(nothing, labels).count() == 0
    assert {r["score"] for r in qm.scored(odd, labels.limit(0)).collect()} == {0.5}
