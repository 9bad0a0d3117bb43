import numpy as np
import pytest

from sheaf.llm import whitening as wh


def brute(vectors):
    """x, n, S, covariance and deviations, in Python integers."""
    x = [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    cov = np.array([[(n * sum(r[i] * r[j] for r in x) - s[i] * s[j]) / n**2 for j in range(d)] for i in range(d)])
    return x, n, s, cov, [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(parts)


@pytest.mark.parametrize("dims,n,scale", [(5, 200, 0.2), (40, 130, 3.0), (1, 64, 1.0), (3, 65, 1e4)])
def test_matches_integers(spark, dims, n, scale):
    rng = np.random.default_rng(dims)
    rows = (rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims)) * scale).astype(np.float32)
    out = wh.whitened(frame(spark, [(k, r.tolist()) for k, r in enumerate(rows)])).collect()
    x, count, s, cov, deviations = brute(rows)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1][:32]
    assert len(out) == n * min(dims, 32)
    found = np.zeros((n, min(dims, 32)))
    for r in out:
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == count and r["deviation"] == deviations[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-4)
        assert r["identity_error"] <= 1e-4
    assert np.abs(np.cov(found.T, bias=True).reshape(found.shape[1], -1) - np.eye(found.shape[1])).max() < 1e-6
    # projected on unit eigenvectors: V z = e z for the axes that the whitened rows imply
    centred = np.array(x, float) - np.array(s) / n
    axes = np.linalg.lstsq(centred, found, rcond=None)[0] * np.sqrt(values) if dims <= 5 else None
    if axes is not None:
        assert np.allclose(cov @ axes, axes * values, atol=1e-6 * values[0])


def test_scatter_is_exact_however_rows_are_split():
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**58), 2**58, size=(300, 3))
    x[:, 1] = 7
    least, most = x.min(0).tolist(), x.max(0).tolist()
    totals = []
    for cut in (300, 37):
        u = np.zeros((4, 4), object)
        for k in range(0, 300, cut):
            part = wh.Scatter(least, most)
            part.add(x[k : k + cut])
            for r in part.rows().to_pylist():
                u[r["i"], r["j"]] += r["total"] << (wh.LIMB * r["limb"])
        totals.append(u)
    assert (totals[0] == totals[1]).all()
    rows = [[v - a for v, a in zip(r, least)] + [1] for r in x.tolist()]
    for i in range(4):
        for j in range(i, 4):
            assert totals[0][i, j] == sum(r[i] * r[j] for r in rows)


def test_unusable_rows_go_and_odd_ones_stay(spark):
    good = [(k, [0.1 * k, 1.0 - k, 0.5]) for k in range(10)] + [(3, [0.3, -2.0, 0.5]), (None, [9.0, 9.0, 9.0])]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [float("nan"), 1.0, 1.0]), (93, [float("inf"), 1.0, 1.0]),
           (94, []), (95, [1.0, 2.0]), (96, [3e38, 1.0, 1.0])]
    table = frame(spark, good + bad).selectExpr(
        "vec_id", "embedding", "1 AS n", "'x' AS v", "2 AS w", "0 AS k", "1 AS `a.b`", "1.0D AS deviation"
    )
    out = wh.whitened(table).collect()
    assert {r["vec_id"] for r in out} == set(range(10)) | {None}
    assert len(out) == 12 * 3 and {r["n"] for r in out} == {12}
    assert len({(r["component"], r["whitened"]) for r in out if r["vec_id"] == 3}) == 3  # repeated rows are alike


def test_without_variance(spark):
    out = wh.whitened(frame(spark, [(1, [0.5, 0.25])] * 3)).collect()
    assert len(out) == 6
    assert all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in out)
    flat = wh.whitened(frame(spark, [(k, [float(k), 2.0 * k]) for k in range(9)])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat)
    assert all(r["identity_error"] < 1e-9 for r in flat)


def test_no_rows(spark):
    out = wh.whitened(frame(spark, []))
    assert out.columns == [c.split()[0] for c in wh.SCHEMA.split(", ")] and out.count() == 0
    assert wh.whitened(frame(spark, [(1, None)])).count() == 0


def test_too_large_a_deviation_is_null(spark):
    out = wh.whitened(frame(spark, [(k, [k * 1e9, 0.0]) for k in range(5)])).collect()
    assert {r["deviation"] for r in out if r["vec_id"] == 0} == {None}
    assert {r["deviation"] for r in out if r["vec_id"] == 2} != {None}
