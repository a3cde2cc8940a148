"""Distributed exact positions and quantiles against NumPy."""

import numpy as np

from packflow.operators.ranking import exact_quantiles, global_index


def test_global_index_matches_sort(spark):
    rng = np.random.default_rng(1)
    vals = rng.integers(0, 1000, 500).tolist()
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(vals)], "id long, v long").repartition(7)
    got = sorted((r.idx, r.v, r.id) for r in global_index(df, ["v", "id"]).collect())
    want = sorted((v, i) for i, v in enumerate(vals))
    assert [g[0] for g in got] == list(range(500))
    assert [(g[1], g[2]) for g in got] == want


def test_exact_quantiles_grouped(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if i % 3 else "b", float(x)) for i, x in enumerate(rng.normal(size=301))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {(r.g, r.p): r.q for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9], "g").collect()}
    for g in "ab":
        arr = np.array([v for k, v in rows if k == g])
        for p in (0.1, 0.5, 0.9):
            assert abs(got[(g, p)] - np.percentile(arr, p * 100)) < 1e-12


def test_selection_over_many_passes(spark, monkeypatch):
    """Few bins and no shortcut: ranges are narrowed pass by pass to the exact
    order statistics, with ties, heavy tails, groups and odd values."""
    import numpy as np
    from packflow.operators import ranking as R
    monkeypatch.setattr(R, "BINS", 8)
    monkeypatch.setattr(R, "FEW", 0)
    rng = np.random.RandomState(1)
    v = np.concatenate([np.exp(rng.randn(400) * 12), -np.exp(rng.randn(100) * 9), np.repeat(3.25, 120), [0.0, -0.0, 1e308, -1e308]])
    rows = [("a", float(x)) for x in v] + [("b", float(i % 3)) for i in range(50)] + [("c", 7.5), (None, 1.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in R.exact_quantiles(df, "v", probs, "g").collect()}
    for g in ("a", "b", "c", None):
        x = np.sort([b for a, b in rows if a == g and b is not None])
        for p in probs:
            h = (len(x) - 1) * p
            lo, hi = x[int(np.floor(h))], x[int(np.ceil(h))]
            assert got[(g, p)] == lo + (hi - lo) * (h - np.floor(h)), (g, p)
    assert not any(k[0] == "d" for k in got)


def test_selection_sorts_nothing(spark, monkeypatch):
    from packflow.operators import ranking as R
    monkeypatch.setattr(R, "FEW", 1000)
    df = spark.range(20000).selectExpr("cast(id * 7919 % 20011 as double) as v")
    q = R.exact_quantiles(df, "v", [0.5])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    x = sorted(i * 7919 % 20011 for i in range(20000))
    assert q.first()["q"] == (x[9999] + x[10000]) / 2


def test_infinite_values_and_nothing(spark):
    from packflow.operators import ranking as R
    df = spark.createDataFrame([(float("inf"),), (1.0,), (float("-inf"),), (2.0,), (float("nan"),)], "v double")
    got = {r["p"]: r["q"] for r in R.exact_quantiles(df, "v", [0.25, 0.5, 0.75]).collect()}
    assert got == {0.25: 1.0, 0.5: 2.0, 0.75: float("inf")}
    assert R.exact_quantiles(df.where("v = 5"), "v", [0.5]).count() == 0


def test_distinct_counts_without_copies(spark):
    from packflow.operators import ranking as R
    df = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("a", 2, None)], "x string, y int, z string")
    out = R.distinct_counts(df, ["x", "y", "z"])
    assert tuple(out.first()) == (2, 2, 0)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert tuple(R.distinct_counts(df.limit(0), ["x", "y"], ["a", "b"]).first()) == (0, 0)
