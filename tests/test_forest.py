"""The flattened forest against the model itself, and the joint restarts of k-means."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from packflow.config import ClusterConfig, ForecastConfig
from packflow.operators import clustering as CL
from packflow.operators import forecast as FC
from packflow.operators import forest as FO


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.RandomState(0)
    rows = [(f"S{i % 9}", *rng.rand(3).tolist(), float(rng.randint(2))) for i in range(3000)]
    df = spark.createDataFrame(rows, "SkuId string, lag_7 double, lag_14 double, rolling_mean_7 double, Promotional_Flag double")
    df = df.withColumn("SalesOrderQty", 10 * F.col("lag_7") + F.col("Promotional_Flag") * F.sin(9 * F.col("lag_14")))
    df = df.checkpoint()
    return df, FC.train_forest(df, ForecastConfig(num_trees=12, max_depth=9))


@pytest.mark.parametrize("group_bytes", [256 << 20, 20_000])
def test_equal_predictions(spark, fitted, monkeypatch, group_bytes):
    """Bit for bit the forest's and each tree's own predictions, in one group or several."""
    monkeypatch.setattr(FO, "GROUP_BYTES", group_bytes)
    df, model = fitted
    got = FO.tree_predictions(model, model.transform(df).drop("features"))
    own = F.aggregate("_trees", F.lit(0.0), lambda s, x: s + x) / 12.0
    assert got.where(own != F.col("prediction")).count() == 0 and got.count() == 3000
    tree = model.stages[-1].trees[7].copy().setPredictionCol("tree7")
    both = tree.transform(model.stages[0].transform(got))
    assert both.where(F.col("tree7") != F.col("_trees")[7]).count() == 0
    if group_bytes < 1 << 20:
        assert len(FO.tree_groups(FO.node_table(model))) > 1


def test_interval_is_one_pass(fitted):
    df, model = fitted
    out = FC.forecast_interval(model, df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "UDF(" not in plan and "_p0" not in plan
    r = out.where("ForecastQty < CI_Lower - 20 or CI_Lower > CI_Upper").count()
    assert r == 0 and set(out.columns) == {*df.columns, "ForecastQty", "CI_Lower", "CI_Upper"}


def test_a_leaf_is_a_whole_tree(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "lag_7 double, SalesOrderQty double")
    model = FC.train_forest(df, ForecastConfig(num_trees=3, max_depth=4))
    assert {r["ForecastQty"] for r in FC.forecast_interval(model, df).collect()} == {5.0}


def profile(spark, rows):
    z = ", ".join(f"z_{c} double" for c in CL.VELOCITY_FEATURES)
    return spark.createDataFrame(rows, f"SkuId string, {z}")


def lloyd(x, points, rounds):
    for _ in range(rounds):
        owner = ((x[:, None] - points) ** 2).sum(2).argmin(1)
        points = np.array([x[owner == k].mean(0) if (owner == k).any() else points[k] for k in range(len(points))])
    return points, ((x[:, None] - points) ** 2).sum(2).min(1).sum()


def test_joint_restarts_are_separate_runs(spark):
    """Every restart ends where a run of its own from the same seeds ends; the cheapest one is kept."""
    rng = np.random.RandomState(3)
    x = np.concatenate([rng.randn(60, 4) + c for c in ([0] * 4, [6] * 4, [0, 6, 0, 6])])
    df = profile(spark, [(f"S{i}", *map(float, v)) for i, v in enumerate(x)]).repartition(5)
    cfg = ClusterConfig(restarts=6)
    got = CL.fit_kmeans(df, cfg)
    cols = [f"z_{c}" for c in CL.VELOCITY_FEATURES]
    raw = df.select(*[F.col(z).alias(c) for z, c in zip(cols, CL.VELOCITY_FEATURES)])
    sample = np.array([list(r) for r in raw.orderBy(F.xxhash64(*raw.columns), *raw.columns).collect()])
    costs = [lloyd(x, CL.seed_centres(sample, 3, np.random.RandomState(cfg.seed + r)), 50)[1] for r in range(6)]
    assert got.costs == pytest.approx(costs) and got.cost == pytest.approx(min(costs))
    named = df.withColumn("k", CL.nearest_centre(got)).collect()
    own = {r["SkuId"]: int(((np.array([r[c] for c in cols]) - got.points) ** 2).sum(1).argmin()) for r in named}
    assert {r["SkuId"]: r["k"] for r in named} == own
    # a point of each group in a class of its own
    assert len({own["S0"], own["S70"], own["S150"]}) == 3


def test_kmeans_of_few_and_equal_rows(spark):
    assert CL.fit_kmeans(profile(spark, []), ClusterConfig(restarts=2)).cost == 0
    same = profile(spark, [(f"S{i}", 1.0, 1.0, 1.0, 1.0) for i in range(5)])
    assert CL.fit_kmeans(same, ClusterConfig(restarts=2)).cost == 0
    assert {r["k"] for r in same.withColumn("k", CL.nearest_centre(CL.fit_kmeans(same))).collect()} == {0}


def test_fit_reads_few_partitions(spark):
    """A fit reads two partitions a core at most, and every row."""
    from packflow.operators.forecast import few_partitions
    got = few_partitions(spark.range(1000).repartition(200).toDF("x"))
    assert got.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert got.count() == 1000
    assert few_partitions(spark.range(5).repartition(1).toDF("x")).rdd.getNumPartitions() == 1


def saved_nodes(spark, forest):
    from packflow.session import shared_path
    path = shared_path(spark, "test", "forest")
    forest.write().save(path)
    rows = spark.read.parquet(f"{path}/data").orderBy("treeID", "nodeData.id").collect()
    return [(r["treeID"], *r["nodeData"][:9]) for r in rows]


@pytest.mark.parametrize("block, group_bytes", [(64, 256 << 20), (1, 3000)])
def test_fit_grows_mllib_trees(spark, monkeypatch, block, group_bytes):
    """Without draws the packed fit has MLlib's nodes, whether a level is counted in one job or in several."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from packflow.operators import forest_fit as FF
    monkeypatch.setattr(FF, "BLOCK", block)
    monkeypatch.setattr(FF, "GROUP_BYTES", group_bytes)
    rng = np.random.RandomState(1)
    a, b, c = rng.rand(2500), rng.randint(0, 5, 2500), rng.randint(0, 300, 2500)
    y = 10 * a + b * np.sin(3 * a) + 0.01 * c + rng.normal(size=2500)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c, y)], "a double, b double, c double, y double")
    df = df.withColumn("one", F.lit(1.0)).repartition(3).checkpoint()
    cols = ["a", "b", "one", "c"]
    rf = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=1, featureSubsetStrategy="all", maxDepth=4,
                               seed=42, bootstrap=False)
    want = saved_nodes(spark, rf.fit(VectorAssembler(inputCols=cols, outputCol="features").transform(df)))
    got = saved_nodes(spark, FF.fit_forest(df, cols, "y", 1, 4, 42, bootstrap=False))
    assert len(got) == len(want) > 25
    for w, g in zip(want, got):
        assert g[:2] + g[7:9] == w[:2] + w[7:9] and g[9][:2] == w[9][:2] and g[5] == w[5]
        assert (*g[2:4], g[6], *g[4]) == pytest.approx((*w[2:4], w[6], *w[4]), abs=1e-9)


def test_fit_draws_rows(spark):
    """Trees differ, each draws as many rows as there are on average, and a fit can be repeated."""
    from packflow.operators import forest_fit as FF
    rng = np.random.RandomState(4)
    df = spark.createDataFrame([(float(v), float(int(300 * v + 100 * e))) for v, e in zip(rng.rand(4000), rng.rand(4000))], "x double, y double").checkpoint()
    one, two = (FF.fit_forest(df, ["x"], "y", 6, 5, 42) for _ in range(2))
    assert saved_nodes(spark, one) == saved_nodes(spark, two)
    roots = [n for n in saved_nodes(spark, one) if n[1] == 0]
    assert len({n[2] for n in roots}) == 6 and all(abs(n[5] - 4000) < 350 for n in roots)
    w = FF.draws(42, (0, 0), 3, 400_000)
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
    with pytest.raises(ValueError):
        FF.fit_forest(df.limit(0), ["x"], "y", 2, 2, 1)
    with pytest.raises(Exception, match="null|NaN"):
        FF.fit_forest(df.withColumn("x", F.when(F.col("x") > 0.5, F.col("x"))), ["x"], "y", 2, 2, 1)


def test_interval_gives_no_lists(spark, fitted, monkeypatch):
    """The interval is taken where the trees are walked, in one group or several."""
    df, model = fitted
    one = FC.forecast_interval(model, df)
    assert "array_sort" not in one._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(FO, "GROUP_BYTES", 20_000)
    several = FC.forecast_interval(model, df)
    assert several.schema == one.schema and sorted(several.collect()) == sorted(one.collect())
    trees = np.array([r["_trees"] for r in FO.tree_predictions(model, df).collect()])
    want = np.maximum(np.quantile(trees, 0.9, axis=1), 0)
    assert [r["CI_Upper"] for r in one.collect()] == pytest.approx(list(want))
