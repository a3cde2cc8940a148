"""Invariants of the MLlib steps on sf0.001 (small forest)."""

from pyspark.sql import functions as F

from conftest import SF0001
from packflow.config import ClusterConfig, ForecastConfig
from packflow.operators import clustering as CL
from packflow.operators import forecast as FC
from packflow.operators.features import daily_series, naive_forecast
from packflow.operators.packs import velocity_profile
from packflow.sources import binding as B


def test_forest_forecast_invariants(spark):
    m = B.master_table(spark, SF0001)
    res = FC.forecast(m, ForecastConfig(num_trees=5, max_depth=4, horizon_days=7))
    fc = res["forecast"]
    skus = m.select("SkuId").distinct().count()
    assert fc.count() == skus * 7
    bad = fc.where((F.col("CI_Lower") > F.col("CI_Upper")) | (F.col("ForecastQty") < 0)
                   | (F.col("CI_Lower") < 0)).count()
    assert bad == 0
    assert res["metrics"].first().n_rows > 0
    assert res["importance"].count() == 12


def test_kmeans_classes_ordered(spark):
    m = B.master_table(spark, SF0001)
    prof = velocity_profile(m, naive_forecast(daily_series(m)))
    c = CL.cluster_velocity(prof, ClusterConfig(restarts=2))
    means = {r.velocity_class: r.m for r in c.groupBy("velocity_class").agg(F.avg("hist_mean").alias("m")).collect()}
    assert set(means) <= {"fast_mover", "medium_mover", "slow_mover"}
    if len(means) == 3:
        assert means["fast_mover"] > means["medium_mover"] > means["slow_mover"]
