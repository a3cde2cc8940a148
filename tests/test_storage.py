"""Published versions, the model store and the stored layout of the panel."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from packflow.config import ForecastConfig
from packflow.operators import features as FE
from packflow.operators import forecast as FC
from packflow.sources import binding as B
from packflow.sources import layout as LY
from packflow.sources import manifest as MF


def test_interrupted_export_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    assert MF.current(spark, root) == {}
    MF.export_results(spark, root, {"a": spark.range(3), "b": spark.range(2), "none": spark.range(0)})
    broken = spark.range(4).select(F.when(F.col("id") > 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        MF.export_results(spark, root, {"a": spark.range(9), "b": broken})
    got = MF.read_current(spark, root, ["a", "b"])
    assert got["a"].count() == 3 and got["b"].count() == 2
    MF.export_results(spark, root, {"a": spark.range(5)})
    assert MF.read_current(spark, root, ["a"])["a"].count() == 5
    with pytest.raises(ValueError, match="b"):
        MF.read_current(spark, root, ["b"])
    gone = MF.drop_old_versions(spark, root, keep=1)
    assert len(gone) == 2 and MF.read_current(spark, root, ["a"])["a"].count() == 5


def test_model_is_fitted_once(spark, tmp_path, monkeypatch):
    """Fit on a miss, reuse on a hit, fit again for other rows or after a save that died."""
    fits = []
    fit = FC.train_forest
    monkeypatch.setattr(FC, "train_forest", lambda *a: (fits.append(1), fit(*a))[1])
    cfg = ForecastConfig(num_trees=3, max_depth=3)
    train = spark.range(200).select(F.col("id").cast("double").alias("lag_7"), (F.col("id") % 7).cast("double").alias("SalesOrderQty"))
    publish = MF.publish
    monkeypatch.setattr(MF, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        FC.save_load_model(train, cfg, str(tmp_path))
    monkeypatch.setattr(MF, "publish", publish)
    first = FC.save_load_model(train, cfg, str(tmp_path))
    assert len(fits) == 2
    again = FC.save_load_model(train, cfg, str(tmp_path))
    assert len(fits) == 2
    a, b = (m.transform(train).select("lag_7", "prediction") for m in (first, again))
    assert a.exceptAll(b).count() == 0
    FC.save_load_model(train.where("lag_7 > 5"), cfg, str(tmp_path))
    assert len(fits) == 3


def test_master_layout(spark, tmp_path):
    m = B.master_table(spark, SF0001)
    LY.save_master(m, "layout_test", buckets=4, path=str(tmp_path / "m"))
    assert LY.load_master(spark, "layout_test").select(*m.columns).exceptAll(m).count() == 0
    one = LY.load_master(spark, "layout_test", dt.date(1995, 3, 1), dt.date(1995, 3, 31))
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Month" in filters and "1995-03" in filters
    read = one.select(F.regexp_extract(F.input_file_name(), "Month=([0-9-]+)", 1).alias("m")).distinct().collect()
    assert {r["m"] for r in read} == {"1995-03"}
    assert one.count() == m.where("Date between '1995-03-01' and '1995-03-31'").count() > 0
    part = LY.load_master(spark, "layout_test", dt.date(1995, 3, 10), dt.date(1995, 4, 5))
    assert part.count() == m.where("Date between '1995-03-10' and '1995-04-05'").count()


def test_bucketed_windows_do_not_shuffle(spark, tmp_path):
    LY.save_master(B.master_table(spark, SF0001), "layout_window", buckets=4, path=str(tmp_path / "m"))
    rows = LY.load_master(spark, "layout_window")
    daily = rows.groupBy("SkuId", "Date").agg(F.sum("SalesOrderQty").alias("SalesOrderQty"))
    plan = FE.lag_features(daily)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan


def test_layout_deals_a_bucket_over_many_tasks(spark):
    """The months of one bucket do not meet in one task; a month of it does."""
    rows = spark.range(600).select(F.concat(F.lit("P"), F.col("id") % 7).alias("SkuId"),
                                   F.concat(F.lit("1995-"), F.col("id") % 12).alias("Month"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        at = LY.dealt(rows, 1).withColumn("task", F.spark_partition_id()).select("Month", "task").distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len({r["task"] for r in at}) > 1 and len(at) == 12
