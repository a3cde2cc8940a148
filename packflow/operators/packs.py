"""Velocity profile, classes and pack recommendations (A01-A03, A13, J06,
J07, J16, K01-K08, W12).

Global scalars (largest mean, plant-wide mean) are one-row aggregates joined
back with a broadcast cross join, never unpartitioned windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packflow import config as C
from packflow.functions.exprs import class_lookup, round_half_even
from packflow.operators.common import exact_mean, mean
from packflow.operators.features import sku_first_attributes


def velocity_history(master: DataFrame) -> DataFrame:
    """Per SKU mean, sample std, CV, total, distinct days."""
    h = master.groupBy("SkuId").agg(
        mean("SalesOrderQty").alias("hist_mean"),
        F.stddev_samp("SalesOrderQty").alias("hist_std"),
        F.sum("SalesOrderQty").alias("hist_total"),
        F.countDistinct("Date").alias("n_days"))
    return h.withColumn("hist_cv", F.col("hist_std") / (F.col("hist_mean") + C.EPS)).select(
        "SkuId", "hist_mean", "hist_std", "hist_cv", "hist_total", "n_days")


def velocity_forecast(forecast: DataFrame) -> DataFrame:
    """Per SKU forecast mean and total."""
    return forecast.groupBy("SkuId").agg(mean("ForecastQty").alias("fcast_mean"),
                                         F.sum("ForecastQty").alias("fcast_total"))


def join_hist_forecast(hist: DataFrame, fcast: DataFrame, attrs: DataFrame) -> DataFrame:
    """History full-outer forecast, then left attributes; numeric nulls
    -> 0."""
    p = hist.join(fcast, "SkuId", "full_outer").join(attrs, "SkuId", "left")
    return p.na.fill(0, subset=["hist_mean", "hist_std", "hist_cv", "hist_total", "n_days",
                                "fcast_mean", "fcast_total"])


def velocity_profile(master: DataFrame, forecast: DataFrame) -> DataFrame:
    """A01 full-outer A02, left A03, nulls 0."""
    return join_hist_forecast(velocity_history(master), velocity_forecast(forecast),
                              sku_first_attributes(master))


def rule_classes(profile: DataFrame) -> DataFrame:
    """Deterministic velocity class (exact stand-in for the clustering):
    fast at >= 4/3 of the mean SKU mean, slow below 2/3 of it."""
    g = profile.agg(mean("hist_mean").alias("_g"))
    m, gm = F.col("hist_mean"), F.col("_g")
    cls = (F.when(m >= gm * (4.0 / 3.0), "fast_mover").when(m < gm * (2.0 / 3.0), "slow_mover")
           .otherwise("medium_mover"))
    return profile.crossJoin(F.broadcast(g)).withColumn("velocity_class", cls).drop("_g")


def pack_config_table(spark: SparkSession) -> DataFrame:
    """J16's lookup: the three pack configurations (fixed, 3 rows)."""
    schema = T.StructType([
        T.StructField("cfg_class", T.StringType()), T.StructField("PackConfig", T.StringType()),
        T.StructField("PackDescription", T.StringType()),
        T.StructField("PackMultiplier", T.LongType()), T.StructField("PackUnit", T.StringType()),
        T.StructField("CostFactor", T.DoubleType())])
    return spark.createDataFrame(C.PACK_CONFIGS, schema)


def join_pack_config(df: DataFrame, cls: str = "velocity_class") -> DataFrame:
    """Class -> label, text, multiplier, cost factor; unknown -> medium."""
    cfg = pack_config_table(df.sparkSession)
    key = F.when(F.col(cls).isin(*C.VELOCITY_CLASSES), F.col(cls)).otherwise(C.DEFAULT_CLASS)
    return (df.withColumn("_cfg_key", key)
            .join(F.broadcast(cfg), F.col("_cfg_key") == F.col("cfg_class"), "left")
            .drop("_cfg_key", "cfg_class", "PackUnit"))


def share_of_max(df: DataFrame, col: str, name: str) -> DataFrame:
    """Value / (max over the table + 1e-9), via a one-row aggregate."""
    mx = df.agg(F.max(col).alias("_mx"))
    return (df.crossJoin(F.broadcast(mx))
            .withColumn(name, F.col(col) / (F.col("_mx") + C.EPS)).drop("_mx"))


def justification_score(share: F.Column, cv: F.Column) -> F.Column:
    """round(min(100, share x 60) + max(0, 40 (1 - min(1, cv))), 1)."""
    vel = F.least(F.lit(100.0), share * 60)
    stab = F.greatest(F.lit(0.0), 40 * (1 - F.least(F.lit(1.0), cv)))
    return round_half_even(vel + stab, 1)


def recommended_pack_qty(fcast_mean: F.Column, multiplier: F.Column) -> F.Column:
    """max(1, round_half_even(fcast_mean x multiplier / 30))."""
    return F.greatest(F.lit(1), F.rint(fcast_mean * multiplier / 30).cast("bigint"))


def inventory_reduction(cls: F.Column) -> F.Column:
    """30 / 23 / 15 %, otherwise 20."""
    return class_lookup(cls, C.INVENTORY_REDUCTION_PCT, C.INVENTORY_REDUCTION_DEFAULT)


def pack_recommendations(profile: DataFrame) -> DataFrame:
    """The 16-column recommendation per SKU (profile needs
    ``velocity_class``)."""
    p = share_of_max(profile, "hist_mean", "_share")
    p = join_pack_config(p)
    return p.select(
        "SkuId", "ProductGroup", "SubGroup", "PlantId", "StorageLocationId",
        F.col("velocity_class").alias("VelocityClass"), "PackConfig", "PackDescription",
        "PackMultiplier",
        recommended_pack_qty(F.col("fcast_mean"), F.col("PackMultiplier")).alias("RecommendedPackQty"),
        justification_score(F.col("_share"), F.col("hist_cv")).alias("JustificationScore"),
        round_half_even("hist_mean", 1).alias("HistMeanDailyDemand"),
        round_half_even("fcast_mean", 1).alias("ForecastMeanDailyDemand"),
        round_half_even("hist_cv", 3).alias("DemandCV"),
        inventory_reduction(F.col("velocity_class")).alias("EstInventoryReductionPct"),
        "CostFactor")


def plant_mean_capacity(master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean production per plant, and the one-row global mean."""
    return capacity_means(plant_output(master))


def plant_output(master: DataFrame) -> DataFrame:
    """Exact sum and count of the production per plant: one pass over the
    panel, the same in every revision round."""
    return master.groupBy("PlantId").agg(
        F.sum(F.col("ProductionQty").cast("decimal(28,2)")).alias("_sum"),
        F.count("ProductionQty").alias("_count"))


def capacity_means(output: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean per plant and the one-row global mean from ``plant_output``."""
    per = output.select("PlantId", (F.col("_sum").cast("double") / F.col("_count")).alias("AvgPlantCapacity"))
    glob = output.agg((F.sum("_sum").cast("double") / F.sum("_count")).alias("_global_cap"))
    return per, glob


def capacity_check(reco: DataFrame, master: DataFrame, output: DataFrame | None = None) -> DataFrame:
    """Plant mean capacity (gaps -> global mean), feasible flag;
    ``output`` may hold a stored ``plant_output``."""
    per, glob = capacity_means(output if output is not None else plant_output(master))
    r = (reco.join(per, "PlantId", "left").crossJoin(F.broadcast(glob))
         .withColumn("AvgPlantCapacity", F.coalesce("AvgPlantCapacity", "_global_cap"))
         .drop("_global_cap"))
    r = r.withColumn("CapacityFeasible", F.col("RecommendedPackQty") <= F.col("AvgPlantCapacity"))
    return r.select(*reco.columns, "AvgPlantCapacity", "CapacityFeasible")


def downgrade_unprofitable(reco: DataFrame, flagged: DataFrame) -> DataFrame:
    """Listed SKUs -> slow mover, its label and multiplier, score x 0.7
    (quantity, cost factor and inventory % unchanged)."""
    slow = [c for c in C.PACK_CONFIGS if c[0] == C.DOWNGRADE_CLASS][0]
    f = flagged.select("SkuId").distinct().withColumn("_flag", F.lit(True))
    r = reco.join(f, "SkuId", "left")
    hit = F.col("_flag").isNotNull()
    out = r.withColumns({
        "VelocityClass": F.when(hit, F.lit(slow[0])).otherwise(F.col("VelocityClass")),
        "PackConfig": F.when(hit, F.lit(slow[1])).otherwise(F.col("PackConfig")),
        "PackMultiplier": F.when(hit, F.lit(slow[3]).cast("bigint")).otherwise(F.col("PackMultiplier")),
        "JustificationScore": F.when(hit, F.col("JustificationScore") * C.DOWNGRADE_SCORE_FACTOR)
                               .otherwise(F.col("JustificationScore")),
    })
    return out.select(*reco.columns)


def pack_summary(reco: DataFrame) -> DataFrame:
    """Class counts, mean score, mean reduction, infeasible count."""
    vc = F.col("VelocityClass")
    return reco.agg(
        F.count_if(vc == "fast_mover").alias("fast_movers"),
        F.count_if(vc == "medium_mover").alias("medium_movers"),
        F.count_if(vc == "slow_mover").alias("slow_movers"),
        round_half_even(exact_mean("JustificationScore", 6), 1).alias("avg_justification_score"),
        round_half_even(exact_mean("EstInventoryReductionPct", 6), 1).alias("avg_inventory_reduction_pct"),
        F.count_if(~F.col("CapacityFeasible")).alias("capacity_infeasible_count"))


def classed_profile(master: DataFrame, forecast: DataFrame, classes: str = "rule",
                    cluster_cfg=None) -> DataFrame:
    """Velocity profile with ``velocity_class`` (rule or KMeans). The profile is
    written once: the classes, the largest mean and the recommendations each
    read it, and none of them goes back to the panel and the forecast."""
    prof = velocity_profile(master, forecast).checkpoint(eager=True)
    if classes == "kmeans":
        from packflow.operators.clustering import cluster_velocity
        return cluster_velocity(prof, cluster_cfg)
    return rule_classes(prof)


def optimize_packs(master: DataFrame, forecast: DataFrame, classes: str = "rule",
                   flagged: DataFrame | None = None, cluster_cfg=None,
                   profile: DataFrame | None = None, output: DataFrame | None = None) -> dict:
    """Pack step: profile -> classes -> recommendations -> (downgrade) ->
    capacity check. ``classes`` is ``"rule"`` (exact) or ``"kmeans"``; a
    precomputed classed ``profile`` and ``plant_output`` are reused as they are
    (revision rounds)."""
    prof = profile if profile is not None else classed_profile(master, forecast, classes, cluster_cfg)
    reco = pack_recommendations(prof)
    if flagged is not None:
        reco = downgrade_unprofitable(reco, flagged)
    reco = capacity_check(reco, master, output)
    return {"profile": prof, "recommendations": reco, "summary": pack_summary(reco)}
