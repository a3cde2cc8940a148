"""Production planning: plant statistics, EOQ batches, schedule, utilisation.

All per-plant and per-SKU x plant tables are hash aggregates (partial +
final). The SKU count per plant, which the schedule needs on every row, is
taken from the plant statistics join instead of a window over the plant, so
a plant holding a third of all SKUs is handled by the (AQE-splittable) join,
not by one window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow import config as C
from packflow.functions.exprs import bin_right_closed, clip, eps_div, round_half_even
from packflow.operators.common import exact_mean, exact_sum, first_by, mean


def plant_totals(master: DataFrame) -> DataFrame:
    """Nine per-plant measures. Sums meet per (plant, SKU) and days per
    (plant, day) first, so no fact row is copied for a distinct count."""
    dec = "decimal(38,2)"
    sku = master.groupBy("PlantId", "SkuId").agg(
        F.sum(F.col("ProductionQty").cast(dec)).alias("p"), F.count("ProductionQty").alias("pn"),
        F.max("ProductionQty").alias("pm"),
        F.sum(F.col("FactoryIssueQty").cast(dec)).alias("i"), F.count("FactoryIssueQty").alias("in"),
        F.sum("SalesOrderQty").alias("s"), F.count("SalesOrderQty").alias("sn"))
    prod, issue = F.sum("p").cast("double"), F.sum("i").cast("double")
    t = sku.groupBy("PlantId").agg(
        prod.alias("TotalProductionQty"),
        (prod / F.sum("pn")).alias("AvgDailyProduction"),
        F.max("pm").alias("MaxDailyProduction"),
        issue.alias("TotalFactoryIssueQty"),
        (issue / F.sum("in")).alias("AvgFactoryIssueQty"),
        F.sum("s").alias("TotalSalesOrderQty"),
        (F.sum("s") / F.sum("sn")).alias("AvgDailySales"),
        F.count("SkuId").alias("SKU_Count"),
    )
    days = master.select(F.col("PlantId").alias("_plant"), "Date").distinct().groupBy("_plant").agg(
        F.count("Date").alias("DataDays"))
    return t.join(days, F.col("PlantId").eqNullSafe(F.col("_plant"))).drop("_plant")


def plant_statistics(master: DataFrame) -> DataFrame:
    """Totals + issue rate, capacity, utilisation, risk flag."""
    t = plant_totals(master)
    prod, issue = F.col("TotalProductionQty"), F.col("TotalFactoryIssueQty")
    raw = F.when(prod > 0, eps_div(issue, prod)).otherwise(F.lit(0.0))
    return (t.withColumn("FactoryIssueRate", clip(F.abs(raw - 1.0), 0.0, 1.0))
            .withColumn("EstCapacity", F.col("MaxDailyProduction") * C.CAPACITY_HEADROOM)
            .withColumn("CurrentUtilisation",
                        clip(eps_div("AvgDailyProduction", "EstCapacity"), 0.0, 1.0))
            .withColumn("RiskFlag", F.col("FactoryIssueRate") > C.ISSUE_RATE_THRESHOLD))


def batch_size_eoq(demand: str | F.Column, unit_cost: str | F.Column) -> F.Column:
    """max(50, round(sqrt(2 d 365 S / h))) with h = 0.22 cost; 100 when
    d or h is not positive."""
    d = F.col(demand) if isinstance(demand, str) else demand
    h = (F.col(unit_cost) if isinstance(unit_cost, str) else unit_cost) * C.EOQ_HOLDING_RATE
    eoq = F.sqrt(F.lit(2.0) * d * C.DAYS_PER_YEAR * C.EOQ_SETUP_COST / h)
    return (F.when((d <= 0) | (h <= 0) | d.isNull() | h.isNull(), F.lit(C.EOQ_FALLBACK))
            .otherwise(F.greatest(F.lit(C.EOQ_MIN_BATCH), F.rint(eoq).cast("bigint")))
            .cast("bigint"))


def sku_plant_averages(master: DataFrame) -> DataFrame:
    """Per SKU x plant means + group attributes."""
    return master.groupBy("SkuId", "PlantId").agg(
        mean("SalesOrderQty").alias("AvgDailyDemand"),
        exact_mean("ProductionQty").alias("AvgDailyProduction"),
        exact_mean("FactoryIssueQty").alias("AvgFactoryIssue"),
        exact_mean("UnitCost", 6).alias("AvgUnitCost"),
        first_by("ProductGroup").alias("ProductGroup"),
        first_by("SubGroup").alias("SubGroup"),
    )


def join_reco_schedule(sku_agg: DataFrame, reco: DataFrame | None) -> DataFrame:
    """Attach class, multiplier and pack quantity; without
    recommendations every SKU is medium with multiplier 12, qty = demand x 12."""
    if reco is None:
        return (sku_agg.withColumn("VelocityClass", F.lit(C.DEFAULT_CLASS))
                .withColumn("PackMultiplier", F.lit(12).cast("bigint"))
                .withColumn("RecommendedPackQty", F.col("AvgDailyDemand") * 12))
    r = reco.select("SkuId", "VelocityClass", "PackMultiplier", "RecommendedPackQty")
    return sku_agg.join(r, "SkuId", "left")


def join_plant_stats(df: DataFrame, plant_stats: DataFrame, with_count: bool = False) -> DataFrame:
    """Left join the plant columns the schedule and utilisation use."""
    cols = ["PlantId", "EstCapacity", "CurrentUtilisation", "FactoryIssueRate", "RiskFlag"]
    if with_count:
        cols.append(F.col("SKU_Count").alias("PlantSKUCount"))
    return df.join(plant_stats.select(*cols), "PlantId", "left")


def target_production(demand: F.Column, capacity: F.Column, sku_count: F.Column) -> F.Column:
    """min(demand x 1.05, capacity / max(1, SKUs in plant) x 0.82)."""
    share = capacity / F.greatest(sku_count, F.lit(1))
    return F.least(demand * C.DEMAND_SAFETY, share * C.TARGET_UTILISATION)


def efficiency_score(rate: F.Column) -> F.Column:
    """clip(1 - rate x 10, 0, 1) x 100."""
    return clip(F.lit(1.0) - rate * 10, 0.0, 1.0) * 100


def lead_time_days(batch: F.Column, target: F.Column) -> F.Column:
    """ceil(batch / target), 14 when target <= 0, bounded to [1, 30]."""
    raw = F.when(target > 0, F.ceil(batch / target).cast("double")).otherwise(
        F.lit(float(C.LEAD_TIME_FALLBACK)))
    return clip(raw, float(C.LEAD_TIME_MIN), float(C.LEAD_TIME_MAX)).cast("bigint")


def schedule_priority(demand: F.Column) -> F.Column:
    """Low / Medium / High on (0,100], (100,500], (500,inf)."""
    return bin_right_closed(demand, C.SCHEDULE_LABELS)


def production_schedule(master: DataFrame, plant_stats: DataFrame,
                        reco: DataFrame | None = None) -> DataFrame:
    """The SKU x plant schedule."""
    s = join_reco_schedule(sku_plant_averages(master), reco)
    s = join_plant_stats(s, plant_stats, with_count=True)
    num = ["AvgDailyDemand", "AvgDailyProduction", "AvgFactoryIssue", "AvgUnitCost",
           "PackMultiplier", "RecommendedPackQty", "EstCapacity", "CurrentUtilisation",
           "FactoryIssueRate"]
    s = s.na.fill(0, subset=num)
    s = s.withColumn("OptimalBatchSize", batch_size_eoq("AvgDailyDemand", "AvgUnitCost"))
    s = s.withColumn("CapacitySharePerSKU",
                     F.col("EstCapacity") / F.greatest(F.col("PlantSKUCount"), F.lit(1)))
    s = s.withColumn("TargetDailyProduction",
                     target_production(F.col("AvgDailyDemand"), F.col("EstCapacity"),
                                       F.col("PlantSKUCount")))
    s = s.withColumn("ProductionEfficiencyScore", efficiency_score(F.col("FactoryIssueRate")))
    s = s.withColumn("EstLeadTimeDays",
                     lead_time_days(F.col("OptimalBatchSize"), F.col("TargetDailyProduction")))
    return s.withColumn("SchedulePriority", schedule_priority(F.col("AvgDailyDemand")))


def plant_schedule_rollup(schedule: DataFrame) -> DataFrame:
    """Per plant target sum, SKU count, mean batch, mean efficiency."""
    return schedule.groupBy("PlantId").agg(
        F.sum("TargetDailyProduction").alias("TargetTotalDailyProd"),
        F.countDistinct("SkuId").alias("SKU_Count"),
        mean("OptimalBatchSize").alias("AvgBatchSize"),
        mean("ProductionEfficiencyScore").alias("AvgEfficiencyScore"),
    )


def plant_utilisation(plant_stats: DataFrame, schedule: DataFrame) -> DataFrame:
    """Rollup + target utilisation (<= 0.95) + improvement in points."""
    u = join_plant_stats(plant_schedule_rollup(schedule), plant_stats)
    u = u.withColumn("TargetUtilisation",
                     clip(eps_div("TargetTotalDailyProd", "EstCapacity"), 0.0, C.MAX_UTILISATION))
    return u.withColumn("UtilisationImprovement_Pct",
                        (F.col("TargetUtilisation") - F.col("CurrentUtilisation")) * 100)


def production_summary(plant_stats: DataFrame, schedule: DataFrame,
                       utilisation: DataFrame) -> DataFrame:
    """One-row summary. The list of high-risk plants is unbounded, so it
    is reported as a count here and as a table by ``high_risk_plants``."""
    p = plant_stats.agg(F.count("*").alias("plants_analysed"),
                        F.count_if("RiskFlag").alias("high_risk_plant_count"),
                        round_half_even(F.avg("FactoryIssueRate") * 100, 2)
                        .alias("avg_factory_issue_rate"))
    s = schedule.agg(F.count("*").alias("skus_scheduled"),
                     round_half_even(F.avg("EstLeadTimeDays"), 1).alias("avg_lead_time_days"))
    u = utilisation.agg(round_half_even(F.avg("TargetUtilisation") * 100, 1)
                        .alias("avg_target_utilisation"))
    return p.crossJoin(s).crossJoin(u)


def high_risk_plants(plant_stats: DataFrame) -> DataFrame:
    """The plants above the issue threshold, with their rate."""
    return plant_stats.where("RiskFlag").select("PlantId", "FactoryIssueRate")
