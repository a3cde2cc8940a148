"""Queries: production planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from packflow.operators import production as P
from packflow.plans.registry import query
from packflow.plans.sqlfrag import bins, clip, emean, esum, first_by, mean, rhe
from packflow.sources import binding as B

PLANT_TOTALS_OUT = """PlantId:s, TotalProductionQty:d, AvgDailyProduction:d, MaxDailyProduction:x,
TotalFactoryIssueQty:d, AvgFactoryIssueQty:d, TotalSalesOrderQty:x, AvgDailySales:d,
SKU_Count:i, DataDays:i"""

PLANT_TOTALS_SQL = f"""
SELECT "PlantId",
  {esum("ProductionQty")} AS "TotalProductionQty",
  {emean("ProductionQty")} AS "AvgDailyProduction",
  MAX("ProductionQty") AS "MaxDailyProduction",
  {esum("FactoryIssueQty")} AS "TotalFactoryIssueQty",
  {emean("FactoryIssueQty")} AS "AvgFactoryIssueQty",
  SUM("SalesOrderQty") AS "TotalSalesOrderQty",
  {mean("SalesOrderQty")} AS "AvgDailySales",
  COUNT(DISTINCT "SkuId") AS "SKU_Count",
  COUNT(DISTINCT "Date") AS "DataDays"
FROM master GROUP BY "PlantId\""""

PLANT_STATS_SQL = f"""
SELECT *,
  {clip('ABS((CASE WHEN "TotalProductionQty" > 0 THEN "TotalFactoryIssueQty" / ("TotalProductionQty" + 1e-9) ELSE 0.0 END) - 1.0)', 0.0, 1.0)} AS "FactoryIssueRate",
  "MaxDailyProduction" * 1.1 AS "EstCapacity",
  {clip('"AvgDailyProduction" / ("MaxDailyProduction" * 1.1 + 1e-9)', 0.0, 1.0)} AS "CurrentUtilisation"
FROM ({PLANT_TOTALS_SQL}) pt"""

PLANT_STATS_SQL_FULL = f"""
SELECT *, "FactoryIssueRate" > 0.08 AS "RiskFlag" FROM ({PLANT_STATS_SQL}) ps"""

PLANT_STATS_OUT = PLANT_TOTALS_OUT + """, FactoryIssueRate:d, EstCapacity:d,
CurrentUtilisation:d, RiskFlag:b"""


@query("plant_totals", PLANT_TOTALS_OUT, PLANT_TOTALS_SQL)
def q_plant_totals(spark, d):
    """A04 plant_totals."""
    return P.plant_totals(B.master_table(spark, d))


@query("plant_statistics", PLANT_STATS_OUT, PLANT_STATS_SQL_FULL)
def q_plant_statistics(spark, d):
    """R01 plant_statistics."""
    return P.plant_statistics(B.master_table(spark, d))


SKU_PLANT_SQL = f"""
SELECT "SkuId", "PlantId",
  {mean("SalesOrderQty")} AS "AvgDailyDemand",
  {emean("ProductionQty")} AS "AvgDailyProduction",
  {emean("FactoryIssueQty")} AS "AvgFactoryIssue",
  {emean("UnitCost", 6)} AS "AvgUnitCost",
  {first_by("ProductGroup")} AS "ProductGroup",
  {first_by("SubGroup")} AS "SubGroup"
FROM master GROUP BY 1, 2"""

SKU_PLANT_OUT = """SkuId:s, PlantId:s, AvgDailyDemand:d, AvgDailyProduction:d,
AvgFactoryIssue:d, AvgUnitCost:d, ProductGroup:s, SubGroup:s"""


@query("sku_plant_averages", SKU_PLANT_OUT, SKU_PLANT_SQL)
def q_sku_plant_averages(spark, d):
    """A05 sku_plant_averages."""
    return P.sku_plant_averages(B.master_table(spark, d))


def eoq_sql(dem: str, cost: str) -> str:
    h = f"({cost} * 0.22)"
    return (f"(CASE WHEN {dem} <= 0 OR {h} <= 0 OR {dem} IS NULL OR {h} IS NULL THEN 100 "
            f"ELSE GREATEST(50, CAST({rhe(f'SQRT(2.0 * {dem} * 365 * 500.0 / {h})')} AS BIGINT)) END)")


def schedule_sql(reco_sql: str | None) -> str:
    if reco_sql is None:
        reco_cols = """'medium_mover' AS "VelocityClass", 12 AS "PackMultiplier",
          sp."AvgDailyDemand" * 12 AS "RecommendedPackQty\""""
        reco_join = ""
    else:
        reco_cols = """r."VelocityClass", r."PackMultiplier", r."RecommendedPackQty\""""
        reco_join = f"LEFT JOIN ({reco_sql}) r ON sp.\"SkuId\" = r.\"SkuId\""
    return f"""
SELECT *,
  {eoq_sql('"AvgDailyDemand"', '"AvgUnitCost"')} AS "OptimalBatchSize",
  "EstCapacity" / GREATEST("PlantSKUCount", 1) AS "CapacitySharePerSKU",
  LEAST("AvgDailyDemand" * 1.05, "EstCapacity" / GREATEST("PlantSKUCount", 1) * 0.82) AS "TargetDailyProduction",
  {clip('1.0 - "FactoryIssueRate" * 10', 0.0, 1.0)} * 100 AS "ProductionEfficiencyScore",
  CAST({clip('CASE WHEN "TargetDailyProduction" > 0 THEN CAST(CEIL("OptimalBatchSize" / "TargetDailyProduction") AS DOUBLE) ELSE 14.0 END', 1.0, 30.0)} AS BIGINT) AS "EstLeadTimeDays",
  {bins('"AvgDailyDemand"', ("Low", "Medium", "High"))} AS "SchedulePriority"
FROM (
  SELECT sp.*, {reco_cols},
    COALESCE(ps."EstCapacity", 0) AS "EstCapacity",
    COALESCE(ps."CurrentUtilisation", 0) AS "CurrentUtilisation",
    COALESCE(ps."FactoryIssueRate", 0) AS "FactoryIssueRate",
    ps."RiskFlag", ps."SKU_Count" AS "PlantSKUCount"
  FROM ({SKU_PLANT_SQL}) sp {reco_join}
  LEFT JOIN ({PLANT_STATS_SQL_FULL}) ps ON sp."PlantId" = ps."PlantId"
) s"""


SCHEDULE_OUT = SKU_PLANT_OUT + """, VelocityClass:s, PackMultiplier:i, RecommendedPackQty:d,
EstCapacity:d, CurrentUtilisation:d, FactoryIssueRate:d, RiskFlag:b, PlantSKUCount:i,
OptimalBatchSize:i, CapacitySharePerSKU:d, TargetDailyProduction:d,
ProductionEfficiencyScore:d, EstLeadTimeDays:i, SchedulePriority:s"""


def _schedule(spark, d, reco=None):
    m = B.master_table(spark, d)
    return P.production_schedule(m, P.plant_statistics(m), reco)


@query("production_schedule", SCHEDULE_OUT, schedule_sql(None))
def q_production_schedule(spark, d):
    """R07 production_schedule (no recommendations given: the medium branch)."""
    return _schedule(spark, d)


@query("batch_size_eoq", "SkuId:s, PlantId:s, AvgDailyDemand:d, AvgUnitCost:d, OptimalBatchSize:i",
       f"""SELECT "SkuId", "PlantId", "AvgDailyDemand", "AvgUnitCost",
       {eoq_sql('"AvgDailyDemand"', '"AvgUnitCost"')} AS "OptimalBatchSize"
       FROM ({SKU_PLANT_SQL}) t""")
def q_batch_size_eoq(spark, d):
    """R02 batch_size_eoq."""
    a = P.sku_plant_averages(B.master_table(spark, d))
    return a.withColumn("OptimalBatchSize", P.batch_size_eoq("AvgDailyDemand", "AvgUnitCost"))


_SCHED_PART = lambda cols: f"""SELECT "SkuId", "PlantId", {cols} FROM ({schedule_sql(None)}) s"""


@query("target_production", "SkuId:s, PlantId:s, PlantSKUCount:i, TargetDailyProduction:d",
       _SCHED_PART('"PlantSKUCount", "TargetDailyProduction"'))
def q_target_production(spark, d):
    """R03 target_production."""
    return _schedule(spark, d).select("SkuId", "PlantId", "PlantSKUCount", "TargetDailyProduction")


@query("count_in_plant", "SkuId:s, PlantId:s, PlantSKUCount:i",
       _SCHED_PART('"PlantSKUCount"'))
def q_count_in_plant(spark, d):
    """W10 count_in_plant: SKUs per plant attached to each SKU x plant row."""
    return _schedule(spark, d).select("SkuId", "PlantId", "PlantSKUCount")


@query("efficiency_score", "SkuId:s, PlantId:s, ProductionEfficiencyScore:d",
       _SCHED_PART('"ProductionEfficiencyScore"'))
def q_efficiency_score(spark, d):
    """R04 efficiency_score."""
    return _schedule(spark, d).select("SkuId", "PlantId", "ProductionEfficiencyScore")


@query("lead_time_days", "SkuId:s, PlantId:s, EstLeadTimeDays:i",
       _SCHED_PART('"EstLeadTimeDays"'))
def q_lead_time_days(spark, d):
    """R05 lead_time_days."""
    return _schedule(spark, d).select("SkuId", "PlantId", "EstLeadTimeDays")


@query("schedule_priority", "SkuId:s, PlantId:s, SchedulePriority:s",
       _SCHED_PART('"SchedulePriority"'))
def q_schedule_priority(spark, d):
    """R06 schedule_priority."""
    return _schedule(spark, d).select("SkuId", "PlantId", "SchedulePriority")


@query("join_plant_stats", """SkuId:s, PlantId:s, EstCapacity:d, CurrentUtilisation:d,
FactoryIssueRate:d, RiskFlag:b""",
       _SCHED_PART('"EstCapacity", "CurrentUtilisation", "FactoryIssueRate", "RiskFlag"'))
def q_join_plant_stats(spark, d):
    """J10 join_plant_stats."""
    return _schedule(spark, d).select("SkuId", "PlantId", "EstCapacity", "CurrentUtilisation",
                                      "FactoryIssueRate", "RiskFlag")


ROLLUP_SQL = f"""
SELECT "PlantId", SUM("TargetDailyProduction") AS "TargetTotalDailyProd",
  COUNT(DISTINCT "SkuId") AS "SKU_Count", {mean("OptimalBatchSize")} AS "AvgBatchSize",
  {mean("ProductionEfficiencyScore")} AS "AvgEfficiencyScore"
FROM ({schedule_sql(None)}) s GROUP BY 1"""


@query("plant_schedule_rollup", "PlantId:s, TargetTotalDailyProd:d, SKU_Count:i, AvgBatchSize:d, AvgEfficiencyScore:d",
       ROLLUP_SQL)
def q_plant_schedule_rollup(spark, d):
    """A06 plant_schedule_rollup."""
    return P.plant_schedule_rollup(_schedule(spark, d))


UTIL_SQL = f"""
SELECT r.*, ps."EstCapacity", ps."CurrentUtilisation", ps."FactoryIssueRate", ps."RiskFlag",
  {clip('r."TargetTotalDailyProd" / (ps."EstCapacity" + 1e-9)', 0.0, 0.95)} AS "TargetUtilisation",
  ({clip('r."TargetTotalDailyProd" / (ps."EstCapacity" + 1e-9)', 0.0, 0.95)} - ps."CurrentUtilisation") * 100 AS "UtilisationImprovement_Pct"
FROM ({ROLLUP_SQL}) r LEFT JOIN ({PLANT_STATS_SQL_FULL}) ps ON r."PlantId" = ps."PlantId\""""


@query("plant_utilisation", """PlantId:s, TargetTotalDailyProd:d, SKU_Count:i, AvgBatchSize:d,
AvgEfficiencyScore:d, EstCapacity:d, CurrentUtilisation:d, FactoryIssueRate:d, RiskFlag:b,
TargetUtilisation:d, UtilisationImprovement_Pct:d""", UTIL_SQL)
def q_plant_utilisation(spark, d):
    """R08 plant_utilisation."""
    m = B.master_table(spark, d)
    ps = P.plant_statistics(m)
    return P.plant_utilisation(ps, P.production_schedule(m, ps))


@query("production_summary", """plants_analysed:i, high_risk_plant_count:i,
avg_factory_issue_rate:x, skus_scheduled:i, avg_lead_time_days:x, avg_target_utilisation:x""",
       f"""SELECT p.*, s.*, u.* FROM
  (SELECT COUNT(*) AS plants_analysed, COUNT(*) FILTER (WHERE "RiskFlag") AS high_risk_plant_count,
          {rhe('AVG("FactoryIssueRate") * 100', 2)} AS avg_factory_issue_rate
   FROM ({PLANT_STATS_SQL_FULL}) x) p,
  (SELECT COUNT(*) AS skus_scheduled, {rhe('AVG("EstLeadTimeDays")', 1)} AS avg_lead_time_days
   FROM ({schedule_sql(None)}) y) s,
  (SELECT {rhe('AVG("TargetUtilisation") * 100', 1)} AS avg_target_utilisation FROM ({UTIL_SQL}) z) u""")
def q_production_summary(spark, d):
    """R09 production_summary."""
    m = B.master_table(spark, d)
    ps = P.plant_statistics(m)
    sch = P.production_schedule(m, ps)
    return P.production_summary(ps, sch, P.plant_utilisation(ps, sch))


@query("high_risk_plants", "PlantId:s, FactoryIssueRate:d",
       f"""SELECT "PlantId", "FactoryIssueRate" FROM ({PLANT_STATS_SQL_FULL}) p WHERE "RiskFlag\"""")
def q_high_risk_plants(spark, d):
    """The plants above the issue threshold as a table."""
    return P.high_risk_plants(P.plant_statistics(B.master_table(spark, d)))
