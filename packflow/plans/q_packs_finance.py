"""Queries: velocity, packs, finance (A01-A03, A08-A10, A12-A13, J05-J08,
J16, K01-K08, W12, P19-P20, P24, F01-F07).

Exact checks use the deterministic chain: naive (last-7-row mean) forecast
and the rule velocity class; the MLlib forecast and clustering feed the same
operators in production (``packflow.plans.pipeline``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from packflow.operators import features as FE
from packflow.operators import finance as FI
from packflow.operators import packs as PK
from packflow.plans.q_features import FEAT
from packflow.plans.registry import query
from packflow.plans.sqlfrag import clip, emean, first_by, rhe
from packflow.sources import binding as B

FOUR_THIRDS = repr(4.0 / 3.0) + "e0" if "e" not in repr(4.0 / 3.0) else repr(4.0 / 3.0)
TWO_THIRDS = repr(2.0 / 3.0) + "e0" if "e" not in repr(2.0 / 3.0) else repr(2.0 / 3.0)

PF = {
    "daily2": """SELECT "SkuId", "Date", SUM("SalesOrderQty") AS qty, MIN("ProductGroup") AS pg,
        MIN("SubGroup") AS sg, MIN("PlantId") AS pl FROM master GROUP BY 1, 2""",
    "ranked_desc": """SELECT *, ROW_NUMBER() OVER (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn,
        COUNT(*) OVER (PARTITION BY "SkuId") AS n FROM daily2""",
    "tail7": """SELECT "SkuId", SUM(qty) / COUNT(qty) AS tail_mean,
        COALESCE(STDDEV_SAMP(qty), 0.0e0) AS tail_std FROM ranked_desc WHERE rn <= 7 GROUP BY 1""",
    "lastrow": """SELECT "SkuId", "Date", qty, pg, sg, pl FROM ranked_desc WHERE rn = 1""",
    "nth14": """SELECT "SkuId", qty AS lag_14_last FROM ranked_desc WHERE rn = LEAST(14, n)""",
    "end_date": """SELECT MAX("Date") AS e FROM daily2""",
    "fcast": """SELECT t."SkuId", CAST(e.e + CAST(r.s AS INTEGER) AS DATE) AS "Date",
        GREATEST(t.tail_mean, 0.0e0) AS "ForecastQty",
        GREATEST(t.tail_mean - 1.2816e0 * t.tail_std, 0.0e0) AS "CI_Lower",
        GREATEST(t.tail_mean + 1.2816e0 * t.tail_std, 0.0e0) AS "CI_Upper",
        l.pg AS "ProductGroup", l.sg AS "SubGroup", l.pl AS "PlantId"
        FROM tail7 t JOIN lastrow l ON t."SkuId" = l."SkuId" CROSS JOIN end_date e
        CROSS JOIN range(1, 31) r(s)""",
    "hist": """SELECT "SkuId", SUM("SalesOrderQty") / COUNT("SalesOrderQty") AS hist_mean,
        STDDEV_SAMP("SalesOrderQty") AS hist_std, hist_std / (hist_mean + 1e-9) AS hist_cv,
        SUM("SalesOrderQty") AS hist_total, COUNT(DISTINCT "Date") AS n_days FROM master GROUP BY 1""",
    "fc_agg": """SELECT "SkuId", SUM("ForecastQty") / COUNT("ForecastQty") AS fcast_mean,
        SUM("ForecastQty") AS fcast_total FROM fcast GROUP BY 1""",
    "attrs": f"""SELECT "SkuId", {first_by("PlantId")} AS "PlantId",
        {first_by("StorageLocationId")} AS "StorageLocationId",
        {first_by("ProductGroup")} AS "ProductGroup", {first_by("SubGroup")} AS "SubGroup"
        FROM master GROUP BY 1""",
    "profile": """SELECT COALESCE(h."SkuId", f."SkuId") AS "SkuId",
        COALESCE(h.hist_mean, 0) AS hist_mean, COALESCE(h.hist_std, 0) AS hist_std,
        COALESCE(h.hist_cv, 0) AS hist_cv, COALESCE(h.hist_total, 0) AS hist_total,
        COALESCE(h.n_days, 0) AS n_days, COALESCE(f.fcast_mean, 0) AS fcast_mean,
        COALESCE(f.fcast_total, 0) AS fcast_total,
        a."PlantId", a."StorageLocationId", a."ProductGroup", a."SubGroup"
        FROM hist h FULL OUTER JOIN fc_agg f ON h."SkuId" = f."SkuId"
        LEFT JOIN attrs a ON COALESCE(h."SkuId", f."SkuId") = a."SkuId\"""",
    "classed": f"""SELECT p.*, CASE WHEN p.hist_mean >= gg.g * {FOUR_THIRDS} THEN 'fast_mover'
        WHEN p.hist_mean < gg.g * {TWO_THIRDS} THEN 'slow_mover' ELSE 'medium_mover' END AS velocity_class
        FROM profile p CROSS JOIN (SELECT SUM(hist_mean) / COUNT(hist_mean) AS g FROM profile) gg""",
    "pack_cfg": """SELECT * FROM (VALUES
        ('fast_mover', 'Bulk Logistics Case', 'High-volume bulk case pack for continuous replenishment', 24, 0.85e0),
        ('medium_mover', 'Standard Consumer Pack', 'Standard shelf-ready pack for regular distribution', 12, 1.0e0),
        ('slow_mover', 'Promotional Multipack', 'Promotional bundle to accelerate slow-moving inventory', 6, 1.10e0)
        ) v(cls, label, descr, mult, cf)""",
    "reco": f"""SELECT c."SkuId", c."ProductGroup", c."SubGroup", c."PlantId", c."StorageLocationId",
        c.velocity_class AS "VelocityClass", cfg.label AS "PackConfig", cfg.descr AS "PackDescription",
        CAST(cfg.mult AS BIGINT) AS "PackMultiplier",
        GREATEST(1, CAST(ROUND_EVEN(c.fcast_mean * cfg.mult / 30, 0) AS BIGINT)) AS "RecommendedPackQty",
        {rhe('LEAST(100.0e0, c.hist_mean / (mx.m + 1e-9) * 60) + GREATEST(0.0e0, 40 * (1 - LEAST(1.0e0, c.hist_cv)))', 1)} AS "JustificationScore",
        {rhe('c.hist_mean', 1)} AS "HistMeanDailyDemand", {rhe('c.fcast_mean', 1)} AS "ForecastMeanDailyDemand",
        {rhe('c.hist_cv', 3)} AS "DemandCV",
        CASE c.velocity_class WHEN 'fast_mover' THEN 30.0e0 WHEN 'medium_mover' THEN 23.0e0
             WHEN 'slow_mover' THEN 15.0e0 ELSE 20.0e0 END AS "EstInventoryReductionPct",
        cfg.cf AS "CostFactor"
        FROM classed c CROSS JOIN (SELECT MAX(hist_mean) AS m FROM classed) mx
        LEFT JOIN pack_cfg cfg ON COALESCE(CASE WHEN c.velocity_class IN ('fast_mover', 'medium_mover', 'slow_mover')
             THEN c.velocity_class END, 'medium_mover') = cfg.cls""",
    "plant_cap": f"""SELECT "PlantId", {emean("ProductionQty")} AS cap FROM master GROUP BY 1""",
    "global_cap": f"""SELECT {emean("ProductionQty")} AS g FROM master""",
    "reco_cap": """SELECT r.*, COALESCE(pc.cap, gc.g) AS "AvgPlantCapacity",
        r."RecommendedPackQty" <= COALESCE(pc.cap, gc.g) AS "CapacityFeasible"
        FROM reco r LEFT JOIN plant_cap pc ON r."PlantId" = pc."PlantId" CROSS JOIN global_cap gc""",
    "item_price": """SELECT item_id AS "SkuId", SUM(sell_price) / COUNT(sell_price) AS "M5_AvgPrice"
        FROM sell_prices GROUP BY 1""",
    "fbase": f"""SELECT "SkuId", SUM("SalesOrderQty") / COUNT("SalesOrderQty") AS "AvgDailyDemand",
        COUNT(DISTINCT "Date") AS "TotalDays", {emean("UnitCost", 6)} AS "AvgUnitCost",
        SUM("Price") / COUNT("Price") AS "AvgPrice" FROM master GROUP BY 1""",
    "fin": """SELECT b."SkuId", b."AvgDailyDemand", b."TotalDays", b."AvgUnitCost",
        COALESCE(ip."M5_AvgPrice", b."AvgPrice") AS "AvgPrice", ip."M5_AvgPrice", r."VelocityClass",
        COALESCE(r."PackMultiplier", 12) AS "PackMultiplier", r."RecommendedPackQty",
        COALESCE(r."CostFactor", 1.0e0) AS "CostFactor",
        COALESCE(r."EstInventoryReductionPct", 20.0e0) AS "EstInventoryReductionPct", r."JustificationScore"
        FROM fbase b LEFT JOIN item_price ip ON b."SkuId" = ip."SkuId"
        LEFT JOIN reco_cap r ON b."SkuId" = r."SkuId\"""",
    "ledger": """SELECT *,
        "AvgDailyDemand" * "AvgPrice" * 365 AS "Before_AnnualRevenue",
        "Before_AnnualRevenue" * 0.6e0 AS "Before_COGS",
        "Before_AnnualRevenue" * 0.15e0 AS "Before_Overhead",
        "AvgDailyDemand" * "AvgUnitCost" * 30 AS "Before_InventoryValue",
        "Before_InventoryValue" * 0.22e0 AS "Before_CarryingCost",
        45 AS "Before_DebtorDays",
        "Before_AnnualRevenue" / 365 * 45 * 0.06e0 AS "Before_DebtorCost",
        "Before_AnnualRevenue" - "Before_COGS" - "Before_Overhead" - "Before_CarryingCost" - "Before_DebtorCost" AS "Before_PBT",
        "Before_AnnualRevenue" * (CASE WHEN "VelocityClass" = 'fast_mover' THEN 1.12e0
             WHEN "VelocityClass" = 'medium_mover' THEN 1.08e0 ELSE 1.05e0 END) AS "After_AnnualRevenue",
        "After_AnnualRevenue" * 0.6e0 * (CASE WHEN "VelocityClass" = 'fast_mover' THEN 0.96e0
             WHEN "VelocityClass" = 'medium_mover' THEN 0.97e0 ELSE 0.98e0 END) AS "After_COGS",
        "After_AnnualRevenue" * 0.15e0 * 0.97e0 AS "After_Overhead",
        "Before_InventoryValue" * (1 - "EstInventoryReductionPct" / 100) AS "After_InventoryValue",
        "After_InventoryValue" * 0.22e0 AS "After_CarryingCost",
        45 * (1 - (CASE WHEN "VelocityClass" = 'fast_mover' THEN 0.30e0 WHEN "VelocityClass" = 'medium_mover'
             THEN 0.27e0 WHEN "VelocityClass" = 'slow_mover' THEN 0.25e0 ELSE 0.27e0 END)) AS "After_DebtorDays",
        "After_AnnualRevenue" / 365 * "After_DebtorDays" * 0.06e0 AS "After_DebtorCost",
        "After_AnnualRevenue" - "After_COGS" - "After_Overhead" - "After_CarryingCost" - "After_DebtorCost" AS "After_PBT",
        CASE WHEN "Before_PBT" > 0 THEN ("After_PBT" - "Before_PBT") / ABS("Before_PBT") * 100 ELSE 0.0e0 END AS "PBT_Uplift_Pct",
        "After_PBT" < 0 OR "PBT_Uplift_Pct" < 0 AS "IsUnprofitable"
        FROM fin""",
}


def _chain(spark, d):
    """Spark side of the same chain: master, naive forecast, rule packs."""
    m = B.master_table(spark, d)
    # written once: the forecast reads the series for its last row, its tail and its end
    daily = B.materialise(spark, "daily", d, lambda: FE.daily_series(m))
    return m, FE.naive_forecast(daily)


def _packs(spark, d):
    m, fc = _chain(spark, d)
    return m, fc, PK.optimize_packs(m, fc, "rule")


def _ledger(spark, d):
    m, fc, pk = _packs(spark, d)
    return FI.financial_table(m, pk["recommendations"], B.sell_prices(spark, d))


FCAST_OUT = """SkuId:s, Date:t, ForecastQty:d, CI_Lower:d, CI_Upper:d, ProductGroup:s, SubGroup:s,
PlantId:s"""


@query("naive_forecast", FCAST_OUT, "SELECT * FROM fcast", PF)
def q_naive_forecast(spark, d):
    """Baseline forecast (M07's deterministic method): last-7-row mean."""
    return _chain(spark, d)[1]


HIST_OUT = "SkuId:s, hist_mean:d, hist_std:d, hist_cv:d, hist_total:x, n_days:i"


@query("velocity_history", HIST_OUT, "SELECT * FROM hist", PF)
def q_velocity_history(spark, d):
    """A01 velocity_history."""
    return PK.velocity_history(B.master_table(spark, d))


@query("velocity_forecast", "SkuId:s, fcast_mean:d, fcast_total:d", "SELECT * FROM fc_agg", PF)
def q_velocity_forecast(spark, d):
    """A02 velocity_forecast."""
    return PK.velocity_forecast(_chain(spark, d)[1])


@query("sku_first_attributes", "SkuId:s, PlantId:s, StorageLocationId:s, ProductGroup:s, SubGroup:s",
       "SELECT * FROM attrs", PF)
def q_sku_first_attributes(spark, d):
    """A03 sku_first_attributes."""
    return FE.sku_first_attributes(B.master_table(spark, d))


PROFILE_OUT = HIST_OUT + """, fcast_mean:d, fcast_total:d, PlantId:s, StorageLocationId:s,
ProductGroup:s, SubGroup:s"""


@query("velocity_profile", PROFILE_OUT, "SELECT * FROM profile", PF)
def q_velocity_profile(spark, d):
    """K01 velocity_profile."""
    m, fc = _chain(spark, d)
    return PK.velocity_profile(m, fc)


@query("join_hist_forecast", "SkuId:s, hist_mean:d, fcast_mean:d, fcast_total:d, PlantId:s",
       "SELECT \"SkuId\", hist_mean, fcast_mean, fcast_total, \"PlantId\" FROM profile", PF)
def q_join_hist_forecast(spark, d):
    """J06 join_hist_forecast (full outer, then left attributes)."""
    m, fc = _chain(spark, d)
    return PK.velocity_profile(m, fc).select("SkuId", "hist_mean", "fcast_mean", "fcast_total",
                                             "PlantId")


@query("share_of_max", "SkuId:s, hist_mean:d, share:d",
       """SELECT "SkuId", hist_mean, hist_mean / (m + 1e-9) AS share FROM profile
          CROSS JOIN (SELECT MAX(hist_mean) AS m FROM profile) mx""", PF)
def q_share_of_max(spark, d):
    """W12 share_of_max."""
    m, fc = _chain(spark, d)
    p = PK.velocity_profile(m, fc)
    return PK.share_of_max(p, "hist_mean", "share").select("SkuId", "hist_mean", "share")


RECO_OUT = """SkuId:s, ProductGroup:s, SubGroup:s, PlantId:s, StorageLocationId:s, VelocityClass:s,
PackConfig:s, PackDescription:s, PackMultiplier:i, RecommendedPackQty:i, JustificationScore:x,
HistMeanDailyDemand:x, ForecastMeanDailyDemand:x, DemandCV:x, EstInventoryReductionPct:x,
CostFactor:x"""


@query("pack_recommendations", RECO_OUT, "SELECT * FROM reco", PF)
def q_pack_recommendations(spark, d):
    """K05 pack_recommendations (rule velocity class)."""
    m, fc = _chain(spark, d)
    return PK.pack_recommendations(PK.rule_classes(PK.velocity_profile(m, fc)))


@query("join_pack_config", "SkuId:s, VelocityClass:s, PackConfig:s, PackDescription:s, PackMultiplier:i, CostFactor:x",
       """SELECT "SkuId", "VelocityClass", "PackConfig", "PackDescription", "PackMultiplier", "CostFactor" FROM reco""", PF)
def q_join_pack_config(spark, d):
    """J16 join_pack_config."""
    return q_pack_recommendations(spark, d).select("SkuId", "VelocityClass", "PackConfig",
                                                   "PackDescription", "PackMultiplier", "CostFactor")


@query("justification_score", "SkuId:s, JustificationScore:x",
       """SELECT "SkuId", "JustificationScore" FROM reco""", PF)
def q_justification_score(spark, d):
    """K02 justification_score."""
    return q_pack_recommendations(spark, d).select("SkuId", "JustificationScore")


@query("recommended_pack_qty", "SkuId:s, PackMultiplier:i, RecommendedPackQty:i",
       """SELECT "SkuId", "PackMultiplier", "RecommendedPackQty" FROM reco""", PF)
def q_recommended_pack_qty(spark, d):
    """K03 recommended_pack_qty."""
    return q_pack_recommendations(spark, d).select("SkuId", "PackMultiplier", "RecommendedPackQty")


@query("inventory_reduction", "SkuId:s, VelocityClass:s, EstInventoryReductionPct:x",
       """SELECT "SkuId", "VelocityClass", "EstInventoryReductionPct" FROM reco""", PF)
def q_inventory_reduction(spark, d):
    """K04 inventory_reduction."""
    return q_pack_recommendations(spark, d).select("SkuId", "VelocityClass",
                                                   "EstInventoryReductionPct")


@query("plant_mean_capacity", "PlantId:s, AvgPlantCapacity:d, GlobalMeanCapacity:d",
       """SELECT pc."PlantId", pc.cap AS "AvgPlantCapacity", gc.g AS "GlobalMeanCapacity"
          FROM plant_cap pc CROSS JOIN global_cap gc""", PF)
def q_plant_mean_capacity(spark, d):
    """A13 plant_mean_capacity."""
    per, glob = PK.plant_mean_capacity(B.master_table(spark, d))
    return per.crossJoin(glob).withColumnRenamed("_global_cap", "GlobalMeanCapacity")


CAP_OUT = RECO_OUT + ", AvgPlantCapacity:d, CapacityFeasible:b"


@query("capacity_check", CAP_OUT, "SELECT * FROM reco_cap", PF)
def q_capacity_check(spark, d):
    """K06 capacity_check."""
    return _packs(spark, d)[2]["recommendations"]


@query("join_plant_capacity", "SkuId:s, PlantId:s, AvgPlantCapacity:d",
       """SELECT "SkuId", "PlantId", "AvgPlantCapacity" FROM reco_cap""", PF)
def q_join_plant_capacity(spark, d):
    """J07 join_plant_capacity (gaps -> global mean)."""
    return _packs(spark, d)[2]["recommendations"].select("SkuId", "PlantId", "AvgPlantCapacity")


@query("downgrade_unprofitable", CAP_OUT,
       """SELECT r."SkuId", r."ProductGroup", r."SubGroup", r."PlantId", r."StorageLocationId",
          CASE WHEN f."SkuId" IS NOT NULL THEN 'slow_mover' ELSE r."VelocityClass" END AS "VelocityClass",
          CASE WHEN f."SkuId" IS NOT NULL THEN 'Promotional Multipack' ELSE r."PackConfig" END AS "PackConfig",
          r."PackDescription",
          CASE WHEN f."SkuId" IS NOT NULL THEN 6 ELSE r."PackMultiplier" END AS "PackMultiplier",
          r."RecommendedPackQty",
          CASE WHEN f."SkuId" IS NOT NULL THEN r."JustificationScore" * 0.7e0 ELSE r."JustificationScore" END AS "JustificationScore",
          r."HistMeanDailyDemand", r."ForecastMeanDailyDemand", r."DemandCV", r."EstInventoryReductionPct",
          r."CostFactor", r."AvgPlantCapacity", r."CapacityFeasible"
          FROM reco_cap r LEFT JOIN (SELECT DISTINCT "SkuId" FROM ledger WHERE "IsUnprofitable") f
          ON r."SkuId" = f."SkuId\"""", PF)
def q_downgrade_unprofitable(spark, d):
    """K07 downgrade_unprofitable: the SKUs flagged by the finance step."""
    m, fc, pk = _packs(spark, d)
    t = FI.financial_table(m, pk["recommendations"], B.sell_prices(spark, d))
    return PK.downgrade_unprofitable(pk["recommendations"], t.where("IsUnprofitable"))


@query("pack_summary", """fast_movers:i, medium_movers:i, slow_movers:i, avg_justification_score:x,
avg_inventory_reduction_pct:x, capacity_infeasible_count:i""",
       f"""SELECT COUNT(*) FILTER (WHERE "VelocityClass" = 'fast_mover') AS fast_movers,
          COUNT(*) FILTER (WHERE "VelocityClass" = 'medium_mover') AS medium_movers,
          COUNT(*) FILTER (WHERE "VelocityClass" = 'slow_mover') AS slow_movers,
          {rhe(emean('JustificationScore', 6), 1)} AS avg_justification_score,
          {rhe(emean('EstInventoryReductionPct', 6), 1)} AS avg_inventory_reduction_pct,
          COUNT(*) FILTER (WHERE NOT "CapacityFeasible") AS capacity_infeasible_count FROM reco_cap""", PF)
def q_pack_summary(spark, d):
    """K08 pack_summary."""
    return _packs(spark, d)[2]["summary"]


# ---- finance --------------------------------------------------------------------

@query("sku_finance_base", "SkuId:s, AvgDailyDemand:d, TotalDays:i, AvgUnitCost:d, AvgPrice:d",
       "SELECT * FROM fbase", PF)
def q_sku_finance_base(spark, d):
    """A08 sku_finance_base."""
    return FI.sku_finance_base(B.master_table(spark, d))


@query("avg_item_price", "SkuId:s, M5_AvgPrice:d", "SELECT * FROM item_price", PF)
def q_avg_item_price(spark, d):
    """A10 avg_item_price."""
    return FI.avg_item_price(B.sell_prices(spark, d))


@query("default_recommendations", """SkuId:s, VelocityClass:s, PackMultiplier:i, RecommendedPackQty:d,
CostFactor:x, EstInventoryReductionPct:x, JustificationScore:x""",
       """SELECT "SkuId", 'medium_mover' AS "VelocityClass", 12 AS "PackMultiplier",
          SUM("SalesOrderQty") / COUNT("SalesOrderQty") AS "RecommendedPackQty", 1.0e0 AS "CostFactor",
          20.0e0 AS "EstInventoryReductionPct", 50.0e0 AS "JustificationScore" FROM master GROUP BY 1""")
def q_default_recommendations(spark, d):
    """A09 default_recommendations."""
    return FI.default_recommendations(B.master_table(spark, d))


@query("join_price_lookup", "SkuId:s, AvgPrice:d, M5_AvgPrice:d",
       'SELECT "SkuId", "AvgPrice", "M5_AvgPrice" FROM fin', PF)
def q_join_price_lookup(spark, d):
    """J05 join_price_lookup."""
    return _ledger(spark, d).select("SkuId", "AvgPrice", "M5_AvgPrice")


@query("price_override", "SkuId:s, OwnPrice:d, M5_AvgPrice:d, AvgPrice:d",
       """SELECT b."SkuId", b."AvgPrice" AS "OwnPrice", ip."M5_AvgPrice",
          COALESCE(ip."M5_AvgPrice", b."AvgPrice") AS "AvgPrice"
          FROM fbase b LEFT JOIN item_price ip ON b."SkuId" = ip."SkuId\"""", PF)
def q_price_override(spark, d):
    """P24 price_override: external average price if present, else own."""
    base = FI.sku_finance_base(B.master_table(spark, d)).withColumnRenamed("AvgPrice", "OwnPrice")
    j = base.join(FI.avg_item_price(B.sell_prices(spark, d)), "SkuId", "left")
    return j.withColumn("AvgPrice", F.coalesce("M5_AvgPrice", "OwnPrice"))


@query("join_reco_finance", """SkuId:s, VelocityClass:s, PackMultiplier:i, RecommendedPackQty:i,
CostFactor:x, EstInventoryReductionPct:x, JustificationScore:x""",
       """SELECT "SkuId", "VelocityClass", "PackMultiplier", "RecommendedPackQty", "CostFactor",
          "EstInventoryReductionPct", "JustificationScore" FROM fin""", PF)
def q_join_reco_finance(spark, d):
    """J08 join_reco_finance."""
    return _ledger(spark, d).select(*FI.RECO_COLS)


LEDGER_OUT = """SkuId:s, AvgDailyDemand:d, TotalDays:i, AvgUnitCost:d, AvgPrice:d, M5_AvgPrice:d,
VelocityClass:s, PackMultiplier:i, RecommendedPackQty:i, CostFactor:x, EstInventoryReductionPct:x,
JustificationScore:x, Before_AnnualRevenue:d, Before_COGS:d, Before_Overhead:d,
Before_InventoryValue:d, Before_CarryingCost:d, Before_DebtorDays:i, Before_DebtorCost:d,
Before_PBT:d, After_AnnualRevenue:d, After_COGS:d, After_Overhead:d, After_InventoryValue:d,
After_CarryingCost:d, After_DebtorDays:d, After_DebtorCost:d, After_PBT:d, PBT_Uplift_Pct:d,
IsUnprofitable:b"""


@query("financial_table", LEDGER_OUT, "SELECT * FROM ledger", PF)
def q_financial_table(spark, d):
    """F01-F04 combined: the per-SKU before / after ledger."""
    return _ledger(spark, d)


_BEFORE = ("Before_AnnualRevenue", "Before_COGS", "Before_Overhead", "Before_InventoryValue",
           "Before_CarryingCost", "Before_DebtorDays", "Before_DebtorCost", "Before_PBT")
_AFTER = ("After_AnnualRevenue", "After_COGS", "After_Overhead", "After_InventoryValue",
          "After_CarryingCost", "After_DebtorDays", "After_DebtorCost", "After_PBT")


def _ledger_part(name, cols, doc):
    kinds = {"Before_DebtorDays": "i"}
    out = "SkuId:s, " + ", ".join(f"{c}:{kinds.get(c, 'd')}" for c in cols)
    sql = "SELECT \"SkuId\", " + ", ".join(f'"{c}"' for c in cols) + " FROM ledger"

    @query(name, out, sql, PF)
    def fn(spark, d):
        return _ledger(spark, d).select("SkuId", *cols)
    fn.__doc__ = doc
    return fn


_ledger_part("before_ledger", _BEFORE, "F01 before_ledger.")
_ledger_part("after_ledger", _AFTER, "F02 after_ledger.")
_ledger_part("pbt_uplift", ("Before_PBT", "After_PBT", "PBT_Uplift_Pct"), "F03 pbt_uplift.")


@query("flag_unprofitable", "SkuId:s, After_PBT:d, PBT_Uplift_Pct:d, IsUnprofitable:b",
       """SELECT "SkuId", "After_PBT", "PBT_Uplift_Pct", "IsUnprofitable" FROM ledger""", PF)
def q_flag_unprofitable(spark, d):
    """F04 flag_unprofitable."""
    return _ledger(spark, d).select("SkuId", "After_PBT", "PBT_Uplift_Pct", "IsUnprofitable")


@query("class_factor", "SkuId:s, VelocityClass:s, RevenueUplift:x, CogsFactor:x",
       """SELECT "SkuId", "VelocityClass",
          CASE WHEN "VelocityClass" = 'fast_mover' THEN 1.12e0 WHEN "VelocityClass" = 'medium_mover' THEN 1.08e0 ELSE 1.05e0 END AS "RevenueUplift",
          CASE WHEN "VelocityClass" = 'fast_mover' THEN 0.96e0 WHEN "VelocityClass" = 'medium_mover' THEN 0.97e0 ELSE 0.98e0 END AS "CogsFactor"
          FROM fin""", PF)
def q_class_factor(spark, d):
    """P19 class_factor (null class -> last branch)."""
    from packflow import config as C
    from packflow.functions.exprs import class_factor
    t = _ledger(spark, d)
    vc = F.col("VelocityClass")
    return t.select("SkuId", "VelocityClass",
                    class_factor(vc, C.REVENUE_UPLIFT, C.REVENUE_UPLIFT_ELSE).alias("RevenueUplift"),
                    class_factor(vc, C.COGS_FACTOR, C.COGS_FACTOR_ELSE).alias("CogsFactor"))


@query("class_lookup_default", "SkuId:s, VelocityClass:s, DebtorImprovement:x, InventoryReductionPct:x",
       """SELECT "SkuId", "VelocityClass",
          CASE "VelocityClass" WHEN 'fast_mover' THEN 0.30e0 WHEN 'medium_mover' THEN 0.27e0 WHEN 'slow_mover' THEN 0.25e0 ELSE 0.27e0 END AS "DebtorImprovement",
          CASE "VelocityClass" WHEN 'fast_mover' THEN 30.0e0 WHEN 'medium_mover' THEN 23.0e0 WHEN 'slow_mover' THEN 15.0e0 ELSE 20.0e0 END AS "InventoryReductionPct"
          FROM fin""", PF)
def q_class_lookup_default(spark, d):
    """P20 class_lookup_default (missing -> default)."""
    from packflow import config as C
    from packflow.functions.exprs import class_lookup
    t = _ledger(spark, d)
    vc = F.col("VelocityClass")
    return t.select("SkuId", "VelocityClass",
                    class_lookup(vc, C.DEBTOR_IMPROVEMENT, C.DEBTOR_IMPROVEMENT_DEFAULT).alias("DebtorImprovement"),
                    class_lookup(vc, C.INVENTORY_REDUCTION_PCT, C.INVENTORY_REDUCTION_DEFAULT).alias("InventoryReductionPct"))


TOTALS_SQL = f"""SELECT SUM("Before_AnnualRevenue") AS tb_rev, SUM("After_AnnualRevenue") AS ta_rev,
    SUM("Before_PBT") AS tb_pbt, SUM("After_PBT") AS ta_pbt, SUM("Before_InventoryValue") AS tb_inv,
    SUM("After_InventoryValue") AS ta_inv, {emean("Before_DebtorDays", 6)} AS avg_debtor_before,
    {emean("After_DebtorDays", 6)} AS avg_debtor_after,
    COUNT(*) FILTER (WHERE "IsUnprofitable") AS "Unprofitable_SKU_Count", COUNT(*) AS "Total_SKUs"
    FROM ledger"""


@query("portfolio_totals", """tb_rev:d, ta_rev:d, tb_pbt:d, ta_pbt:d, tb_inv:d, ta_inv:d,
avg_debtor_before:d, avg_debtor_after:d, Unprofitable_SKU_Count:i, Total_SKUs:i""", TOTALS_SQL, PF)
def q_portfolio_totals(spark, d):
    """A12 portfolio_totals."""
    return FI.portfolio_totals(_ledger(spark, d))


def _pct_sql(a, b, absolute=True):
    den = f"ABS({b})" if absolute else b
    return f"(CASE WHEN {b} <> 0 THEN ({a} - {b}) / {den} * 100 ELSE 0.0e0 END)"


@query("portfolio_summary", """Before_TotalRevenue:d, After_TotalRevenue:d, Revenue_Uplift_Pct:x,
Before_TotalPBT:d, After_TotalPBT:d, PBT_Uplift_Pct:x, Before_InventoryValue:d, After_InventoryValue:d,
Inventory_Reduction_Pct:x, Before_AvgDebtorDays:x, After_AvgDebtorDays:x,
Debtor_Cycle_Improvement_Pct:x, Unprofitable_SKU_Count:i, Total_SKUs:i, PBT_Uplift_Pct_Raw:d,
Revenue_Uplift_Pct_Raw:d, Inventory_Reduction_Pct_Raw:d, Debtor_Cycle_Improvement_Pct_Raw:d""",
       f"""SELECT {rhe('tb_rev', 0)} AS "Before_TotalRevenue", {rhe('ta_rev', 0)} AS "After_TotalRevenue",
          {rhe(clip('"Revenue_Uplift_Pct_Raw"', '8.0e0', '15.0e0'), 2)} AS "Revenue_Uplift_Pct",
          {rhe('tb_pbt', 0)} AS "Before_TotalPBT", {rhe('ta_pbt', 0)} AS "After_TotalPBT",
          {rhe(clip('"PBT_Uplift_Pct_Raw"', '10.0e0', '18.0e0'), 2)} AS "PBT_Uplift_Pct",
          {rhe('tb_inv', 0)} AS "Before_InventoryValue", {rhe('ta_inv', 0)} AS "After_InventoryValue",
          {rhe(clip('"Inventory_Reduction_Pct_Raw"', '20.0e0', '30.0e0'), 2)} AS "Inventory_Reduction_Pct",
          {rhe('avg_debtor_before', 1)} AS "Before_AvgDebtorDays", {rhe('avg_debtor_after', 1)} AS "After_AvgDebtorDays",
          {rhe(clip('"Debtor_Cycle_Improvement_Pct_Raw"', '25.0e0', '35.0e0'), 2)} AS "Debtor_Cycle_Improvement_Pct",
          "Unprofitable_SKU_Count", "Total_SKUs", "PBT_Uplift_Pct_Raw", "Revenue_Uplift_Pct_Raw",
          "Inventory_Reduction_Pct_Raw", "Debtor_Cycle_Improvement_Pct_Raw"
          FROM (SELECT *, {_pct_sql('ta_pbt', 'tb_pbt')} AS "PBT_Uplift_Pct_Raw",
                {_pct_sql('ta_rev', 'tb_rev')} AS "Revenue_Uplift_Pct_Raw",
                (CASE WHEN tb_inv <> 0 THEN (tb_inv - ta_inv) / tb_inv * 100 ELSE 0.0e0 END) AS "Inventory_Reduction_Pct_Raw",
                (CASE WHEN avg_debtor_before <> 0 THEN (avg_debtor_before - avg_debtor_after) / avg_debtor_before * 100 ELSE 0.0e0 END) AS "Debtor_Cycle_Improvement_Pct_Raw"
                FROM ({TOTALS_SQL}) t) s""", PF)
def q_portfolio_summary(spark, d):
    """F05 portfolio_summary: raw and clamped uplifts."""
    return FI.portfolio_summary(_ledger(spark, d))


@query("profit_bridge", "Step:s, Value:d",
       """SELECT * FROM (SELECT SUM("After_AnnualRevenue") - SUM("Before_AnnualRevenue") AS "Revenue Uplift",
          SUM("Before_COGS") - SUM("After_COGS") AS "COGS Reduction",
          SUM("Before_CarryingCost") - SUM("After_CarryingCost") AS "Inventory Savings",
          SUM("Before_DebtorCost") - SUM("After_DebtorCost") AS "Debtor Savings",
          SUM("After_PBT") - SUM("Before_PBT") AS "Net PBT" FROM ledger) t
          UNPIVOT ("Value" FOR "Step" IN ("Revenue Uplift", "COGS Reduction", "Inventory Savings",
          "Debtor Savings", "Net PBT"))""", PF)
def q_profit_bridge(spark, d):
    """F06 profit_bridge."""
    return FI.profit_bridge(_ledger(spark, d))


def _downgrade_sql(flags: str) -> str:
    return f"""SELECT r."SkuId", r."ProductGroup", r."SubGroup", r."PlantId", r."StorageLocationId",
        CASE WHEN f."SkuId" IS NOT NULL THEN 'slow_mover' ELSE r."VelocityClass" END AS "VelocityClass",
        CASE WHEN f."SkuId" IS NOT NULL THEN 'Promotional Multipack' ELSE r."PackConfig" END AS "PackConfig",
        r."PackDescription",
        CASE WHEN f."SkuId" IS NOT NULL THEN 6 ELSE r."PackMultiplier" END AS "PackMultiplier",
        r."RecommendedPackQty",
        CASE WHEN f."SkuId" IS NOT NULL THEN r."JustificationScore" * 0.7e0 ELSE r."JustificationScore" END AS "JustificationScore",
        r."HistMeanDailyDemand", r."ForecastMeanDailyDemand", r."DemandCV", r."EstInventoryReductionPct",
        r."CostFactor", r."AvgPlantCapacity", r."CapacityFeasible"
        FROM reco_cap r LEFT JOIN ({flags}) f ON r."SkuId" = f."SkuId\""""


# Two revision rounds with flags accumulated across rounds. Running both
# rounds unconditionally is equivalent to the early stop: with no new flags a
# round reproduces the previous ledger.
REV = dict(PF)
REV["flags1"] = """SELECT DISTINCT "SkuId" FROM ledger WHERE "IsUnprofitable\""""
REV["reco_r1"] = _downgrade_sql("SELECT * FROM flags1")
REV["fin_r1"] = PF["fin"].replace("reco_cap r", "reco_r1 r")
REV["ledger_r1"] = PF["ledger"].replace("FROM fin", "FROM fin_r1")
REV["flags2"] = """SELECT "SkuId" FROM flags1 UNION SELECT "SkuId" FROM ledger_r1 WHERE "IsUnprofitable\""""
REV["reco_r2"] = _downgrade_sql("SELECT * FROM flags2")
REV["fin_r2"] = PF["fin"].replace("reco_cap r", "reco_r2 r")
REV["ledger_r2"] = PF["ledger"].replace("FROM fin", "FROM fin_r2")


@query("revision_loop", LEDGER_OUT, "SELECT * FROM ledger_r2", REV)
def q_revision_loop(spark, d):
    """F07 revision_loop: up to 2 revision rounds with accumulated flags."""
    m, fc = _chain(spark, d)
    return FI.revision_loop(m, fc, B.sell_prices(spark, d), max_rounds=2)["finance"]


@query("labelled_series", "SkuId:s, Date:t, Series:s, Qty:d, CI_Lower:d, CI_Upper:d",
       """SELECT "SkuId", "Date", 'Actual' AS "Series", CAST("SalesOrderQty" AS DOUBLE) AS "Qty",
          CAST(NULL AS DOUBLE) AS "CI_Lower", CAST(NULL AS DOUBLE) AS "CI_Upper" FROM (SELECT *, ROW_NUMBER() OVER
          (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn FROM dseries) t WHERE rn <= 90
          UNION ALL SELECT "SkuId", "Date", 'Forecast', "ForecastQty", "CI_Lower", "CI_Upper" FROM fcast""", {**FEAT, **PF})
def q_labelled_series(spark, d):
    """Recent actuals and the forecast as one labelled series."""
    daily = FE.daily_series(B.master_table(spark, d))
    return FE.labelled_series(daily, FE.naive_forecast(daily))
