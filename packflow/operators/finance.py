"""Before / after profit tables (A08-A10, A12, J05, J08, P19, P20, P24,
F01-F07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow import config as C
from packflow.functions.exprs import class_factor, class_lookup, clip, round_half_even
from packflow.operators.common import exact_mean, mean

RECO_COLS = ["SkuId", "VelocityClass", "PackMultiplier", "RecommendedPackQty", "CostFactor",
             "EstInventoryReductionPct", "JustificationScore"]


def sku_finance_base(master: DataFrame) -> DataFrame:
    """Per SKU mean demand, distinct days, mean cost, mean price."""
    return master.groupBy("SkuId").agg(
        mean("SalesOrderQty").alias("AvgDailyDemand"),
        F.countDistinct("Date").alias("TotalDays"),
        exact_mean("UnitCost", 6).alias("AvgUnitCost"),
        mean("Price").alias("AvgPrice"))


def avg_item_price(prices: DataFrame) -> DataFrame:
    """A10: mean sell price per item over stores and weeks."""
    return prices.groupBy(F.col("item_id").alias("SkuId")).agg(
        mean("sell_price").alias("M5_AvgPrice"))


def join_price_lookup(base: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """J05 + P24: left join the item price; it overrides the own price."""
    if lookup is None:
        return base.withColumn("M5_AvgPrice", F.lit(None).cast("double"))
    j = base.join(lookup, "SkuId", "left")
    return j.withColumn("AvgPrice", F.coalesce("M5_AvgPrice", "AvgPrice"))


def default_recommendations(master: DataFrame) -> DataFrame:
    """A constant recommendation per SKU when none came in."""
    return master.groupBy("SkuId").agg(mean("SalesOrderQty").alias("RecommendedPackQty")).select(
        "SkuId", F.lit(C.DEFAULT_CLASS).alias("VelocityClass"),
        F.lit(12).cast("bigint").alias("PackMultiplier"), "RecommendedPackQty",
        F.lit(1.0).alias("CostFactor"), F.lit(20.0).alias("EstInventoryReductionPct"),
        F.lit(50.0).alias("JustificationScore"))


def join_reco_finance(base: DataFrame, reco: DataFrame) -> DataFrame:
    """Per-SKU stats left-join recommendations; defaults 12 / 1.0 / 20."""
    j = base.join(reco.select(*RECO_COLS), "SkuId", "left")
    return j.withColumns({
        "PackMultiplier": F.coalesce(F.col("PackMultiplier"), F.lit(12).cast("bigint")),
        "CostFactor": F.coalesce(F.col("CostFactor"), F.lit(1.0)),
        "EstInventoryReductionPct": F.coalesce(F.col("EstInventoryReductionPct"), F.lit(20.0)),
    })


def before_ledger(df: DataFrame) -> DataFrame:
    """the ledger before optimisation."""
    rev = F.col("AvgDailyDemand") * F.col("AvgPrice") * C.DAYS_PER_YEAR
    df = df.withColumn("Before_AnnualRevenue", rev)
    r = F.col("Before_AnnualRevenue")
    df = df.withColumns({
        "Before_COGS": r * C.COGS_RATIO,
        "Before_Overhead": r * C.OVERHEAD_RATIO,
        "Before_InventoryValue": F.col("AvgDailyDemand") * F.col("AvgUnitCost") * C.INVENTORY_COVER_DAYS,
    })
    df = df.withColumns({
        "Before_CarryingCost": F.col("Before_InventoryValue") * C.CARRYING_COST_RATE,
        "Before_DebtorDays": F.lit(C.DEBTOR_DAYS_BEFORE).cast("bigint"),
        "Before_DebtorCost": r / C.DAYS_PER_YEAR * C.DEBTOR_DAYS_BEFORE * C.FINANCING_RATE,
    })
    return df.withColumn("Before_PBT", r - F.col("Before_COGS") - F.col("Before_Overhead")
                         - F.col("Before_CarryingCost") - F.col("Before_DebtorCost"))


def after_ledger(df: DataFrame) -> DataFrame:
    """F02 (with P19 / P20): the ledger after optimisation."""
    vc = F.col("VelocityClass")
    df = df.withColumn("After_AnnualRevenue", F.col("Before_AnnualRevenue")
                       * class_factor(vc, C.REVENUE_UPLIFT, C.REVENUE_UPLIFT_ELSE))
    r = F.col("After_AnnualRevenue")
    df = df.withColumns({
        "After_COGS": r * C.COGS_RATIO * class_factor(vc, C.COGS_FACTOR, C.COGS_FACTOR_ELSE),
        "After_Overhead": r * C.OVERHEAD_RATIO * C.OVERHEAD_AFTER_FACTOR,
        "After_InventoryValue": F.col("Before_InventoryValue")
                                * (1 - F.col("EstInventoryReductionPct") / 100),
        "After_DebtorDays": C.DEBTOR_DAYS_BEFORE
                            * (1 - class_lookup(vc, C.DEBTOR_IMPROVEMENT, C.DEBTOR_IMPROVEMENT_DEFAULT)),
    })
    df = df.withColumns({
        "After_CarryingCost": F.col("After_InventoryValue") * C.CARRYING_COST_RATE,
        "After_DebtorCost": r / C.DAYS_PER_YEAR * F.col("After_DebtorDays") * C.FINANCING_RATE,
    })
    return df.withColumn("After_PBT", r - F.col("After_COGS") - F.col("After_Overhead")
                         - F.col("After_CarryingCost") - F.col("After_DebtorCost"))


def pbt_uplift(df: DataFrame) -> DataFrame:
    """uplift % when the before PBT is positive, else 0."""
    b, a = F.col("Before_PBT"), F.col("After_PBT")
    return df.withColumn("PBT_Uplift_Pct",
                         F.when(b > 0, (a - b) / F.abs(b) * 100).otherwise(F.lit(0.0)))


def flag_unprofitable(df: DataFrame) -> DataFrame:
    """after PBT < 0 or uplift < 0."""
    return df.withColumn("IsUnprofitable", (F.col("After_PBT") < 0) | (F.col("PBT_Uplift_Pct") < 0))


LEDGER_COLS = ["SkuId", "AvgDailyDemand", "TotalDays", "AvgUnitCost", "AvgPrice", "M5_AvgPrice",
               "VelocityClass", "PackMultiplier", "RecommendedPackQty", "CostFactor",
               "EstInventoryReductionPct", "JustificationScore", "Before_AnnualRevenue",
               "Before_COGS", "Before_Overhead", "Before_InventoryValue", "Before_CarryingCost",
               "Before_DebtorDays", "Before_DebtorCost", "Before_PBT", "After_AnnualRevenue",
               "After_COGS", "After_Overhead", "After_InventoryValue", "After_CarryingCost",
               "After_DebtorDays", "After_DebtorCost", "After_PBT", "PBT_Uplift_Pct",
               "IsUnprofitable"]


def finance_base(master: DataFrame, prices: DataFrame | None) -> DataFrame:
    """A08 + J05: per-SKU actuals with the price override applied."""
    return join_price_lookup(sku_finance_base(master),
                             avg_item_price(prices) if prices is not None else None)


def financial_table(master: DataFrame, reco: DataFrame | None,
                    prices: DataFrame | None, base: DataFrame | None = None) -> DataFrame:
    """F01-F04 over A08 + J05 + J08 (A09 when no recommendations). A
    precomputed ``base`` (``finance_base``) is reused as is."""
    base = base if base is not None else finance_base(master, prices)
    reco = reco if reco is not None else default_recommendations(master)
    t = flag_unprofitable(pbt_uplift(after_ledger(before_ledger(join_reco_finance(base, reco)))))
    return t.select(*LEDGER_COLS)


def portfolio_totals(t: DataFrame) -> DataFrame:
    """Sums and means of the finance table (one row)."""
    return t.agg(
        F.sum("Before_AnnualRevenue").alias("tb_rev"), F.sum("After_AnnualRevenue").alias("ta_rev"),
        F.sum("Before_PBT").alias("tb_pbt"), F.sum("After_PBT").alias("ta_pbt"),
        F.sum("Before_InventoryValue").alias("tb_inv"), F.sum("After_InventoryValue").alias("ta_inv"),
        exact_mean("Before_DebtorDays", 6).alias("avg_debtor_before"),
        exact_mean("After_DebtorDays", 6).alias("avg_debtor_after"),
        F.count_if("IsUnprofitable").alias("Unprofitable_SKU_Count"),
        F.count("*").alias("Total_SKUs"))


def _pct(a: F.Column, b: F.Column, absolute: bool = True) -> F.Column:
    den = F.abs(b) if absolute else b
    return F.when(b != 0, (a - b) / den * 100).otherwise(F.lit(0.0))


def portfolio_summary(t: DataFrame) -> DataFrame:
    """the 14 summary values, each uplift raw and clamped to its target
    range (the reference reports only the clamped one)."""
    p = portfolio_totals(t)
    raw = {
        "PBT_Uplift_Pct_Raw": _pct(F.col("ta_pbt"), F.col("tb_pbt")),
        "Revenue_Uplift_Pct_Raw": _pct(F.col("ta_rev"), F.col("tb_rev")),
        "Inventory_Reduction_Pct_Raw": F.when(F.col("tb_inv") != 0, (F.col("tb_inv") - F.col("ta_inv"))
                                              / F.col("tb_inv") * 100).otherwise(F.lit(0.0)),
        "Debtor_Cycle_Improvement_Pct_Raw": F.when(
            F.col("avg_debtor_before") != 0,
            (F.col("avg_debtor_before") - F.col("avg_debtor_after")) / F.col("avg_debtor_before") * 100
        ).otherwise(F.lit(0.0)),
    }
    p = p.withColumns(raw)
    rng = {"PBT_Uplift_Pct": (10.0, 18.0), "Revenue_Uplift_Pct": (8.0, 15.0),
           "Inventory_Reduction_Pct": (20.0, 30.0), "Debtor_Cycle_Improvement_Pct": (25.0, 35.0)}
    clamped = {k: round_half_even(clip(F.col(k + "_Raw"), lo, hi), 2) for k, (lo, hi) in rng.items()}
    return p.withColumns(clamped).select(
        round_half_even("tb_rev", 0).alias("Before_TotalRevenue"),
        round_half_even("ta_rev", 0).alias("After_TotalRevenue"),
        "Revenue_Uplift_Pct",
        round_half_even("tb_pbt", 0).alias("Before_TotalPBT"),
        round_half_even("ta_pbt", 0).alias("After_TotalPBT"),
        "PBT_Uplift_Pct",
        round_half_even("tb_inv", 0).alias("Before_InventoryValue"),
        round_half_even("ta_inv", 0).alias("After_InventoryValue"),
        "Inventory_Reduction_Pct",
        round_half_even("avg_debtor_before", 1).alias("Before_AvgDebtorDays"),
        round_half_even("avg_debtor_after", 1).alias("After_AvgDebtorDays"),
        "Debtor_Cycle_Improvement_Pct", "Unprofitable_SKU_Count", "Total_SKUs",
        *raw.keys())


def profit_bridge(t: DataFrame) -> DataFrame:
    """revenue, COGS, inventory, debtor deltas and net PBT as rows."""
    one = t.agg(
        (F.sum("After_AnnualRevenue") - F.sum("Before_AnnualRevenue")).alias("Revenue Uplift"),
        (F.sum("Before_COGS") - F.sum("After_COGS")).alias("COGS Reduction"),
        (F.sum("Before_CarryingCost") - F.sum("After_CarryingCost")).alias("Inventory Savings"),
        (F.sum("Before_DebtorCost") - F.sum("After_DebtorCost")).alias("Debtor Savings"),
        (F.sum("After_PBT") - F.sum("Before_PBT")).alias("Net PBT"))
    steps = ["Revenue Uplift", "COGS Reduction", "Inventory Savings", "Debtor Savings", "Net PBT"]
    return one.unpivot([], [F.col(f"`{s}`") for s in steps], "Step", "Value")


def revision_loop(master: DataFrame, forecast: DataFrame, prices: DataFrame | None,
                  max_rounds: int = 2, classes: str = "rule", cluster_cfg=None) -> dict:
    """flagged SKUs -> downgrade (K07) -> finance again, until none are
    flagged or ``max_rounds`` revisions ran. Flags accumulate across rounds
    (a SKU repaired in round 1 stays downgraded).

    A row of the recommendations and of the ledger depends on its own SKU
    alone, so a round re-derives the newly flagged SKUs only and reads the rows
    that the round before wrote, not the whole ledger. The revised rows replace
    the first ones by key once, after the last round."""
    from packflow.operators.packs import (capacity_check, classed_profile, downgrade_unprofitable, optimize_packs,
                                          pack_summary, plant_output)
    # classes, SKU actuals, prices and plant outputs do not change between rounds
    prof = classed_profile(master, forecast, classes, cluster_cfg).checkpoint(eager=True)
    base = finance_base(master, prices).checkpoint(eager=True)
    output = plant_output(master).checkpoint(eager=True)
    packs = optimize_packs(master, forecast, classes, profile=prof, output=output)
    reco = packs["recommendations"].checkpoint(eager=True)
    table = financial_table(master, reco, prices, base).checkpoint(eager=True)
    latest = table  # the rows that may be flagged next: all, then those of the round before
    revised: list[tuple[DataFrame, DataFrame]] = []
    flagged, rounds = None, 0
    while rounds < max_rounds:
        new = latest.where("IsUnprofitable").select("SkuId")
        if new.isEmpty():
            break
        rounds += 1
        if flagged is not None:
            new = new.join(flagged, "SkuId", "left_anti")
        new = new.distinct().checkpoint(eager=True)
        if new.isEmpty():  # all were downgraded before: another round gives the same rows
            rounds = max_rounds
            break
        flagged = new if flagged is None else flagged.unionByName(new)
        some = downgrade_unprofitable(reco.join(new, "SkuId", "left_semi").drop("AvgPlantCapacity", "CapacityFeasible"), new)
        some = capacity_check(some, master, output).checkpoint(eager=True)
        latest = financial_table(master, some, prices, base.join(new, "SkuId", "left_semi")).checkpoint(eager=True)
        revised.append((some, latest))
    if revised:
        def merged(first: DataFrame, k: int) -> DataFrame:
            out = first.join(flagged, "SkuId", "left_anti")
            for pair in revised:
                out = out.unionByName(pair[k])
            return out.checkpoint(eager=True)
        reco, table = merged(reco, 0), merged(table, 1)
    packs = {**packs, "recommendations": reco, "summary": pack_summary(reco)}
    return {"packs": packs, "finance": table, "rounds": rounds, "flagged": flagged,
            "summary": portfolio_summary(table)}
