"""KPI tables (U01, E03, E04): one-row summaries stacked into metric rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow import config as C
from packflow.functions.exprs import round_half_even


def stack_metric_rows(one_row: DataFrame, metrics: Sequence[str] | None = None,
                      name: str = "Metric", value: str = "Value") -> DataFrame:
    """A one-row summary -> (Metric, Value) rows (values as double)."""
    metrics = list(metrics or one_row.columns)
    t = one_row.select(*[F.col(m).cast("double").alias(m) for m in metrics])
    return t.unpivot([], metrics, name, value)


def pipeline_summary(forecast_metrics: DataFrame | None, n_forecast_skus: DataFrame,
                     pack_summary: DataFrame, fin_summary: DataFrame, prod_summary: DataFrame,
                     disp_summary: DataFrame) -> DataFrame:
    """The 16 headline KPIs as (Metric, Value) rows."""
    if forecast_metrics is None:
        fm = n_forecast_skus.select(F.lit(None).cast("double").alias("demand_mape_pct"),
                                    F.lit(None).cast("double").alias("demand_rmse"))
    else:
        fm = forecast_metrics.select(round_half_even("MAPE", 2).alias("demand_mape_pct"),
                                     round_half_even("RMSE", 2).alias("demand_rmse"))
    one = (fm.crossJoin(n_forecast_skus.select(F.col("n").alias("skus_forecasted")))
           .crossJoin(pack_summary.select("fast_movers", "medium_movers", "slow_movers",
                                          "avg_inventory_reduction_pct"))
           .crossJoin(fin_summary.select(F.col("PBT_Uplift_Pct").alias("pbt_uplift_pct"),
                                         F.col("Revenue_Uplift_Pct").alias("revenue_uplift_pct"),
                                         F.col("Inventory_Reduction_Pct").alias("inventory_reduction_pct"),
                                         F.col("Debtor_Cycle_Improvement_Pct").alias("debtor_cycle_improvement_pct")))
           .crossJoin(prod_summary.select("plants_analysed",
                                          F.col("avg_target_utilisation").alias("avg_plant_utilisation_pct"),
                                          "avg_lead_time_days"))
           .crossJoin(disp_summary.select("avg_lead_time_reduction_pct", "storage_locations")))
    return stack_metric_rows(one)


def benchmark_comparison(fin_summary: DataFrame, disp_summary: DataFrame) -> DataFrame:
    """Achieved vs target range with status, for the reported (clamped)
    value and the raw one."""
    one = fin_summary.crossJoin(disp_summary.select("avg_lead_time_reduction_pct"))
    src = [("PBT Uplift %", "PBT_Uplift_Pct", "PBT_Uplift_Pct_Raw"),
           ("Revenue Uplift %", "Revenue_Uplift_Pct", "Revenue_Uplift_Pct_Raw"),
           ("Inventory Reduction %", "Inventory_Reduction_Pct", "Inventory_Reduction_Pct_Raw"),
           ("Lead Time Reduction %", "avg_lead_time_reduction_pct", "avg_lead_time_reduction_pct"),
           ("Debtor Improvement %", "Debtor_Cycle_Improvement_Pct", "Debtor_Cycle_Improvement_Pct_Raw")]
    rng = {m: (lo, hi) for m, lo, hi in C.KPI_RANGES}

    def status(v, lo, hi):
        return (F.when((v >= lo) & (v <= hi), "On Target").when(v > hi, "Above Target")
                .otherwise("Below Target"))

    rows = []
    for metric, col, raw in src:
        lo, hi = rng[metric]
        v, r = F.col(col).cast("double"), F.col(raw).cast("double")
        rows.append(F.struct(F.lit(metric).alias("Metric"), v.alias("Achieved"),
                             F.lit(lo).alias("Target_Min"), F.lit(hi).alias("Target_Max"),
                             status(v, lo, hi).alias("Status"), r.alias("Achieved_Raw"),
                             status(r, lo, hi).alias("Status_Raw")))
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
