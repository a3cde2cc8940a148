"""Dispatch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow import config as C
from packflow.functions.exprs import bin_right_closed, clip, round_half_even
from packflow.operators.common import exact_mean, first_by, mean
from packflow.operators.ranking import distinct_counts


def sku_storage_delivery(master: DataFrame) -> DataFrame:
    """Per SKU x storage: mean / sum delivery, mean sales, attributes."""
    return master.groupBy("SkuId", "StorageLocationId").agg(
        mean("DeliveryQty").alias("AvgDeliveryQty"),
        F.sum("DeliveryQty").alias("TotalDeliveryQty"),
        mean("SalesOrderQty").alias("AvgSalesOrderQty"),
        first_by("ProductGroup").alias("ProductGroup"),
        first_by("PlantId").alias("PlantId"))


def min_max_scale(df: DataFrame, col: str, name: str, floor: float | None = None) -> DataFrame:
    """Scale to [0, 1] over the whole table (one-row min/max joined
    back); all equal -> 0.5."""
    x = F.col(col) if floor is None else F.greatest(F.col(col), F.lit(floor))
    t = df.withColumn("_x", x)
    mm = t.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    norm = F.when(F.col("_hi") > F.col("_lo"),
                  (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(F.lit(0.5))
    return t.crossJoin(F.broadcast(mm)).withColumn(name, norm).drop("_x", "_lo", "_hi")


def current_lead_time(norm: F.Column) -> F.Column:
    """round(15 - norm x 10, 1)."""
    return round_half_even(F.lit(C.LEAD_TIME_SLOWEST) - norm * C.LEAD_TIME_SPAN, 1)


def optimised_lead_time(lt: F.Column) -> F.Column:
    """round(max(1, lt (1 - (29 - 8 clip((lt - 5) / 10, 0, 1)) / 100)), 1)."""
    n = clip((lt - C.LEAD_TIME_FASTEST) / C.LEAD_TIME_SPAN, 0.0, 1.0)
    red = F.lit(C.REDUCTION_AT_FASTEST) - n * C.REDUCTION_SPAN
    return round_half_even(F.greatest(lt * (1.0 - red / 100.0), F.lit(1.0)), 1)


def lead_time_reduction(lt: F.Column, opt: F.Column) -> F.Column:
    """round((lt - opt) / lt x 100, 1)."""
    return round_half_even((lt - opt) / lt * 100.0, 1)


def dispatch_priority(avg_delivery: F.Column) -> F.Column:
    """Standard / Priority / Express on right-closed bins."""
    return bin_right_closed(avg_delivery, C.DISPATCH_LABELS)


def join_best_route(base: DataFrame, best: DataFrame | None) -> DataFrame:
    """Dispatch base left-join the best route of its location;
    defaults DIRECT / 1 / 1.0."""
    if best is None:
        return base.withColumns({"Destination": F.lit(None).cast("string"), "Path": F.lit("DIRECT"),
                                 "Hops": F.lit(1).cast("bigint"), "PathWeight": F.lit(1.0)})
    j = base.join(best, "StorageLocationId", "left")
    return j.withColumns({"Path": F.coalesce("Path", F.lit("DIRECT")),
                          "Hops": F.coalesce("Hops", F.lit(1).cast("bigint")),
                          "PathWeight": F.coalesce("PathWeight", F.lit(1.0))})


PLAN_COLS = ["SkuId", "StorageLocationId", "AvgDeliveryQty", "TotalDeliveryQty", "AvgSalesOrderQty",
             "ProductGroup", "PlantId", "CurrentLeadTimeDays", "Destination", "Path", "Hops",
             "PathWeight", "OptimisedLeadTimeDays", "LeadTimeReduction_Pct", "DispatchPriority"]


def dispatch_plan(master: DataFrame, best: DataFrame | None) -> DataFrame:
    """The SKU x storage dispatch table."""
    b = min_max_scale(sku_storage_delivery(master), "AvgDeliveryQty", "_norm", floor=1.0)
    b = b.withColumn("CurrentLeadTimeDays", current_lead_time(F.col("_norm"))).drop("_norm")
    p = join_best_route(b, best)
    lt = F.col("CurrentLeadTimeDays")
    p = p.withColumn("OptimisedLeadTimeDays", optimised_lead_time(lt))
    p = p.withColumn("LeadTimeReduction_Pct", lead_time_reduction(lt, F.col("OptimisedLeadTimeDays")))
    p = p.withColumn("DispatchPriority", dispatch_priority(F.col("AvgDeliveryQty")))
    return p.select(*PLAN_COLS)


def dispatch_summary(plan: DataFrame, size: DataFrame) -> DataFrame:
    """Counts, mean lead times, mean reduction, express count."""
    means = plan.agg(
        round_half_even(exact_mean("LeadTimeReduction_Pct", 6), 1).alias("avg_lead_time_reduction_pct"),
        round_half_even(exact_mean("CurrentLeadTimeDays", 6), 1).alias("avg_current_lead_time_days"),
        round_half_even(exact_mean("OptimisedLeadTimeDays", 6), 1).alias("avg_optimised_lead_time_days"),
        F.count_if(F.col("DispatchPriority") == "Express").alias("express_priority_skus"))
    counts = distinct_counts(plan, ["StorageLocationId", "SkuId"], ["storage_locations", "skus_dispatched"])
    return counts.crossJoin(means).crossJoin(size)  # one row each
