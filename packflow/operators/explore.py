"""Exploration aggregates, top-k reports and labels (A14-A38, T01-T11, W04,
J12-J13, P13-P16, P26-P29).

Pivots name their values explicitly (no extra job to discover them);
quantiles are exact and distributed (``exact_quantiles``); correlations are
built from sums with guarded division (a constant column gives null, not an
ANSI error); top-k reports always break ties on the key, so they compile to
``TakeOrderedAndProject`` (a per-task top-k, then a k-row merge).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.functions.exprs import any_flag, day_name, month_abbr
from packflow.operators.common import exact_mean, exact_sum, mean
from packflow.operators.features import centred_mean_7
from packflow.operators.master import UNIFIED
from packflow.operators.ranking import distinct_counts, exact_quantiles

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def daily_sales_total(master: DataFrame) -> DataFrame:
    """A14."""
    return master.groupBy("Date").agg(F.sum("SalesOrderQty").alias("SalesOrderQty"))


def daily_gap(master: DataFrame) -> DataFrame:
    """A15 + W04: production - delivery per day and its centred 7-day mean."""
    g = master.groupBy("Date").agg(exact_sum("ProductionQty").alias("ProductionQty"),
                                   F.sum("DeliveryQty").alias("DeliveryQty"))
    g = g.withColumn("Gap", F.col("ProductionQty") - F.col("DeliveryQty"))
    return centred_mean_7(g, "Gap", name="Gap_7d_centred")


def gap_statistics(gap: DataFrame) -> DataFrame:
    """Mean, max, share of negative days (%)."""
    return gap.agg(mean("Gap").alias("mean_gap"), F.max("Gap").alias("max_gap"),
                   (F.avg((F.col("Gap") < 0).cast("double")) * 100).alias("negative_gap_pct"))


def volatility_group_month(master: DataFrame) -> DataFrame:
    """Sample std of sales per group x month, months as columns, 0 when
    empty."""
    p = (master.withColumn("m", F.month("Date")).groupBy("ProductGroup")
         .pivot("m", list(range(1, 13))).agg(F.stddev_samp("SalesOrderQty")))
    return p.select("ProductGroup", *[F.coalesce(F.col(str(i + 1)), F.lit(0.0)).alias(MONTHS[i])
                                      for i in range(12)])


def sales_group_weekday(master: DataFrame) -> DataFrame:
    """Mean sales per group x weekday, weekdays as columns, 0 when empty."""
    p = (master.withColumn("dow", day_name("Date")).groupBy("ProductGroup")
         .pivot("dow", DAYS).agg(mean("SalesOrderQty")))
    return p.select("ProductGroup", *[F.coalesce(F.col(d), F.lit(0.0)).alias(d) for d in DAYS])


def plant_issue_rate(master: DataFrame) -> DataFrame:
    """Issue / production x 100 per plant."""
    p = master.groupBy("PlantId").agg(exact_sum("ProductionQty").alias("TotalProduction"),
                                      exact_sum("FactoryIssueQty").alias("TotalFactoryIssue"),
                                      F.countDistinct("SkuId").alias("SkuCount"))
    return p.withColumn("IssueRate", F.col("TotalFactoryIssue") / (F.col("TotalProduction") + 1e-9) * 100)


def sku_cv(master: DataFrame) -> DataFrame:
    """Per SKU mean, std and CV of the daily demand."""
    c = master.groupBy("SkuId").agg(mean("SalesOrderQty").alias("mean"),
                                    F.stddev_samp("SalesOrderQty").alias("std"))
    return c.withColumn("cv", F.col("std") / (F.col("mean") + 1e-9))


def demand_cv(master: DataFrame) -> DataFrame:
    """Per SKU mean, std, CV, with the median CV of all SKUs."""
    c = sku_cv(master)
    med = exact_quantiles(c, "cv", [0.5]).select(F.col("q").alias("median_cv"))
    return c.join(F.broadcast(med), F.lit(True), "left")  # one row; none when every CV is null


def with_any_flag(master: DataFrame, cal: DataFrame) -> DataFrame:
    """Master rows with the calendar's any-state flag and event indicator
    (P14), both 0 when the day is missing."""
    c = cal.select(F.col("date").alias("Date"),
                   any_flag([x for x in cal.columns if x.startswith("snap_")]).alias("any_snap"),
                   F.col("event_name_1").isNotNull().cast("int").alias("has_event"))
    # a day that a file repeats counts once, with any of its flags
    c = c.groupBy("Date").agg(F.max("any_snap").alias("any_snap"), F.max("has_event").alias("has_event"))
    return master.join(c, "Date", "left").na.fill(0, subset=["any_snap", "has_event"])


def promo_impact(flagged: DataFrame) -> DataFrame:
    """Mean, median, std of sales by flag, labelled."""
    s = flagged.groupBy("any_snap").agg(mean("SalesOrderQty").alias("mean"),
                                        F.stddev_samp("SalesOrderQty").alias("std"))
    med = exact_quantiles(flagged, "SalesOrderQty", [0.5], "any_snap").select(
        "any_snap", F.col("q").alias("median"))
    return s.join(med, "any_snap", "left").withColumn("label", label_codes(F.col("any_snap")))


def label_codes(code: F.Column) -> F.Column:
    """0 -> 'No SNAP', 1 -> 'SNAP Active', otherwise the code as text."""
    return (F.when(code == 0, "No SNAP").when(code == 1, "SNAP Active")
            .otherwise(code.cast("string")))


def promo_coverage(flagged: DataFrame) -> DataFrame:
    """Share of rows with the flag (%)."""
    return flagged.agg((F.avg("any_snap") * 100).alias("snap_coverage_pct"))


def flag_days_by_state(cal: DataFrame) -> DataFrame:
    """Days with each state flag set, as (state, days) rows."""
    cols = [c for c in cal.columns if c.startswith("snap_")]
    one = cal.agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])
    return one.unpivot([], cols, "state", "days")


def flag_share_by_month(cal: DataFrame) -> DataFrame:
    """Mean any-state flag per month."""
    c = cal.withColumn("any_snap", any_flag([x for x in cal.columns if x.startswith("snap_")]))
    return c.groupBy("month").agg(F.avg("any_snap").alias("any_snap"))


def event_type_counts(cal: DataFrame) -> DataFrame:
    """Counts of the non-null event types."""
    return (cal.where(F.col("event_type_1").isNotNull()).groupBy(F.col("event_type_1").alias("EventType"))
            .agg(F.count("*").alias("Count")))


def item_category(item: F.Column) -> F.Column:
    """The item id's prefix before the first '_'."""
    return F.substring_index(item, "_", 1)


def price_describe_by_category(prices: DataFrame) -> DataFrame:
    """Count, mean, std, min, quartiles, max of sell price per category."""
    p = prices.withColumn("Category", item_category(F.col("item_id")))
    s = p.groupBy("Category").agg(F.count("sell_price").alias("count"), mean("sell_price").alias("mean"),
                                  F.stddev_samp("sell_price").alias("std"),
                                  F.min("sell_price").alias("min"), F.max("sell_price").alias("max"))
    q = exact_quantiles(p, "sell_price", [0.25, 0.5, 0.75], "Category")
    qp = q.groupBy("Category").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qp = qp.select("Category", F.col("`0.25`").alias("p25"), F.col("`0.5`").alias("p50"),
                   F.col("`0.75`").alias("p75"))
    return s.join(qp, "Category", "left")  # a category without a price keeps its row


def box_statistics(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers (the most extreme values inside
    the fences) per group."""
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], group)
    qp = (q.groupBy(group).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
          .select(group, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"),
                  F.col("`0.75`").alias("q3")))
    qp = qp.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn(
        "hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    j = df.select(group, F.col(value).cast("double").alias("_v")).join(qp, group, "left")
    inside = (F.col("_v") >= F.col("lo_fence")) & (F.col("_v") <= F.col("hi_fence"))
    w = j.groupBy(group).agg(F.min(F.when(inside, F.col("_v"))).alias("lower_whisker"),
                             F.max(F.when(inside, F.col("_v"))).alias("upper_whisker"),
                             F.count_if(~inside).alias("n_outliers"))
    return w.join(qp, group, "left").select(group, "q1", "median", "q3", "lower_whisker", "upper_whisker",
                                            "n_outliers")


def describe_panel(master: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Describe over numeric columns, one row per column (exact
    quantiles)."""
    long = master.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                      F.col(c).cast("double").alias("v"))
                                             for c in cols])).alias("_s")).select("_s.*")
    s = long.groupBy("column").agg(F.count("v").alias("count"), mean("v").alias("mean"),
                                   F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
                                   F.max("v").alias("max"))
    q = exact_quantiles(long, "v", [0.25, 0.5, 0.75], "column")
    qp = (q.groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
          .select("column", F.col("`0.25`").alias("p25"), F.col("`0.5`").alias("p50"),
                  F.col("`0.75`").alias("p75")))
    return s.join(qp, "column", "left")  # an all-null column keeps its row


def histogram(df: DataFrame, value: str, bins: int, name: str,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width bins over [min, max] (or the given range after
    clipping); the top edge folds into the last bin; density = n / (N w)."""
    v = F.col(value).cast("double")
    if lo is not None:
        v = F.least(F.greatest(v, F.lit(lo)), F.lit(hi))
    t = df.select(v.alias("_v")).where(F.col("_v").isNotNull())
    mm = t.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_N"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))
    b = F.when(F.col("_hi") > F.col("_lo"), b).otherwise(F.lit(0))
    c = (t.crossJoin(F.broadcast(mm)).withColumn("bin", b.cast("bigint"))
         .groupBy("bin", "_lo", "_hi", "_N").agg(F.count("*").alias("count")))
    w = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / bins).otherwise(F.lit(1.0))
    return c.select(F.lit(name).alias("hist"), "bin",
                    (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                    "count", (F.col("count") / (F.col("_N") * w)).alias("density"))


def correlation_matrix(df: DataFrame, cols: Sequence[str], lower_only: bool = True) -> DataFrame:
    """Pearson r for every pair, from central moments, which keep their
    digits for columns with a large mean (constant column -> null)."""
    x = {c: F.col(c).cast("double") for c in cols}
    aggs = [F.stddev_pop(x[c]).alias(f"d_{c}") for c in cols]
    pairs = list(combinations(cols, 2))
    aggs += [F.covar_pop(x[a], x[b]).alias(f"p_{a}__{b}") for a, b in pairs]
    one = df.agg(*aggs)
    rows = []
    for a, b in pairs:
        r = F.try_divide(F.col(f"p_{a}__{b}"), F.col(f"d_{a}") * F.col(f"d_{b}"))
        rows.append(F.struct(F.lit(b).alias("row"), F.lit(a).alias("col"), r.alias("r")))
    return one.select(F.explode(F.array(*rows)).alias("_c")).select("_c.*")


def target_correlation(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson r of each column with the target, one aggregate a column."""
    y = F.col(target).cast("double")
    one = df.agg(F.stddev_pop(y).alias("_y"),
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"d_{c}") for c in cols],
                 *[F.covar_pop(F.col(c).cast("double"), y).alias(f"p_{c}") for c in cols])
    rows = [F.struct(F.lit(target).alias("row"), F.lit(c).alias("col"),
                     F.try_divide(F.col(f"p_{c}"), F.col(f"d_{c}") * F.col("_y")).alias("r")) for c in cols]
    return one.select(F.explode(F.array(*rows)).alias("_c")).select("_c.*")


def weekday_seasonality(features: DataFrame, value: str = "SalesOrderQty") -> DataFrame:
    """Mean of the value by day of week (0 Monday), with its short name."""
    s = features.groupBy("day_of_week").agg((F.sum(value) / F.count("*")).alias(value))
    names = F.array(*[F.lit(x[:3]) for x in DAYS])
    return s.withColumn("DayName", F.element_at(names, F.col("day_of_week").cast("int") + 1))


def value_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(what, value, count) of a column of each frame, ``what`` its name."""
    out = None
    for what, df in frames.items():
        t = df.groupBy(F.col(what).alias("value")).agg(F.count("*").alias("count")).select(
            F.lit(what).alias("what"), F.col("value").cast("string").alias("value"), "count")
        out = t if out is None else out.unionByName(t)
    return out


def most_frequent(df: DataFrame, key: str) -> DataFrame:
    """The value with the most rows and their number (ties: the least)."""
    return top_k(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count")), 1,
                 [F.desc("count"), F.asc(key)])


def dataset_overview(master: DataFrame) -> DataFrame:
    """Rows, date bounds and the distinct SKUs, plants, locations, groups."""
    one = master.agg(F.count("*").alias("rows"), F.min("Date").alias("date_min"), F.max("Date").alias("date_max"))
    return one.crossJoin(distinct_counts(master, ["SkuId", "PlantId", "StorageLocationId", "ProductGroup"],
                                         ["skus", "plants", "locations", "groups"]))  # one row each


def schema_report(master: DataFrame, expected: Sequence[str] = UNIFIED) -> DataFrame:
    """Per column type, null count, least and greatest value as text (numbers
    with two places, anything else its first 10 characters) and whether it is
    ok, missing or extra; one aggregate over all columns."""
    types = {f.name: f.dataType.simpleString() for f in master.schema}
    cols = [c for c in expected if c in types]

    def text(e: F.Column, c: str) -> F.Column:
        if types[c] in ("double", "int", "bigint", "float"):
            return F.format_string("%.2f", e.cast("double"))
        return F.substring(e.cast("string"), 1, 10)

    aggs = []
    for k, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{k}"), text(F.min(c), c).alias(f"lo{k}"),
                 text(F.max(c), c).alias(f"hi{k}")]
    one = master.agg(*aggs) if aggs else master.agg(F.count("*"))

    def row(c: str, status: str, *found: F.Column) -> F.Column:
        nulls, lo, hi = found or (F.lit(None).cast("bigint"), F.lit(None).cast("string"), F.lit(None).cast("string"))
        return F.struct(F.lit(c).alias("column"), F.lit(types.get(c)).cast("string").alias("dtype"), nulls.alias("nulls"),
                        lo.alias("min"), hi.alias("max"), F.lit(status).alias("status"))

    rows = [row(c, "ok", F.col(f"n{k}"), F.col(f"lo{k}"), F.col(f"hi{k}")) for k, c in enumerate(cols)]
    rows += [row(c, "missing") for c in expected if c not in types] + [row(c, "extra") for c in types if c not in expected]
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def sku_lead_time_mean(plan: DataFrame) -> DataFrame:
    """Exact mean lead times per SKU (equal means compare equal in a top-k)."""
    return plan.groupBy("SkuId").agg(
        exact_mean("CurrentLeadTimeDays", 6).alias("CurrentLeadTimeDays"),
        exact_mean("OptimisedLeadTimeDays", 6).alias("OptimisedLeadTimeDays"))


def price_ranges(master: DataFrame, prices: DataFrame) -> DataFrame:
    """Range of the SKUs' mean own prices, of the item prices, and the
    number of priced items."""
    own = master.groupBy("SkuId").agg(mean("Price").alias("p")).agg(F.min("p").alias("sg_min"), F.max("p").alias("sg_max"))
    item = prices.groupBy("item_id").agg(F.min("sell_price").alias("lo"), F.max("sell_price").alias("hi")).agg(
        F.min("lo").alias("m5_min"), F.max("hi").alias("m5_max"), F.count("*").alias("looked_up_items"))
    return own.crossJoin(item)  # one row each


def feature_readiness(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with every feature present."""
    return features.select(*cols).na.drop().agg(F.count("*").alias("rows_ready"))


def top_k(df: DataFrame, k: int, order: Sequence[F.Column]) -> DataFrame:
    """``orderBy(...).limit(k)`` (the limit is the feature)."""
    return df.orderBy(*order).limit(k)


def semi_join_keys(df: DataFrame, keys: DataFrame, key: str = "SkuId") -> DataFrame:
    """Rows whose key is listed (``left_semi``)."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def flag_listed(df: DataFrame, keys: DataFrame, key: str = "SkuId", name: str = "Listed") -> DataFrame:
    """J12 (flag form): left join + isNotNull."""
    k = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return df.join(k, key, "left").withColumn(name, F.col("_hit").isNotNull()).drop("_hit")


def calendar_names(d: F.Column) -> dict[str, F.Column]:
    """Month abbreviation and day name."""
    return {"MonthName": month_abbr(d), "DayName": day_name(d)}


def filter_panel(master: DataFrame, group: str | None = None, plant: str | None = None,
                 skus: Sequence[str] | None = None) -> DataFrame:
    """Optional filters; each becomes a predicate pushed to the scan."""
    out = master
    if group:
        out = out.where(F.col("ProductGroup") == group)
    if plant:
        out = out.where(F.col("PlantId") == plant)
    if skus:
        out = out.where(F.col("SkuId").isin(list(skus)))
    return out


def distinct_sorted_values(master: DataFrame) -> DataFrame:
    """Pick-lists (groups, plants) and date bounds as (kind, value)."""
    g = master.select(F.lit("group").alias("kind"), F.col("ProductGroup").alias("value")).distinct()
    p = master.select(F.lit("plant").alias("kind"), F.col("PlantId").alias("value")).distinct()
    b = master.agg(F.min("Date").cast("string").alias("date_min"),
                   F.max("Date").cast("string").alias("date_max")).unpivot(
        [], ["date_min", "date_max"], "kind", "value")
    return g.unionByName(p).unionByName(b)


def unpivot_before_after(df: DataFrame, key: str = "SkuId") -> DataFrame:
    """Before_PBT / After_PBT -> (Scenario, PBT)."""
    return df.select(key, "Before_PBT", "After_PBT").unpivot([key], ["Before_PBT", "After_PBT"],
                                                            "Scenario", "PBT")
