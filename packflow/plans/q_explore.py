"""Queries: exploration aggregates, top-k, labels (A14-A38, T01-T10, W04,
J12-J13, P13-P16, P26-P29)."""

from __future__ import annotations

from pyspark.sql import functions as F

from packflow.operators import explore as X
from packflow.operators import features as FE
from packflow.operators import finance as FI
from packflow.plans.q_features import FEAT, _daily
from packflow.plans.q_network import NET, _plan
from packflow.plans.q_packs_finance import PF, _ledger, _packs
from packflow.plans.q_production import schedule_sql
from packflow.plans.registry import query
from packflow.plans.sqlfrag import emean, esum, mean, quantiles_sql, rhe
from packflow.sources import binding as B

ALL = {**PF, **NET, **FEAT}
ALL["gap"] = f"""SELECT "Date", pq AS "ProductionQty", dq AS "DeliveryQty", pq - dq AS "Gap" FROM
    (SELECT "Date", {esum("ProductionQty")} AS pq, SUM("DeliveryQty") AS dq FROM master GROUP BY 1) g"""
ALL["flagged"] = """SELECT m.*, COALESCE(GREATEST(c."snap_CA", c."snap_TX", c."snap_WI"), 0) AS any_snap,
    COALESCE(CAST(c.event_name_1 IS NOT NULL AS INTEGER), 0) AS has_event
    FROM master m LEFT JOIN calendar c ON m."Date" = c."date\""""
ALL["cv"] = """SELECT "SkuId", SUM("SalesOrderQty") / COUNT("SalesOrderQty") AS mean,
    STDDEV_SAMP("SalesOrderQty") AS std, std / (mean + 1e-9) AS cv FROM master GROUP BY 1"""
ALL["cat_prices"] = """SELECT s.store_id, p.p_type || '_' || s.item_id AS item_id, s.sell_price, p.p_type AS "Category"
    FROM sell_prices s JOIN part p ON s.item_id = 'P' || p.p_partkey"""
ALL["top_cats"] = 'SELECT "Category" FROM cat_prices GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 5'


def _m(spark, d):
    return B.master_table(spark, d)


def _cal(spark, d):
    return B.calendar(spark, d, _m(spark, d))


def _plain_feats(spark, d):
    """Features without category codes, for queries that read none."""
    return FE.build_features(_daily(spark, d), {})


def _prices(spark, d):
    """Prices with the category that their item ids begin with."""
    return B.typed_prices(spark, d).withColumn("Category", X.item_category(F.col("item_id")))


def _flagged(spark, d):
    return X.with_any_flag(_m(spark, d), _cal(spark, d))


@query("daily_sales_total", "Date:t, SalesOrderQty:x",
       'SELECT "Date", SUM("SalesOrderQty") AS "SalesOrderQty" FROM master GROUP BY 1')
def q_daily_sales_total(spark, d):
    """A14 daily_sales_total."""
    return X.daily_sales_total(_m(spark, d))


@query("daily_gap", "Date:t, ProductionQty:d, DeliveryQty:x, Gap:d", "SELECT * FROM gap", ALL)
def q_daily_gap(spark, d):
    """A15 daily_gap."""
    return X.daily_gap(_m(spark, d)).drop("Gap_7d_centred")


@query("centred_mean_7", "Date:t, Gap:d, Gap_7d_centred:d",
       """SELECT "Date", "Gap", CASE WHEN COUNT("Gap") OVER w = 7 THEN AVG("Gap") OVER w END AS "Gap_7d_centred"
          FROM gap WINDOW w AS (ORDER BY "Date" ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""", ALL)
def q_centred_mean_7(spark, d):
    """W04 centred_mean_7 on the one-row-per-day gap table."""
    return X.daily_gap(_m(spark, d)).select("Date", "Gap", "Gap_7d_centred")


@query("gap_statistics", "mean_gap:d, max_gap:d, negative_gap_pct:d",
       """SELECT SUM("Gap") / COUNT("Gap") AS mean_gap, MAX("Gap") AS max_gap,
          AVG(CAST("Gap" < 0 AS DOUBLE)) * 100 AS negative_gap_pct FROM gap""", ALL)
def q_gap_statistics(spark, d):
    """A16 gap_statistics."""
    return X.gap_statistics(X.daily_gap(_m(spark, d)))


@query("volatility_group_month", "ProductGroup:s, " + ", ".join(f"{m}:d" for m in X.MONTHS),
       "SELECT \"ProductGroup\", " + ", ".join(
           f'COALESCE(STDDEV_SAMP("SalesOrderQty") FILTER (WHERE MONTH("Date") = {i + 1}), 0.0e0) AS "{m}"'
           for i, m in enumerate(X.MONTHS)) + " FROM master GROUP BY 1")
def q_volatility_group_month(spark, d):
    """A17 volatility_group_month."""
    return X.volatility_group_month(_m(spark, d))


@query("sales_group_weekday", "ProductGroup:s, " + ", ".join(f"{w}:d" for w in X.DAYS),
       "SELECT \"ProductGroup\", " + ", ".join(
           f'COALESCE(SUM("SalesOrderQty") FILTER (WHERE ISODOW("Date") = {i + 1}) / '
           f'COUNT("SalesOrderQty") FILTER (WHERE ISODOW("Date") = {i + 1}), 0.0e0) AS "{w}"'
           for i, w in enumerate(X.DAYS)) + " FROM master GROUP BY 1")
def q_sales_group_weekday(spark, d):
    """A18 sales_group_weekday."""
    return X.sales_group_weekday(_m(spark, d))


@query("plant_issue_rate", "PlantId:s, TotalProduction:d, TotalFactoryIssue:d, SkuCount:i, IssueRate:d",
       f"""SELECT "PlantId", {esum("ProductionQty")} AS "TotalProduction",
          {esum("FactoryIssueQty")} AS "TotalFactoryIssue", COUNT(DISTINCT "SkuId") AS "SkuCount",
          "TotalFactoryIssue" / ("TotalProduction" + 1e-9) * 100 AS "IssueRate" FROM master GROUP BY 1""")
def q_plant_issue_rate(spark, d):
    """A19 plant_issue_rate."""
    return X.plant_issue_rate(_m(spark, d))


@query("demand_cv", "SkuId:s, mean:d, std:d, cv:d, median_cv:d",
       f"""SELECT c.*, q.q AS median_cv FROM cv c CROSS JOIN {quantiles_sql('SELECT * FROM cv', 'cv', [0.5])} q""",
       ALL)
def q_demand_cv(spark, d):
    """A20 demand_cv (exact median)."""
    return X.demand_cv(_m(spark, d))


@query("promo_impact", "any_snap:i, mean:d, std:d, median:d, label:s",
       f"""SELECT s.any_snap, s.mean, s.std, q.q AS median,
          CASE WHEN s.any_snap = 0 THEN 'No SNAP' WHEN s.any_snap = 1 THEN 'SNAP Active' ELSE CAST(s.any_snap AS VARCHAR) END AS label
          FROM (SELECT any_snap, SUM("SalesOrderQty") / COUNT("SalesOrderQty") AS mean,
                STDDEV_SAMP("SalesOrderQty") AS std FROM flagged GROUP BY 1) s
          JOIN {quantiles_sql('SELECT * FROM flagged', '"SalesOrderQty"', [0.5], 'any_snap')} q
          ON s.any_snap = q.any_snap""", ALL)
def q_promo_impact(spark, d):
    """A21 promo_impact (exact medians per flag)."""
    return X.promo_impact(_flagged(spark, d))


@query("promo_coverage", "snap_coverage_pct:d",
       "SELECT AVG(any_snap) * 100 AS snap_coverage_pct FROM flagged", ALL)
def q_promo_coverage(spark, d):
    """A22 promo_coverage."""
    return X.promo_coverage(_flagged(spark, d))


@query("event_indicator", "Date:t, SkuId:s, StorageLocationId:s, has_event:i",
       'SELECT "Date", "SkuId", "StorageLocationId", has_event FROM flagged', ALL)
def q_event_indicator(spark, d):
    """P14 event_indicator."""
    return _flagged(spark, d).select("Date", "SkuId", "StorageLocationId", "has_event")


@query("label_codes", "any_snap:i, label:s, n_rows:i",
       """SELECT any_snap, CASE WHEN any_snap = 0 THEN 'No SNAP' WHEN any_snap = 1 THEN 'SNAP Active'
          ELSE CAST(any_snap AS VARCHAR) END AS label, COUNT(*) AS n_rows FROM flagged GROUP BY 1""", ALL)
def q_label_codes(spark, d):
    """P16 label_codes."""
    f = _flagged(spark, d)
    return f.groupBy("any_snap").agg(F.count("*").alias("n_rows")).withColumn(
        "label", X.label_codes(F.col("any_snap")))


@query("flag_days_by_state", "state:s, days:i",
       """SELECT 'snap_CA' AS state, SUM("snap_CA") AS days FROM calendar UNION ALL
          SELECT 'snap_TX', SUM("snap_TX") FROM calendar UNION ALL SELECT 'snap_WI', SUM("snap_WI") FROM calendar""")
def q_flag_days_by_state(spark, d):
    """A23 flag_days_by_state."""
    return X.flag_days_by_state(_cal(spark, d))


@query("flag_share_by_month", "month:i, any_snap:d",
       """SELECT "month", AVG(GREATEST("snap_CA", "snap_TX", "snap_WI")) AS any_snap FROM calendar GROUP BY 1""")
def q_flag_share_by_month(spark, d):
    """A24 flag_share_by_month."""
    return X.flag_share_by_month(_cal(spark, d))


@query("event_type_counts", "EventType:s, Count:i",
       """SELECT event_type_1 AS "EventType", COUNT(*) AS "Count" FROM calendar
          WHERE event_type_1 IS NOT NULL GROUP BY 1""")
def q_event_type_counts(spark, d):
    """A25 event_type_counts."""
    return X.event_type_counts(_cal(spark, d))


@query("item_category", "item_id:s, Category:s",
       "SELECT DISTINCT item_id, \"Category\" FROM cat_prices", ALL)
def q_item_category(spark, d):
    """P15 item_category of ids like ``ECONOMY_P12``."""
    return _prices(spark, d).select("item_id", "Category").distinct()


_Q3 = [0.25, 0.5, 0.75]


def _qpivot(src, value, group):
    q = quantiles_sql(src, value, _Q3, group)
    return f"""(SELECT {group}, MAX(q) FILTER (WHERE p = 0.25) AS p25, MAX(q) FILTER (WHERE p = 0.5) AS p50,
        MAX(q) FILTER (WHERE p = 0.75) AS p75 FROM {q} qq GROUP BY 1)"""


@query("price_describe_by_category", """Category:s, count:i, mean:d, std:d, min:d, max:d, p25:d, p50:d,
p75:d""",
       f"""SELECT s.*, q.p25, q.p50, q.p75 FROM (SELECT "Category", COUNT(sell_price) AS count,
          SUM(sell_price) / COUNT(sell_price) AS mean, STDDEV_SAMP(sell_price) AS std, MIN(sell_price) AS min,
          MAX(sell_price) AS max FROM cat_prices GROUP BY 1) s
          JOIN {_qpivot('SELECT * FROM cat_prices', 'sell_price', '"Category"')} q ON s."Category" = q."Category\"""",
       ALL)
def q_price_describe_by_category(spark, d):
    """A26 price_describe_by_category (exact quartiles)."""
    return X.price_describe_by_category(B.typed_prices(spark, d))


def _box_sql(kind, src, group, value):
    inside = "f.v >= q.p25 - 1.5e0 * (q.p75 - q.p25) AND f.v <= q.p75 + 1.5e0 * (q.p75 - q.p25)"
    return f"""SELECT '{kind}' AS kind, CAST(q.{group} AS VARCHAR) AS value, q.p25 AS q1, q.p50 AS median, q.p75 AS q3,
          MIN(f.v) FILTER (WHERE {inside}) AS lower_whisker, MAX(f.v) FILTER (WHERE {inside}) AS upper_whisker,
          COUNT(*) FILTER (WHERE NOT ({inside})) AS n_outliers
          FROM {_qpivot(src, value, group)} q
          JOIN (SELECT {group}, CAST({value} AS DOUBLE) AS v FROM ({src}) x) f ON f.{group} = q.{group}
          GROUP BY q.{group}, q.p25, q.p50, q.p75"""


@query("box_statistics", """kind:s, value:s, q1:d, median:d, q3:d, lower_whisker:d, upper_whisker:d,
n_outliers:i""",
       _box_sql("any_snap", "SELECT * FROM flagged", "any_snap", '"SalesOrderQty"') + " UNION ALL "
       + _box_sql("Category", 'SELECT c.* FROM cat_prices c SEMI JOIN top_cats t ON c."Category" = t."Category"',
                  '"Category"', "sell_price"), ALL)
def q_box_statistics(spark, d):
    """A27 box_statistics: sales by promo flag, and sell prices of the five most
    frequent categories."""
    sales = X.box_statistics(_flagged(spark, d), "any_snap", "SalesOrderQty")
    p = _prices(spark, d)
    top = X.top_k(p.groupBy("Category").agg(F.count("*").alias("n")), 5, [F.desc("n"), F.asc("Category")])
    price = X.box_statistics(X.semi_join_keys(p, top, "Category"), "Category", "sell_price")
    named = lambda df, kind: df.withColumn("value", F.col(kind).cast("string")).drop(kind).withColumn(
        "kind", F.lit(kind))
    return named(sales, "any_snap").unionByName(named(price, "Category"))


_DESC_COLS = ["SalesOrderQty", "ProductionQty", "DeliveryQty", "FactoryIssueQty", "UnitCost", "Price",
              "Promotional_Flag"]
ALL["long"] = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST(\"{c}\" AS DOUBLE) AS v FROM master"
                                 for c in _DESC_COLS)


@query("describe_panel", "column:s, count:i, mean:d, std:d, min:d, max:d, p25:d, p50:d, p75:d",
       f"""SELECT s.col AS "column", s.count, s.mean, s.std, s.min, s.max, q.p25, q.p50, q.p75
          FROM (SELECT col, COUNT(v) AS count, SUM(v) / COUNT(v) AS mean, STDDEV_SAMP(v) AS std,
                MIN(v) AS min, MAX(v) AS max FROM long GROUP BY 1) s
          JOIN {_qpivot('SELECT * FROM long', 'v', 'col')} q ON s.col = q.col""", ALL)
def q_describe_panel(spark, d):
    """A28 describe_panel (exact quartiles)."""
    return X.describe_panel(_m(spark, d), _DESC_COLS)


def _hist_sql(src, value, bins, name, lo=None, hi=None):
    v = value if lo is None else f"LEAST(GREATEST({value}, {lo}e0), {hi}e0)"
    return f"""SELECT '{name}' AS hist, bin, lo + bin * w AS bin_lo, lo + (bin + 1) * w AS bin_hi, COUNT(*) AS count,
        COUNT(*) / (n * w) AS density FROM (SELECT t.v, mm.lo, mm.n,
          CASE WHEN mm.hi > mm.lo THEN (mm.hi - mm.lo) / {bins} ELSE 1.0e0 END AS w,
          CAST(CASE WHEN mm.hi > mm.lo THEN LEAST(FLOOR((t.v - mm.lo) / ((mm.hi - mm.lo) / {bins})), {bins - 1}) ELSE 0 END AS BIGINT) AS bin
          FROM (SELECT CAST({v} AS DOUBLE) AS v FROM ({src}) s WHERE {value} IS NOT NULL) t
          CROSS JOIN (SELECT MIN(CAST({v} AS DOUBLE)) AS lo, MAX(CAST({v} AS DOUBLE)) AS hi, COUNT(*) AS n
                      FROM ({src}) s2 WHERE {value} IS NOT NULL) mm) b
        GROUP BY bin, lo, w, n"""


HIST_OUT = "hist:s, bin:i, bin_lo:d, bin_hi:d, count:i, density:d"


@query("histogram", HIST_OUT,
       _hist_sql("SELECT * FROM cv", "cv", 15, "cv") + " UNION ALL "
       + _hist_sql("SELECT SUM(\"Price\") / COUNT(\"Price\") AS p FROM master GROUP BY \"SkuId\"", "p", 20, "sku_price")
       + " UNION ALL " + _hist_sql("SELECT * FROM sell_prices", "sell_price", 30, "sell_price", 0, 100), ALL)
def q_histogram(spark, d):
    """A29 histogram: CV (15 bins), SKU mean price (20), sell price clipped
    to [0, 100] (30), with densities."""
    m = _m(spark, d)
    cv = X.sku_cv(m)
    sp = m.groupBy("SkuId").agg((F.sum("Price") / F.count("Price")).alias("p"))
    return (X.histogram(cv, "cv", 15, "cv").unionByName(X.histogram(sp, "p", 20, "sku_price"))
            .unionByName(X.histogram(B.sell_prices(spark, d), "sell_price", 30, "sell_price", 0.0, 100.0)))


CORR_COLS = ["day_of_week", "month", "day_of_year", "week_of_year", "lag_7", "lag_14",
             "rolling_mean_7", "rolling_std_7", "Promotional_Flag", "SalesOrderQty"]


def _corr_sql(pairs):
    parts = []
    for a, b in pairs:
        x, y = f'CAST("{a}" AS DOUBLE)', f'CAST("{b}" AS DOUBLE)'
        num = f"(COUNT(*) * SUM({x} * {y}) - SUM({x}) * SUM({y}))"
        da = f"(COUNT(*) * SUM({x} * {x}) - SUM({x}) * SUM({x}))"
        db = f"(COUNT(*) * SUM({y} * {y}) - SUM({y}) * SUM({y}))"
        parts.append(f"SELECT '{b}' AS \"row\", '{a}' AS col, CASE WHEN {da} > 0 AND {db} > 0 THEN "
                     f"{num} / SQRT({da} * {db}) END AS r FROM feats")
    return " UNION ALL ".join(parts)


@query("correlation_matrix", "row:s, col:s, r:d",
       _corr_sql([(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]), ALL)
def q_correlation_matrix(spark, d):
    """A30 correlation_matrix (lower triangle)."""
    return X.correlation_matrix(_plain_feats(spark, d), CORR_COLS)


@query("target_correlation", "row:s, col:s, r:d",
       _corr_sql([(a, "SalesOrderQty") for a in CORR_COLS[:-1]]), ALL)
def q_target_correlation(spark, d):
    """A31 target_correlation."""
    return X.target_correlation(_plain_feats(spark, d), CORR_COLS[:-1], "SalesOrderQty")


@query("weekday_seasonality", "day_of_week:i, SalesOrderQty:d, DayName:s",
       """SELECT day_of_week, SUM("SalesOrderQty") / COUNT(*) AS "SalesOrderQty",
          CASE day_of_week WHEN 0 THEN 'Mon' WHEN 1 THEN 'Tue' WHEN 2 THEN 'Wed' WHEN 3 THEN 'Thu'
          WHEN 4 THEN 'Fri' WHEN 5 THEN 'Sat' ELSE 'Sun' END AS "DayName" FROM feats GROUP BY 1""", ALL)
def q_weekday_seasonality(spark, d):
    """A32 weekday_seasonality."""
    return X.weekday_seasonality(_plain_feats(spark, d))


@query("value_counts", "what:s, value:s, count:i",
       """SELECT 'VelocityClass' AS what, "VelocityClass" AS value, COUNT(*) AS count FROM reco_cap GROUP BY 2
          UNION ALL SELECT 'PackConfig', "PackConfig", COUNT(*) FROM reco_cap GROUP BY 2
          UNION ALL SELECT 'Category', "Category", COUNT(*) FROM cat_prices GROUP BY 2""", ALL)
def q_value_counts(spark, d):
    """A33 value_counts: class, pack configuration, price category."""
    r = _packs(spark, d)[2]["recommendations"]
    return X.value_counts({"VelocityClass": r, "PackConfig": r, "Category": _prices(spark, d)})


@query("dataset_overview", """rows:i, date_min:t, date_max:t, skus:i, plants:i, locations:i,
groups:i""",
       """SELECT COUNT(*) AS rows, MIN("Date") AS date_min, MAX("Date") AS date_max,
          COUNT(DISTINCT "SkuId") AS skus, COUNT(DISTINCT "PlantId") AS plants,
          COUNT(DISTINCT "StorageLocationId") AS locations, COUNT(DISTINCT "ProductGroup") AS groups FROM master""")
def q_dataset_overview(spark, d):
    """A34 dataset_overview."""
    return X.dataset_overview(_m(spark, d))


@query("sku_lead_time_mean", "SkuId:s, CurrentLeadTimeDays:d, OptimisedLeadTimeDays:d",
       f"""SELECT "SkuId", {emean("CurrentLeadTimeDays", 6)} AS "CurrentLeadTimeDays",
          {emean("OptimisedLeadTimeDays", 6)} AS "OptimisedLeadTimeDays" FROM dplan GROUP BY 1""", ALL)
def q_sku_lead_time_mean(spark, d):
    """A36 sku_lead_time_mean."""
    return X.sku_lead_time_mean(_plan(spark, d)[0])


@query("price_ranges", "sg_min:d, sg_max:d, m5_min:d, m5_max:d, looked_up_items:i",
       """SELECT MIN(p) AS sg_min, MAX(p) AS sg_max, (SELECT MIN(sell_price) FROM sell_prices) AS m5_min,
          (SELECT MAX(sell_price) FROM sell_prices) AS m5_max, (SELECT COUNT(*) FROM item_price) AS looked_up_items
          FROM (SELECT SUM("Price") / COUNT("Price") AS p FROM master GROUP BY "SkuId") t""", ALL)
def q_price_ranges(spark, d):
    """A37 price_ranges."""
    return X.price_ranges(_m(spark, d), B.sell_prices(spark, d))


@query("feature_readiness", "rows_ready:i",
       "SELECT COUNT(*) AS rows_ready FROM feats", ALL)
def q_feature_readiness(spark, d):
    """A38 feature_readiness: rows with every feature present."""
    return X.feature_readiness(_plain_feats(spark, d), CORR_COLS)


# ---- top-k reports ---------------------------------------------------------------

@query("top_skus_by_sales", "SkuId:s, SalesOrderQty:x",
       """SELECT "SkuId", SUM("SalesOrderQty") AS "SalesOrderQty" FROM master GROUP BY 1
          ORDER BY 2 DESC, 1 LIMIT 15""")
def q_top_skus_by_sales(spark, d):
    """T01 top_skus_by_sales."""
    s = _m(spark, d).groupBy("SkuId").agg(F.sum("SalesOrderQty").alias("SalesOrderQty"))
    return X.top_k(s, 15, [F.desc("SalesOrderQty"), F.asc("SkuId")])


@query("top_pbt_uplift", "SkuId:s, Scenario:s, PBT:d",
       """SELECT "SkuId", 'Before_PBT' AS "Scenario", "Before_PBT" AS "PBT" FROM top UNION ALL
          SELECT "SkuId", 'After_PBT', "After_PBT" FROM top""",
       {**ALL, "top": """SELECT * FROM ledger ORDER BY "PBT_Uplift_Pct" DESC, "SkuId" LIMIT 20"""})
def q_top_pbt_uplift(spark, d):
    """T02 top_pbt_uplift then P29."""
    t = X.top_k(_ledger(spark, d), 20, [F.desc("PBT_Uplift_Pct"), F.asc("SkuId")])
    return X.unpivot_before_after(t)


@query("unpivot_before_after", "SkuId:s, Scenario:s, PBT:d",
       """SELECT "SkuId", 'Before_PBT' AS "Scenario", "Before_PBT" AS "PBT" FROM ledger UNION ALL
          SELECT "SkuId", 'After_PBT', "After_PBT" FROM ledger""", ALL)
def q_unpivot_before_after(spark, d):
    """P29 unpivot_before_after."""
    return X.unpivot_before_after(_ledger(spark, d))


@query("top_revenue", "SkuId:s, Before_AnnualRevenue:d, After_AnnualRevenue:d",
       """SELECT "SkuId", "Before_AnnualRevenue", "After_AnnualRevenue" FROM ledger
          ORDER BY "After_AnnualRevenue" DESC, "SkuId" LIMIT 10""", ALL)
def q_top_revenue(spark, d):
    """T03 top_revenue."""
    t = _ledger(spark, d).select("SkuId", "Before_AnnualRevenue", "After_AnnualRevenue")
    return X.top_k(t, 10, [F.desc("After_AnnualRevenue"), F.asc("SkuId")])


@query("top_forecast", "SkuId:s, Date:t, ForecastQty:d, CI_Lower:d, CI_Upper:d",
       """SELECT f."SkuId", f."Date", f."ForecastQty", f."CI_Lower", f."CI_Upper" FROM fcast f
          SEMI JOIN (SELECT "SkuId" FROM fcast GROUP BY 1 ORDER BY SUM("ForecastQty") DESC, 1 LIMIT 6) t
          ON f."SkuId" = t."SkuId\"""", ALL)
def q_top_forecast(spark, d):
    """T04 top_forecast: the 6 largest total forecasts with their series."""
    m = _m(spark, d)
    fc = FE.naive_forecast(FE.daily_series(m))
    tot = fc.groupBy("SkuId").agg(F.sum("ForecastQty").alias("t"))
    top = X.top_k(tot, 6, [F.desc("t"), F.asc("SkuId")])
    return X.semi_join_keys(fc, top).select("SkuId", "Date", "ForecastQty", "CI_Lower", "CI_Upper")


@query("top_volatile", "SkuId:s, cv:d",
       'SELECT "SkuId", cv FROM cv ORDER BY cv DESC NULLS LAST, "SkuId" LIMIT 15', ALL)
def q_top_volatile(spark, d):
    """T05 top_volatile."""
    c = X.sku_cv(_m(spark, d)).select("SkuId", "cv")
    return X.top_k(c, 15, [F.desc_nulls_last("cv"), F.asc("SkuId")])


SCHED_COLS = ["SkuId", "PlantId", "ProductGroup", "VelocityClass", "OptimalBatchSize",
              "TargetDailyProduction", "EstLeadTimeDays", "ProductionEfficiencyScore", "SchedulePriority"]


@query("top_schedule", """SkuId:s, PlantId:s, ProductGroup:s, VelocityClass:s, OptimalBatchSize:i,
TargetDailyProduction:x, EstLeadTimeDays:i, ProductionEfficiencyScore:x, SchedulePriority:s""",
       f"""SELECT "SkuId", "PlantId", "ProductGroup", "VelocityClass", "OptimalBatchSize",
          {rhe('"TargetDailyProduction"', 1)} AS "TargetDailyProduction", "EstLeadTimeDays",
          {rhe('"ProductionEfficiencyScore"', 1)} AS "ProductionEfficiencyScore", "SchedulePriority"
          FROM ({schedule_sql(None)}) s ORDER BY s."TargetDailyProduction" DESC, "SkuId", "PlantId" LIMIT 30""")
def q_top_schedule(spark, d):
    """T06 top_schedule: 30 highest target production (rounded to 1)."""
    from packflow.operators import production as P
    from packflow.functions.exprs import round_half_even
    m = _m(spark, d)
    s = P.production_schedule(m, P.plant_statistics(m)).select(*SCHED_COLS)
    t = X.top_k(s, 30, [F.desc("TargetDailyProduction"), F.asc("SkuId"), F.asc("PlantId")])
    return t.withColumns({"TargetDailyProduction": round_half_even("TargetDailyProduction", 1),
                          "ProductionEfficiencyScore": round_half_even("ProductionEfficiencyScore", 1)})


@query("top_dispatch", """SkuId:s, StorageLocationId:s, AvgDeliveryQty:x, CurrentLeadTimeDays:x,
OptimisedLeadTimeDays:x, LeadTimeReduction_Pct:x, DispatchPriority:s, Path:s""",
       f"""SELECT "SkuId", "StorageLocationId", {rhe('"AvgDeliveryQty"', 2)} AS "AvgDeliveryQty",
          "CurrentLeadTimeDays", "OptimisedLeadTimeDays", "LeadTimeReduction_Pct", "DispatchPriority", "Path"
          FROM dplan ORDER BY "LeadTimeReduction_Pct" DESC, "SkuId", "StorageLocationId" LIMIT 30""", ALL)
def q_top_dispatch(spark, d):
    """T07 top_dispatch."""
    from packflow.functions.exprs import round_half_even
    p = _plan(spark, d)[0].select("SkuId", "StorageLocationId", "AvgDeliveryQty", "CurrentLeadTimeDays",
                                  "OptimisedLeadTimeDays", "LeadTimeReduction_Pct", "DispatchPriority", "Path")
    t = X.top_k(p, 30, [F.desc("LeadTimeReduction_Pct"), F.asc("SkuId"), F.asc("StorageLocationId")])
    return t.withColumn("AvgDeliveryQty", round_half_even("AvgDeliveryQty", 2))


@query("top_lead_time", "SkuId:s, CurrentLeadTimeDays:d, OptimisedLeadTimeDays:d",
       f"""SELECT "SkuId", {emean("CurrentLeadTimeDays", 6)} AS "CurrentLeadTimeDays",
          {emean("OptimisedLeadTimeDays", 6)} AS "OptimisedLeadTimeDays" FROM dplan GROUP BY 1
          ORDER BY 2 DESC, 1 LIMIT 20""", ALL)
def q_top_lead_time(spark, d):
    """T09 top_lead_time."""
    return X.top_k(q_sku_lead_time_mean(spark, d), 20, [F.desc("CurrentLeadTimeDays"), F.asc("SkuId")])


@query("top_categories", "kind:s, value:s, count:i",
       """SELECT 'Category' AS kind, "Category" AS value, COUNT(*) AS count FROM cat_prices c
          SEMI JOIN top_cats t ON c."Category" = t."Category" GROUP BY 2
          UNION ALL SELECT * FROM (SELECT 'SkuId', "SkuId", COUNT(*) FROM feats GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1) s""",
       ALL)
def q_top_categories(spark, d):
    """T10 top_categories: the 5 most frequent price categories, and the SKU
    with the most feature rows."""
    c = X.top_k(_prices(spark, d).groupBy("Category").agg(F.count("*").alias("count")), 5,
                [F.desc("count"), F.asc("Category")])
    s = X.most_frequent(_plain_feats(spark, d), "SkuId")
    named = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col(kind).alias("value"), "count")
    return named(c, "Category").unionByName(named(s, "SkuId"))


@query("semi_join_top_categories", "store_id:i, item_id:s, sell_price:d, Category:s",
       """SELECT c.store_id, c.item_id, c.sell_price, c."Category" FROM cat_prices c SEMI JOIN top_cats t
          ON c."Category" = t."Category\"""", ALL)
def q_semi_join_top_categories(spark, d):
    """J13 semi_join_top_categories."""
    p = _prices(spark, d)
    top = X.top_k(p.groupBy("Category").agg(F.count("*").alias("n")), 5, [F.desc("n"), F.asc("Category")])
    return X.semi_join_keys(p, top, "Category").select("store_id", "item_id", "sell_price", "Category")


@query("lag_signal", "SkuId:s, Date:t, SalesOrderQty:x, lag_7:x, rolling_mean_7:d, rn:i",
       """SELECT "SkuId", "Date", "SalesOrderQty", lag_7, rolling_mean_7, rn FROM (SELECT *, ROW_NUMBER() OVER
          (PARTITION BY "SkuId" ORDER BY "Date") AS rn FROM feats WHERE "SkuId" IN
          (SELECT "SkuId" FROM (SELECT "SkuId", COUNT(*) AS c FROM feats GROUP BY 1 ORDER BY c DESC, 1 LIMIT 1) t)) x
          WHERE rn <= 100""", ALL)
def q_lag_signal(spark, d):
    """W13 (first form): the first 100 feature rows of the most frequent SKU."""
    f = _plain_feats(spark, d)
    sample = X.semi_join_keys(f, X.most_frequent(f, "SkuId"))
    return FE.first_rows(sample, 100).select("SkuId", "Date", "SalesOrderQty", "lag_7", "rolling_mean_7", "rn")


@query("flag_listed", "SkuId:s, IsUnprofitable:b, n_rows:i",
       """SELECT m."SkuId", COALESCE(l."IsUnprofitable", false) AS "IsUnprofitable", COUNT(*) AS n_rows FROM master m
          LEFT JOIN ledger l ON m."SkuId" = l."SkuId" GROUP BY 1, 2""", ALL)
def q_flag_listed(spark, d):
    """J12 (flag form): every master row told whether its SKU is flagged."""
    flagged = _ledger(spark, d).where("IsUnprofitable")
    rows = X.flag_listed(_m(spark, d), flagged, name="IsUnprofitable")
    return rows.groupBy("SkuId", "IsUnprofitable").agg(F.count("*").alias("n_rows"))


@query("semi_join_skus", "Date:t, SkuId:s, StorageLocationId:s, SalesOrderQty:x",
       """SELECT m."Date", m."SkuId", m."StorageLocationId", m."SalesOrderQty" FROM master m
          SEMI JOIN (SELECT "SkuId" FROM ledger WHERE "IsUnprofitable") u ON m."SkuId" = u."SkuId\"""", ALL)
def q_semi_join_skus(spark, d):
    """J12 semi_join_skus: master rows of the SKUs flagged unprofitable."""
    flagged = _ledger(spark, d).where("IsUnprofitable")
    return X.semi_join_keys(_m(spark, d), flagged).select("Date", "SkuId", "StorageLocationId",
                                                          "SalesOrderQty")


@query("calendar_names", "Date:t, MonthName:s, DayName:s",
       """SELECT DISTINCT "Date", STRFTIME("Date", '%b') AS "MonthName", STRFTIME("Date", '%A') AS "DayName"
          FROM master""")
def q_calendar_names(spark, d):
    """P13 calendar_names."""
    m = _m(spark, d).select("Date").distinct()
    return m.withColumns(X.calendar_names(F.col("Date")))


@query("filter_panel", "Date:t, SkuId:s, PlantId:s, SalesOrderQty:x",
       """SELECT "Date", "SkuId", "PlantId", "SalesOrderQty" FROM master WHERE "ProductGroup" = 'ECONOMY'""")
def q_filter_panel(spark, d):
    """P26 filter_panel(group='ECONOMY')."""
    return X.filter_panel(_m(spark, d), group="ECONOMY").select("Date", "SkuId", "PlantId", "SalesOrderQty")


@query("distinct_sorted_values", "kind:s, value:s",
       """SELECT DISTINCT 'group' AS kind, "ProductGroup" AS value FROM master UNION ALL
          SELECT DISTINCT 'plant', "PlantId" FROM master UNION ALL
          SELECT 'date_min', CAST(MIN("Date") AS VARCHAR) FROM master UNION ALL
          SELECT 'date_max', CAST(MAX("Date") AS VARCHAR) FROM master""")
def q_distinct_sorted_values(spark, d):
    """P27 distinct_sorted_values."""
    return X.distinct_sorted_values(_m(spark, d))


@query("format_money_percent", "Before_TotalRevenue:s, After_TotalPBT:s, Revenue_Uplift_Pct:s",
       f"""SELECT CASE WHEN ABS(tb_rev) >= 1e6 THEN '£' || PRINTF('%.1f', tb_rev / 1e6) || 'M'
          ELSE '£' || FORMAT('{{:,.0f}}', ROUND_EVEN(tb_rev, 0)) END AS "Before_TotalRevenue",
          CASE WHEN ABS(ta_pbt) >= 1e6 THEN '£' || PRINTF('%.1f', ta_pbt / 1e6) || 'M'
          ELSE '£' || FORMAT('{{:,.0f}}', ROUND_EVEN(ta_pbt, 0)) END AS "After_TotalPBT",
          PRINTF('%.1f', CASE WHEN tb_rev <> 0 THEN (ta_rev - tb_rev) / ABS(tb_rev) * 100 ELSE 0 END) || '%' AS "Revenue_Uplift_Pct"
          FROM (SELECT SUM("Before_AnnualRevenue") AS tb_rev, SUM("After_AnnualRevenue") AS ta_rev,
                SUM("After_PBT") AS ta_pbt FROM ledger) t""", ALL)
def q_format_money_percent(spark, d):
    """P28 format_money_percent: '£12.3M' / '£1,234' / '12.3%' labels."""
    from packflow.functions.exprs import money_label, percent_label
    t = FI.portfolio_totals(_ledger(spark, d))
    up = F.when(F.col("tb_rev") != 0, (F.col("ta_rev") - F.col("tb_rev")) / F.abs(F.col("tb_rev")) * 100
                ).otherwise(F.lit(0.0))
    return t.select(money_label("tb_rev").alias("Before_TotalRevenue"),
                    money_label("ta_pbt").alias("After_TotalPBT"),
                    percent_label(up).alias("Revenue_Uplift_Pct"))
