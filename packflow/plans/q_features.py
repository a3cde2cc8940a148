"""Queries: calendar parts, windows, features, horizon, split, errors
(P12, P17, P18, P25, W01-W08, W13, M01, M05, M08, A39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from packflow.functions.exprs import calendar_parts
from packflow.operators import features as FE
from packflow.operators.ranking import dense_codes
from packflow.plans.registry import query
from packflow.sources import binding as B

FEAT = {
    "dseries": """SELECT "SkuId", "Date", SUM("SalesOrderQty") AS "SalesOrderQty",
        MAX("Promotional_Flag") AS "Promotional_Flag", MIN("ProductGroup") AS "ProductGroup",
        MIN("SubGroup") AS "SubGroup", MIN("PlantId") AS "PlantId" FROM master GROUP BY 1, 2""",
    "frames": """SELECT *,
        COALESCE(LAG("SalesOrderQty", 7) OVER w, 0.0e0) AS lag_7,
        COALESCE(LAG("SalesOrderQty", 14) OVER w, 0.0e0) AS lag_14,
        COALESCE(AVG("SalesOrderQty") OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0e0) AS rolling_mean_7,
        COALESCE(STDDEV_SAMP("SalesOrderQty") OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0e0) AS rolling_std_7,
        COALESCE(LAG("SalesOrderQty", 1) OVER w, 0.0e0) AS lag_1,
        ISODOW("Date") - 1 AS day_of_week, MONTH("Date") AS "month", DAYOFYEAR("Date") AS day_of_year,
        WEEKOFYEAR("Date") AS week_of_year
        FROM dseries WINDOW w AS (PARTITION BY "SkuId" ORDER BY "Date")""",
    "enc_sku": """SELECT "SkuId", ROW_NUMBER() OVER (ORDER BY "SkuId") - 1 AS "SkuId_enc"
        FROM (SELECT DISTINCT "SkuId" FROM dseries) t""",
    "enc_pg": """SELECT "ProductGroup", ROW_NUMBER() OVER (ORDER BY "ProductGroup") - 1 AS "ProductGroup_enc"
        FROM (SELECT DISTINCT "ProductGroup" FROM dseries WHERE "ProductGroup" IS NOT NULL) t""",
    "enc_sg": """SELECT "SubGroup", ROW_NUMBER() OVER (ORDER BY "SubGroup") - 1 AS "SubGroup_enc"
        FROM (SELECT DISTINCT "SubGroup" FROM dseries WHERE "SubGroup" IS NOT NULL) t""",
    "feats": """SELECT f.*, COALESCE(a."SkuId_enc", 0) AS "SkuId_enc",
        COALESCE(b."ProductGroup_enc", 0) AS "ProductGroup_enc", COALESCE(c."SubGroup_enc", 0) AS "SubGroup_enc"
        FROM frames f LEFT JOIN enc_sku a ON f."SkuId" = a."SkuId"
        LEFT JOIN enc_pg b ON f."ProductGroup" = b."ProductGroup" LEFT JOIN enc_sg c ON f."SubGroup" = c."SubGroup\"""",
    "train_rows": """SELECT * FROM feats WHERE "SalesOrderQty" > 0""",
    "split": """SELECT *, (ROW_NUMBER() OVER (ORDER BY "SkuId", "Date") - 1)
        < FLOOR(COUNT(*) OVER () * 0.8e0) AS is_train FROM train_rows""",
}


def _daily(spark, d):
    return FE.daily_series(B.master_table(spark, d))


def _feats(spark, d):
    return FE.build_features(_daily(spark, d))


@query("calendar_parts", "Date:t, day_of_week:i, month:i, day_of_year:i, week_of_year:i",
       """SELECT DISTINCT "Date", ISODOW("Date") - 1 AS day_of_week, MONTH("Date") AS "month",
          DAYOFYEAR("Date") AS day_of_year, WEEKOFYEAR("Date") AS week_of_year FROM master""")
def q_calendar_parts(spark, d):
    """P12 calendar_parts (Mon = 0, ISO week)."""
    m = B.master_table(spark, d)
    return m.select("Date").distinct().withColumns(calendar_parts("Date"))


@query("daily_series", """SkuId:s, Date:t, SalesOrderQty:x, Promotional_Flag:i, ProductGroup:s,
SubGroup:s, PlantId:s""", "SELECT * FROM dseries", FEAT)
def q_daily_series(spark, d):
    """SKU x day series (the grain of every row frame)."""
    return _daily(spark, d)


@query("lag_features", "SkuId:s, Date:t, lag_7:x, lag_14:x",
       'SELECT "SkuId", "Date", lag_7, lag_14 FROM frames', FEAT)
def q_lag_features(spark, d):
    """W01 lag_features."""
    return FE.lag_features(_daily(spark, d)).select("SkuId", "Date", "lag_7", "lag_14")


@query("trailing_mean_7", "SkuId:s, Date:t, rolling_mean_7:d",
       'SELECT "SkuId", "Date", rolling_mean_7 FROM frames', FEAT)
def q_trailing_mean_7(spark, d):
    """W02 trailing_mean_7."""
    return FE.trailing_mean_7(_daily(spark, d)).select("SkuId", "Date", "rolling_mean_7")


@query("trailing_std_7", "SkuId:s, Date:t, rolling_std_7:d",
       'SELECT "SkuId", "Date", rolling_std_7 FROM frames', FEAT)
def q_trailing_std_7(spark, d):
    """W03 trailing_std_7."""
    return FE.trailing_std_7(_daily(spark, d)).select("SkuId", "Date", "rolling_std_7")


@query("last_row_per_sku", "SkuId:s, Date:t, SalesOrderQty:x, ProductGroup:s, SubGroup:s, PlantId:s",
       """SELECT "SkuId", "Date", "SalesOrderQty", "ProductGroup", "SubGroup", "PlantId" FROM
          (SELECT *, ROW_NUMBER() OVER (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn FROM dseries) t
          WHERE rn = 1""", FEAT)
def q_last_row_per_sku(spark, d):
    """W05 last_row_per_sku."""
    return FE.last_row_per_sku(_daily(spark, d)).select(
        "SkuId", "Date", "SalesOrderQty", "ProductGroup", "SubGroup", "PlantId")


@query("nth_from_last", "SkuId:s, lag_14_last:x",
       """SELECT "SkuId", "SalesOrderQty" AS lag_14_last FROM
          (SELECT *, ROW_NUMBER() OVER (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn,
           COUNT(*) OVER (PARTITION BY "SkuId") AS n FROM dseries) t WHERE rn = LEAST(14, n)""", FEAT)
def q_nth_from_last(spark, d):
    """W06 nth_from_last."""
    return FE.nth_from_last(_daily(spark, d))


@query("tail_stats", "SkuId:s, tail_mean:d, tail_std:d",
       """SELECT "SkuId", SUM("SalesOrderQty") / COUNT(*) AS tail_mean,
          COALESCE(STDDEV_SAMP("SalesOrderQty"), 0.0e0) AS tail_std FROM
          (SELECT *, ROW_NUMBER() OVER (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn FROM dseries) t
          WHERE rn <= 7 GROUP BY 1""", FEAT)
def q_tail_stats(spark, d):
    """W07 tail_stats."""
    return FE.tail_stats(_daily(spark, d))


@query("encode_categories", "column:s, value:s, code:i",
       """SELECT 'SkuId' AS "column", "SkuId" AS value, "SkuId_enc" AS code FROM enc_sku
          UNION ALL SELECT 'ProductGroup', "ProductGroup", "ProductGroup_enc" FROM enc_pg
          UNION ALL SELECT 'SubGroup', "SubGroup", "SubGroup_enc" FROM enc_sg""", FEAT)
def q_encode_categories(spark, d):
    """P17 encode_categories: sorted distinct -> 0..n-1 (distributed exact rank)."""
    dl = _daily(spark, d)
    out = None
    for c in ("SkuId", "ProductGroup", "SubGroup"):
        t = dense_codes(dl, c).select(F.lit(c).alias("column"), F.col(c).alias("value"),
                                      F.col(f"{c}_enc").alias("code"))
        out = t if out is None else out.unionByName(t)
    return out


@query("encode_unseen", "item_id:s, SkuId_enc:i",
       """SELECT DISTINCT s.item_id, COALESCE(e."SkuId_enc", 0) AS "SkuId_enc"
          FROM sell_prices s LEFT JOIN enc_sku e ON s.item_id = e."SkuId\"""", FEAT)
def q_encode_unseen(spark, d):
    """P18 encode_unseen: priced items coded with the SKU codes; an item the
    panel never saw gets code 0."""
    codes = {"SkuId": dense_codes(_daily(spark, d), "SkuId")}
    items = B.sell_prices(spark, d).select(F.col("item_id").alias("SkuId")).distinct()
    return FE.encode_unseen(items, codes).select(F.col("SkuId").alias("item_id"), "SkuId_enc")


FEAT_OUT = """SkuId:s, Date:t, SalesOrderQty:x, day_of_week:i, month:i, day_of_year:i,
week_of_year:i, lag_7:x, lag_14:x, rolling_mean_7:d, rolling_std_7:d, Promotional_Flag:i,
SkuId_enc:i, ProductGroup_enc:i, SubGroup_enc:i"""
FEAT_COLS = [c.split(":")[0].strip() for c in FEAT_OUT.replace("\n", " ").split(",")]


@query("build_features", FEAT_OUT, "SELECT " + ", ".join(f'"{c}"' for c in FEAT_COLS) + " FROM feats", FEAT)
def q_build_features(spark, d):
    """M01 build_features: the 12 model features + target."""
    return _feats(spark, d).select(*FEAT_COLS)


@query("filter_training_rows", FEAT_OUT,
       "SELECT " + ", ".join(f'"{c}"' for c in FEAT_COLS) + " FROM train_rows", FEAT)
def q_filter_training_rows(spark, d):
    """P25 filter_training_rows: target > 0, no null feature."""
    return FE.filter_training_rows(_feats(spark, d)).select(*FEAT_COLS)


@query("ordered_split", "SkuId:s, Date:t, is_train:b",
       'SELECT "SkuId", "Date", is_train FROM split', FEAT)
def q_ordered_split(spark, d):
    """W08 ordered_split: first 80 % of rows in (SkuId, Date) order."""
    rows = FE.filter_training_rows(_feats(spark, d))
    return FE.ordered_split(rows, 0.8, "sku_date_order").select("SkuId", "Date", "is_train")


@query("forecast_errors", "RMSE:d, MAPE:d, n_rows:i",
       """SELECT SQRT(AVG(("SalesOrderQty" - lag_1) * ("SalesOrderQty" - lag_1))) AS "RMSE",
          AVG(ABS(("SalesOrderQty" - lag_1) / ("SalesOrderQty" + 1e-9))) * 100 AS "MAPE", COUNT(*) AS n_rows
          FROM split WHERE NOT is_train""", FEAT)
def q_forecast_errors(spark, d):
    """A39 forecast_errors on the last-value prediction over the hold-out."""
    rows = FE.ordered_split(FE.filter_training_rows(_feats(spark, d)), 0.8, "sku_date_order")
    test = rows.where(~F.col("is_train")).withColumn("prediction", F.col("lag_1"))
    return FE.forecast_errors(test)


HORIZON_OUT = """SkuId:s, Date:t, step:i, lag_7:x, lag_14:x, rolling_mean_7:d, rolling_std_7:d,
Promotional_Flag:i, day_of_week:i, month:i, day_of_year:i, week_of_year:i, SkuId_enc:i,
ProductGroup_enc:i, SubGroup_enc:i"""
HCOLS = [c.split(":")[0].strip() for c in HORIZON_OUT.replace("\n", " ").split(",")]


@query("horizon_frame", HORIZON_OUT,
       """SELECT l."SkuId", CAST(e.e + CAST(r.s AS INTEGER) AS DATE) AS "Date", r.s AS step,
          l."SalesOrderQty" AS lag_7, n.lag_14_last AS lag_14, t.tail_mean AS rolling_mean_7,
          t.tail_std AS rolling_std_7, 0 AS "Promotional_Flag",
          ISODOW(e.e + CAST(r.s AS INTEGER)) - 1 AS day_of_week, MONTH(e.e + CAST(r.s AS INTEGER)) AS "month",
          DAYOFYEAR(e.e + CAST(r.s AS INTEGER)) AS day_of_year,
          WEEKOFYEAR(e.e + CAST(r.s AS INTEGER)) AS week_of_year, COALESCE(a."SkuId_enc", 0) AS "SkuId_enc",
          COALESCE(b."ProductGroup_enc", 0) AS "ProductGroup_enc", COALESCE(c."SubGroup_enc", 0) AS "SubGroup_enc"
          FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn
                FROM dseries) x WHERE rn = 1) l
          JOIN (SELECT "SkuId", "SalesOrderQty" AS lag_14_last FROM (SELECT *, ROW_NUMBER() OVER
                (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn, COUNT(*) OVER (PARTITION BY "SkuId") AS n
                FROM dseries) y WHERE rn = LEAST(14, n)) n ON l."SkuId" = n."SkuId"
          JOIN (SELECT "SkuId", SUM("SalesOrderQty") / COUNT(*) AS tail_mean,
                COALESCE(STDDEV_SAMP("SalesOrderQty"), 0.0e0) AS tail_std FROM (SELECT *, ROW_NUMBER() OVER
                (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn FROM dseries) z WHERE rn <= 7 GROUP BY 1) t
            ON l."SkuId" = t."SkuId"
          CROSS JOIN (SELECT MAX("Date") AS e FROM dseries) e CROSS JOIN range(1, 31) r(s)
          LEFT JOIN enc_sku a ON l."SkuId" = a."SkuId" LEFT JOIN enc_pg b ON l."ProductGroup" = b."ProductGroup"
          LEFT JOIN enc_sg c ON l."SubGroup" = c."SubGroup\"""", FEAT)
def q_horizon_frame(spark, d):
    """M05 horizon_frame: SKU x 30 days, lag features frozen at the end."""
    return FE.horizon_frame(_daily(spark, d), 30).select(*HCOLS)


@query("recent_actuals", "SkuId:s, Date:t, SalesOrderQty:x, rn:i",
       """SELECT "SkuId", "Date", "SalesOrderQty", rn FROM (SELECT *, ROW_NUMBER() OVER
          (PARTITION BY "SkuId" ORDER BY "Date" DESC) AS rn FROM dseries) t WHERE rn <= 90""", FEAT)
def q_recent_actuals(spark, d):
    """W13 recent_actuals: the last 90 rows of every SKU."""
    return FE.recent_actuals(_daily(spark, d), 90)


@query("actuals", "Date:t, SkuId:s, ActualQty:x, ProductGroup:s",
       """SELECT "Date", "SkuId", "SalesOrderQty" AS "ActualQty", "ProductGroup" FROM master""")
def q_actuals(spark, d):
    """M08 actuals: history rows of the forecast SKUs (all SKUs here)."""
    m = B.master_table(spark, d)
    return FE.actuals(m, FE.naive_forecast(FE.daily_series(m)))
