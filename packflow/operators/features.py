"""Daily series, row-frame features, horizon frame, ordered split
(W01-W08, P12, P17-P18, M01, M05, A39).

All row frames run on the SKU x day series, never on the location-grain
panel: a SKU's series has at most one row per calendar day, so a window
partition is bounded by the number of days however hot the SKU is. One
``(SkuId, Date)`` sort serves every frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packflow.functions.exprs import calendar_parts
from packflow.operators.common import first_by
from packflow.operators.ranking import dense_codes, global_index

FEATURES = ["day_of_week", "month", "day_of_year", "week_of_year", "lag_7", "lag_14",
            "rolling_mean_7", "rolling_std_7", "Promotional_Flag", "SkuId_enc",
            "ProductGroup_enc", "SubGroup_enc"]
FEW_CODES = 20_000  # codes whose table is broadcast


def by_sku():
    """The one (SkuId, Date) ordering every row frame shares."""
    return Window.partitionBy("SkuId").orderBy("Date")


def daily_series(master: DataFrame) -> DataFrame:
    """SKU x day: summed sales plus the SKU's attributes."""
    return master.groupBy("SkuId", "Date").agg(
        F.sum("SalesOrderQty").alias("SalesOrderQty"),
        F.max("Promotional_Flag").alias("Promotional_Flag"),
        F.min("ProductGroup").alias("ProductGroup"),
        F.min("SubGroup").alias("SubGroup"),
        F.min("PlantId").alias("PlantId"),
    )


def lag_features(daily: DataFrame, value: str = "SalesOrderQty") -> DataFrame:
    """Lag 7 and 14 rows per SKU, null -> 0."""
    return daily.withColumns({
        "lag_7": F.coalesce(F.lag(value, 7).over(by_sku()), F.lit(0.0)),
        "lag_14": F.coalesce(F.lag(value, 14).over(by_sku()), F.lit(0.0)),
    })


def trailing_mean_7(daily: DataFrame, value: str = "SalesOrderQty") -> DataFrame:
    """Mean of the previous 7 rows (current excluded), null -> 0."""
    w = by_sku().rowsBetween(-7, -1)
    return daily.withColumn("rolling_mean_7", F.coalesce(F.avg(value).over(w), F.lit(0.0)))


def trailing_std_7(daily: DataFrame, value: str = "SalesOrderQty") -> DataFrame:
    """Sample std over the same frame, null (fewer than 2 rows) -> 0."""
    w = by_sku().rowsBetween(-7, -1)
    return daily.withColumn("rolling_std_7",
                            F.coalesce(F.stddev_samp(value).over(w), F.lit(0.0)))


def centred_mean_7(by_day: DataFrame, value: str, order: str = "Date",
                   name: str | None = None) -> DataFrame:
    """Centred 7-row mean, null unless all 7 rows exist.

    Runs on a one-row-per-day table (bounded by the calendar, not by the
    facts), so the single ordered window is a dimension-sized job."""
    w = Window.orderBy(order).rowsBetween(-3, 3)
    name = name or f"{value}_centred_mean_7"
    return by_day.withColumn(name, F.when(F.count(value).over(w) == 7, F.avg(value).over(w)))


def last_row_per_sku(daily: DataFrame) -> DataFrame:
    """The latest row of each SKU (partial aggregate, no sort)."""
    cols = [c for c in daily.columns if c != "SkuId"]
    return (daily.groupBy("SkuId")
            .agg(F.max_by(F.struct(*cols), F.col("Date")).alias("_r"))
            .select("SkuId", "_r.*"))


def nth_from_last(daily: DataFrame, n: int = 14, value: str = "SalesOrderQty",
                  name: str = "lag_14_last") -> DataFrame:
    """The n-th row from the end of each SKU's series, or its first row
    when the series is shorter."""
    w = Window.partitionBy("SkuId").orderBy(F.desc("Date"))
    r = daily.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy("SkuId")))
    return (r.where(F.col("_rn") == F.least(F.lit(n), F.col("_n")))
            .select("SkuId", F.col(value).alias(name)))


def tail_stats(daily: DataFrame, k: int = 7, value: str = "SalesOrderQty") -> DataFrame:
    """Mean and sample std (null -> 0) of the last k rows per SKU."""
    w = Window.partitionBy("SkuId").orderBy(F.desc("Date"))
    t = daily.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return t.groupBy("SkuId").agg(
        (F.sum(value) / F.count(value)).alias("tail_mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("tail_std"))


def encode_categories(df: DataFrame, cols=("SkuId", "ProductGroup", "SubGroup")) -> dict:
    """Sorted distinct -> 0..n-1 for each column (exact, distributed).

    All columns are ranked in one pass: the distinct (column, value) pairs
    get global positions in (column, value) order, and a value's code is its
    position minus the first position of its column."""
    cols = list(cols)
    if len(cols) == 1:
        return {cols[0]: dense_codes(df, cols[0])}
    pairs = None
    for c in cols:
        t = df.select(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_val")).where(
            F.col("_val").isNotNull()).distinct()
        pairs = t if pairs is None else pairs.unionByName(t)
    ranked = global_index(pairs, ["_col", "_val"], "_i")
    first = ranked.groupBy("_col").agg(F.min("_i").alias("_f"))
    coded = ranked.join(F.broadcast(first), "_col").withColumn("_code", F.col("_i") - F.col("_f"))
    coded = coded.select("_col", "_val", "_code").checkpoint(eager=True)
    # a short code table is broadcast: its join would move every row of the facts to a few hot values
    size = {r["_col"]: r["count"] for r in coded.groupBy("_col").count().collect()}
    few = lambda t, c: F.broadcast(t) if size.get(c, 0) <= FEW_CODES else t
    return {c: few(coded.where(F.col("_col") == c).select(F.col("_val").alias(c),
                                                          F.col("_code").alias(f"{c}_enc")), c)
            for c in cols}


def encode_unseen(df: DataFrame, codes: dict) -> DataFrame:
    """Attach codes; a value not seen at fit time gets the first class
    (code 0)."""
    for c, t in codes.items():
        df = df.join(t, c, "left").withColumn(
            f"{c}_enc", F.coalesce(F.col(f"{c}_enc"), F.lit(0)).cast("bigint"))
    return df


def build_features(daily: DataFrame, codes: dict | None = None) -> DataFrame:
    """Calendar parts + lags + trailing frames + promo + category codes."""
    f = daily.withColumns(calendar_parts("Date"))
    w7 = by_sku().rowsBetween(-7, -1)
    v = "SalesOrderQty"
    f = f.withColumns({
        "lag_7": F.coalesce(F.lag(v, 7).over(by_sku()), F.lit(0.0)),
        "lag_14": F.coalesce(F.lag(v, 14).over(by_sku()), F.lit(0.0)),
        "rolling_mean_7": F.coalesce(F.avg(v).over(w7), F.lit(0.0)),
        "rolling_std_7": F.coalesce(F.stddev_samp(v).over(w7), F.lit(0.0)),
        "lag_1": F.coalesce(F.lag(v, 1).over(by_sku()), F.lit(0.0)),
    })
    codes = codes if codes is not None else encode_categories(daily)
    return encode_unseen(f, codes)


def filter_training_rows(features: DataFrame, target: str = "SalesOrderQty") -> DataFrame:
    """P25: target > 0 and no null feature."""
    return features.where(F.col(target) > 0).na.drop(
        subset=[c for c in FEATURES if c in features.columns] + [target])


def ordered_split(rows: DataFrame, fraction: float = 0.8, mode: str = "sku_date_order") -> DataFrame:
    """Mark training rows.

    * ``sku_date_order``: the first ``int(N x fraction)`` rows in (SkuId,
      Date) order (the reference's behaviour: it holds out the last SKUs).
    * ``per_sku_tail``: the first ``fraction`` of each SKU's rows.
    * ``cutoff_date``: rows dated before min + fraction x (max - min).
    """
    if mode == "sku_date_order":
        per = rows.groupBy("SkuId").agg(F.count("*").alias("_c"))
        ranked = global_index(per, ["SkuId"], "_k")
        # prefix sums over the SKU table; the partitioned window only sees
        # one range partition's SKUs at a time
        total = per.agg(F.sum("_c").alias("_N"))
        ranked = ranked.withColumn("_bucket", F.floor(F.col("_k") / 4096))
        bsum = ranked.groupBy("_bucket").agg(F.sum("_c").alias("_bs"))
        wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        boff = bsum.select("_bucket", F.coalesce(F.sum("_bs").over(wb), F.lit(0)).alias("_boff"))
        wi = Window.partitionBy("_bucket").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
        start = (ranked.join(boff, "_bucket")
                 .withColumn("_start", F.col("_boff") + F.coalesce(F.sum("_c").over(wi), F.lit(0)))
                 .select("SkuId", "_start"))
        pos = F.row_number().over(by_sku()) - 1
        r = (rows.join(start, "SkuId").crossJoin(F.broadcast(total))
             .withColumn("_pos", F.col("_start") + pos))
        return (r.withColumn("is_train", F.col("_pos") < F.floor(F.col("_N") * fraction))
                .drop("_start", "_pos", "_N"))
    if mode == "per_sku_tail":
        n = F.count(F.lit(1)).over(Window.partitionBy("SkuId"))
        return rows.withColumn("is_train", (F.row_number().over(by_sku()) - 1) < F.floor(n * fraction))
    bounds = rows.agg(F.min("Date").alias("_lo"), F.max("Date").alias("_hi"))
    cut = F.date_add(F.col("_lo"), F.floor(F.datediff("_hi", "_lo") * fraction).cast("int"))
    return (rows.crossJoin(F.broadcast(bounds)).withColumn("is_train", F.col("Date") < cut)
            .drop("_lo", "_hi"))


def forecast_errors(pred: DataFrame, actual: str = "SalesOrderQty",
                    predicted: str = "prediction") -> DataFrame:
    """RMSE and MAPE (epsilon 1e-9, in %)."""
    e = F.col(actual) - F.col(predicted)
    return pred.agg(F.sqrt(F.avg(e * e)).alias("RMSE"),
                    (F.avg(F.abs(e / (F.col(actual) + 1e-9))) * 100).alias("MAPE"),
                    F.count("*").alias("n_rows"))


def horizon_frame(daily: DataFrame, h: int = 30, codes: dict | None = None,
                  end: DataFrame | None = None) -> DataFrame:
    """SKU x next h days with the lag features frozen at the series end
    (lag_7 = last value, lag_14 = 14th from last, trailing = last 7 rows)."""
    last = last_row_per_sku(daily.select("SkuId", "Date", "SalesOrderQty", "ProductGroup",
                                         "SubGroup", "PlantId"))
    # the horizon starts after the last day of all SKUs, also for a filtered series
    end = end if end is not None else daily.agg(F.max("Date").alias("_end"))
    base = (last.join(nth_from_last(daily), "SkuId").join(tail_stats(daily), "SkuId")
            .crossJoin(F.broadcast(end)))
    fr = base.select(
        "SkuId", "ProductGroup", "SubGroup", "PlantId",
        F.col("SalesOrderQty").alias("lag_7"), F.col("lag_14_last").alias("lag_14"),
        F.col("tail_mean").alias("rolling_mean_7"), F.col("tail_std").alias("rolling_std_7"),
        F.lit(0).alias("Promotional_Flag"),
        F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"), "_end")
    fr = fr.withColumn("Date", F.date_add("_end", F.col("step"))).drop("_end")
    fr = fr.withColumns(calendar_parts("Date"))
    codes = codes if codes is not None else encode_categories(daily)
    return encode_unseen(fr, codes)


def naive_forecast(daily: DataFrame, h: int = 30) -> DataFrame:
    """Deterministic baseline forecast: the last-7-row mean carried over the
    horizon, interval mean +- 1.2816 std (10 % / 90 % normal quantiles),
    floored at 0. Same columns as the forest forecast."""
    fr = horizon_frame(daily, h, codes={})
    m, s = F.col("rolling_mean_7"), F.col("rolling_std_7")
    return fr.select("SkuId", "Date",
                     F.greatest(m, F.lit(0.0)).alias("ForecastQty"),
                     F.greatest(m - 1.2816 * s, F.lit(0.0)).alias("CI_Lower"),
                     F.greatest(m + 1.2816 * s, F.lit(0.0)).alias("CI_Upper"),
                     "ProductGroup", "SubGroup", "PlantId")


def actuals(master: DataFrame, forecast: DataFrame) -> DataFrame:
    """History rows of the forecast SKUs, renamed."""
    skus = forecast.select("SkuId").distinct()
    return (master.join(skus, "SkuId", "left_semi")
            .select("Date", "SkuId", F.col("SalesOrderQty").alias("ActualQty"), "ProductGroup"))


def sku_first_attributes(master: DataFrame) -> DataFrame:
    """First non-null plant, storage, group, sub-group per SKU (earliest
    date, ties by value)."""
    return master.groupBy("SkuId").agg(*[first_by(c).alias(c) for c in
                                         ("PlantId", "StorageLocationId", "ProductGroup",
                                          "SubGroup")])


def recent_actuals(daily: DataFrame, n: int = 90, value: str = "SalesOrderQty") -> DataFrame:
    """The last ``n`` rows of every SKU, ``rn`` 1 the latest."""
    w = Window.partitionBy("SkuId").orderBy(F.desc("Date"))
    return (daily.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
            .select("SkuId", "Date", value, "rn"))


def first_rows(rows: DataFrame, n: int = 100) -> DataFrame:
    """W13, first form: the first ``n`` rows of every SKU by date."""
    return (rows.withColumn("rn", F.row_number().over(Window.partitionBy("SkuId").orderBy("Date")))
            .where(F.col("rn") <= n))


def labelled_series(daily: DataFrame, forecast: DataFrame, n: int = 90, value: str = "SalesOrderQty") -> DataFrame:
    """The last ``n`` actual rows and the forecast of every forecast SKU as
    one series: SkuId, Date, Series ('Actual' or 'Forecast'), Qty and, for the
    forecast, its interval."""
    known = daily.join(forecast.select("SkuId").distinct(), "SkuId", "left_semi")
    none = F.lit(None).cast("double")
    past = recent_actuals(known, n, value).select("SkuId", "Date", F.lit("Actual").alias("Series"),
                                                  F.col(value).cast("double").alias("Qty"), none.alias("CI_Lower"),
                                                  none.alias("CI_Upper"))
    return past.unionByName(forecast.select("SkuId", "Date", F.lit("Forecast").alias("Series"),
                                            F.col("ForecastQty").alias("Qty"), "CI_Lower", "CI_Upper"))
