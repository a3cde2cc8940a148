"""Row frames on short series: one-day SKU, 7-day and 15-day SKUs."""

import datetime as dt

from packflow.operators import features as FE


def series(spark):
    rows = []
    for sku, n in (("A", 1), ("B", 7), ("C", 15)):
        for i in range(n):
            rows.append((sku, dt.date(2023, 1, 1) + dt.timedelta(days=i), float(i + 1)))
    return spark.createDataFrame(rows, "SkuId string, Date date, SalesOrderQty double")


def test_lags_and_trailing_frames(spark):
    f = FE.trailing_std_7(FE.trailing_mean_7(FE.lag_features(series(spark)))).collect()
    by = {(r.SkuId, r.Date.day): r for r in f}
    assert by[("A", 1)].rolling_mean_7 == 0.0 and by[("A", 1)].rolling_std_7 == 0.0
    assert by[("B", 2)].rolling_std_7 == 0.0          # one value in the frame -> std null -> 0
    assert by[("C", 15)].lag_14 == 1.0 and by[("C", 15)].lag_7 == 8.0
    assert by[("C", 9)].rolling_mean_7 == sum(range(2, 9)) / 7


def test_tail_nth_and_last(spark):
    d = series(spark)
    nth = {r.SkuId: r.lag_14_last for r in FE.nth_from_last(d).collect()}
    assert nth == {"A": 1.0, "B": 1.0, "C": 2.0}
    tail = {r.SkuId: r for r in FE.tail_stats(d).collect()}
    assert tail["A"].tail_std == 0.0 and tail["C"].tail_mean == sum(range(9, 16)) / 7
    last = {r.SkuId: r.SalesOrderQty for r in FE.last_row_per_sku(d).collect()}
    assert last == {"A": 1.0, "B": 7.0, "C": 15.0}


def test_ordered_split_modes(spark):
    d = series(spark)
    rows = FE.ordered_split(d, 0.8, "sku_date_order").collect()
    train = sorted((r.SkuId, r.Date) for r in rows if r.is_train)
    assert len(train) == int(23 * 0.8)
    assert all(r.SkuId in ("A", "B", "C") for r in rows)
    assert max(train)[0] == "C"   # the held-out rows are the last SKU's tail
