"""Wide files: any number of columns, both layouts, quoted and short lines."""

import datetime as dt

import pytest

from packflow.operators import master as M
from packflow.sources import files as FS
from packflow.sources.wide import read_wide_lines


def _write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_fifty_thousand_columns_in_one_stage(spark, tmp_path):
    n = 50_000
    names = [f"SKU{i}.{i % 3}" for i in range(n)]
    days = [dt.date(2023, 1, 1) + dt.timedelta(k) for k in range(12)]
    _write(tmp_path / "Sales Order.csv", "Date," + ",".join(names),
           *[f"{d}," + ",".join(str((i * 7 + k) % 11) for i in range(n)) for k, d in enumerate(days)])
    long = FS.read_signal(spark, str(tmp_path), "SalesOrderQty")
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Generate") == 1 and len(long.columns) == 3
    got = long.groupBy("Date").agg({"SalesOrderQty": "sum", "SkuId": "count"}).collect()
    want = {d: (float(sum((i * 7 + k) % 11 for i in range(n))), n) for k, d in enumerate(days)}
    assert {r["Date"]: (r["sum(SalesOrderQty)"], r["count(SkuId)"]) for r in got} == want
    some = FS.read_wide(spark, str(tmp_path / "Sales Order.csv")).columns(["SKU49999.1", "SKU0.0"]).collect()
    assert {(r["Date"], r["SKU49999.1"], r["SKU0.0"]) for r in some} == {
        (str(d), str((49_999 * 7 + k) % 11), str(k % 11)) for k, d in enumerate(days)}


def test_both_layouts_agree(spark, tmp_path):
    """One column per SKU, and id columns with slots, give the same long rows."""
    _write(tmp_path / "a/production.csv", "Date,P0,P1,P2,P3", "2023-01-01,1,2,3,4", "2023-01-02,5,,x,8")
    _write(tmp_path / "b/production.csv", "Date,Block,s0,s1", "2023-01-01,0,1,2", "2023-01-01,1,3,4",
           "2023-01-02,0,5,", "2023-01-02,1,x,8")
    by_sku = FS.read_signal(spark, str(tmp_path / "a"), "ProductionQty").collect()
    slots = FS.read_signal(spark, str(tmp_path / "b"), "ProductionQty", ("Date", "Block")).collect()
    a = {(r["Date"], r["SkuId"], r["ProductionQty"]) for r in by_sku}
    b = {(r["Date"], f"P{int(r['Block']) * 2 + int(r['SkuId'][1:])}", r["ProductionQty"]) for r in slots}
    assert a == b and len(a) == 8


def test_quoted_short_and_blank_lines(spark, tmp_path):
    _write(tmp_path / "x/delivery.csv", "Day , A.1,\"B,2\",C", "2023-01-01,1,\"2,5\",3", "2023-01-02,\"4\"\"\",,",
           "", "2023-01-03,7")
    new = {tuple(r) for r in FS.read_wide(spark, str(tmp_path / "x/delivery.csv")).long("v").collect()}
    assert new == {
        ("2023-01-01", "A.1", "1"), ("2023-01-01", "B,2", "2,5"), ("2023-01-01", "C", "3"), ("2023-01-02", "A.1", '4"'),
        ("2023-01-02", "B,2", None), ("2023-01-02", "C", None), ("2023-01-03", "A.1", "7"),
        ("2023-01-03", "B,2", None), ("2023-01-03", "C", None)}


def test_agrees_with_the_column_reader(spark, tmp_path):
    _write(tmp_path / "x/delivery.csv", "Date,A.1,B", "2023-01-01,1, 2", "2023-01-02,,x")
    old = M.unpivot_panel(FS.read_wide_panel(spark, str(tmp_path / "x/delivery.csv")), "v").collect()
    new = FS.read_wide(spark, str(tmp_path / "x/delivery.csv")).long("v").collect()
    assert {tuple(r) for r in new} == {tuple(r) for r in old}


def test_scattered_ids_and_folders(spark, tmp_path):
    """Ids between values; every file of a folder has the header."""
    for k in range(3):
        _write(tmp_path / f"h/part-{k}.csv", "d_1,item,d_2", f"{k},I{k},{k + 10}")
    got = read_wide_lines(spark, str(tmp_path / "h"), ["item"]).long("sales", "d").collect()
    assert {tuple(r) for r in got} == {(f"I{k}", d, str(v)) for k in range(3) for d, v in (("d_1", k), ("d_2", k + 10))}


@pytest.mark.parametrize("lines, rows", [((), None), (("Date",), 0), (("Date,A",), 0), (("Date", "2023-01-01"), 0)])
def test_nothing_to_read(spark, tmp_path, lines, rows):
    if lines:
        _write(tmp_path / "w.csv", *lines)
    got = read_wide_lines(spark, str(tmp_path / "w.csv"), ["Date"])
    assert got is None if rows is None else got.long("v").count() == rows


def test_history_series_gaps(spark):
    """First and last day, gaps, a year without sales and a null year."""
    import hashlib

    from packflow.plans.q_sources import _history_series, _history_wide
    rows = spark.sql("""SELECT * FROM VALUES ('a', DATE'2020-01-01', 3.0D), ('a', DATE'2020-12-31', 4.0D),
        ('a', DATE'2020-01-04', 5.0D), ('b', DATE'2021-02-01', 0.0D), ('b', DATE'2022-12-31', 7.0D),
        ('b', CAST(NULL AS DATE), 1.0D) AS t(item_id, Date, SalesOrderQty)""")
    wide = _history_wide(rows)
    long = wide.unpivot(["item_id", "year"], [c for c in wide.columns if c.startswith("d_")], "d", "sales").na.fill(0.0, ["sales"])
    got = {(r["item_id"], r["year"]): r for r in _history_series(long).collect()}
    days = {("a", 2020): {1: 3, 4: 5, 366: 4}, ("b", 2021): {}, ("b", 2022): {365: 7}, ("b", None): {}}
    assert set(got) == set(days)
    for k, sold in days.items():
        text = ",".join(str(sold.get(i, 0)) for i in range(1, 367))
        assert got[k]["series_md5"] == hashlib.md5(text.encode()).hexdigest()
        assert (got[k]["n_days"], got[k]["n_zero"], got[k]["total"]) == (366, 366 - len(sold), sum(sold.values()))


def test_history_lists_hold_sold_days_only(spark):
    """The list aggregate reads the days with sales, not every day."""
    from packflow.plans.q_sources import _history_series
    rows = spark.range(732).selectExpr("'a' AS item_id", "CAST(id DIV 366 AS STRING) AS year",
                                       "concat('d_', id % 366 + 1) AS d", "CAST(id % 3 AS DOUBLE) AS sales")
    p = _history_series(rows)._jdf.queryExecution().optimizedPlan().toString()
    lists = [x for x in p.splitlines() if "collect_list" in x]
    assert len(lists) == 1 and "count" not in lists[0]
