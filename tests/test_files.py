"""File readers: columns by name, first match, a run from a folder of CSVs."""

import datetime as dt
import os

import pytest

from packflow.config import ForecastConfig
from packflow.operators import explore as X
from packflow.operators import master as M
from packflow.operators.ranking import exact_quantiles
from packflow.plans.pipeline import RESULT_TABLES, run_pipeline
from packflow.sources import files as FS

DAYS = [dt.date(2023, 1, 1) + dt.timedelta(i) for i in range(60)]
SKUS = ["A1", "A2", "B.1"]


def _put(root, name, *lines):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _panel(scale):
    return ["Date," + ",".join(SKUS), *[
        f"{d}," + ",".join(str(scale * (10 * (j + 1) + i % 7)) for j in range(len(SKUS))) for i, d in enumerate(DAYS)]]


def test_prices_by_name(spark, tmp_path):
    _put(tmp_path, "sell_prices.csv", "wm_yr_wk, sell_price,item_id,store_id", "11325,9.58,I_1,S1", "11326,x,I_2,S1")
    rows = FS.read_sell_prices(spark, FS.resolve_source(str(tmp_path), "sell_prices")).collect()
    assert sorted((r.store_id, r.item_id, r.sell_price) for r in rows) == sorted(
        [("S1", "I_1", 9.58), ("S1", "I_2", None)], key=str)


def test_prices_without_required_column(spark, tmp_path):
    _put(tmp_path, "sell_prices.csv", "store_id,item_id,price", "S1,I_1,9.58")
    with pytest.raises(ValueError, match="sell_price"):
        FS.read_sell_prices(spark, str(tmp_path / "sell_prices.csv"))


def test_calendar_by_name(spark, tmp_path):
    _put(tmp_path, "calendar.csv", "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,snap_CA",
         "2011-01-29,11101,Saturday,1,1,2011,d_1,,,1")
    r = FS.read_calendar(spark, str(tmp_path / "calendar.csv")).first()
    assert (r.date, r.weekday, r.wday, r.month, r.year) == (dt.date(2011, 1, 29), "Saturday", 1, 1, 2011)
    assert (r.snap_CA, r.snap_TX, r.event_name_1) == (1, None, None)


def test_first_match_only(spark, tmp_path):
    _put(tmp_path, "b/Production plan.csv", "Date,B,A", "2023-01-01,1,2")
    _put(tmp_path, "b/PRODUCTION .csv", "Date,A,B", "2023-01-01,3,4")
    _put(tmp_path, "a/other.csv", "x", "1")
    roots = [str(tmp_path / "a"), str(tmp_path / "b")]
    wide = FS.read_wide_panel(spark, FS.resolve_source(roots, "production"))
    assert [tuple(r) for r in wide.collect()] == [("2023-01-01", "3", "4")]
    assert FS.read_wide_panel(spark, FS.resolve_source(roots, "delivery")) is None


def test_missing_sales_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="sales order"):
        FS.load_panel(spark, str(tmp_path))


def test_run_from_folder(spark, tmp_path):
    unit = "Temporal Data/Unit"
    for name, scale in (("Sales Order", 1), ("Production ", 1.5), ("Delivery To distributor", 1), ("Factory Issue", 1)):
        _put(tmp_path, f"{unit}/{name}.csv", *_panel(scale))
    _put(tmp_path, "Nodes/Nodes.csv", "Node", *SKUS)
    _put(tmp_path, "Nodes/Node Types (Plant and Storage).csv", "Node, Plant,Storage Location ",
         "A1,P1,L1", "A2,P1,L2", "B.1,P2,L3")
    _put(tmp_path, "Nodes/Node Types (Product Group and Subgroup).csv", "Node,Group,Sub-Group",
         "A1,G1,S1", "A2,G1,S2", "B.1,G2,S3")
    _put(tmp_path, "Edges/Edges (Storage Location).csv", "Storage Location,node1,node2", "x,L1,L2", "x,L2,L3")
    got = FS.load_panel(spark, str(tmp_path))
    m = got["master"]
    assert m.count() == len(DAYS) * len(SKUS)
    assert {r[0] for r in m.select("PlantId").distinct().collect()} == {"P1", "P2"}
    assert got["prices"] is None and got["edges"]["plant"].count() == 0
    res = run_pipeline(spark, filters={"horizon_days": 3}, classes="rule", master=m.checkpoint(),
                       forecast_cfg=ForecastConfig(num_trees=5, max_depth=3),
                       edges=got["edges"]["storage"], out_dir=str(tmp_path / "out"))
    out = {r["table"]: r["rows"] for r in res["exported"].collect()}
    assert set(out) == set(RESULT_TABLES)
    assert out["01_demand_forecast"] == 3 * len(SKUS) and out["09_routing_paths"] == 6
    assert spark.read.parquet(str(tmp_path / "out/10_pipeline_summary_kpis")).count() == out["10_pipeline_summary_kpis"]


def test_missing_quantiles_keep_rows(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", 5.0, None)], "g string, x double, y double")
    d = {r["column"]: r for r in X.describe_panel(df, ["x", "y"]).collect()}
    assert d["x"].p50 == 3.0 and d["y"]["count"] == 0 and d["y"].p50 is None
    m = spark.createDataFrame([("s", 1.0), ("t", 2.0)], "SkuId string, SalesOrderQty double")
    assert X.demand_cv(m).count() == 2
    box = {r.g: r for r in X.box_statistics(df.withColumnRenamed("y", "z"), "g", "z").collect()}
    assert set(box) == {"a", "b"} and box["a"].median is None


def test_hot_value_is_one_row_of_the_sort(spark):
    df = spark.range(5000).selectExpr("if(id % 10 = 0, cast(id as double), 0D) as v", "'g' as g")
    plan = exact_quantiles(df, "v", [0.0, 0.5, 0.95, 1.0], "g")
    got = {r.p: r.q for r in plan.collect()}
    import numpy as np
    v = np.where(np.arange(5000) % 10 == 0, np.arange(5000), 0).astype(float)
    assert got == pytest.approx({p: float(np.percentile(v, p * 100)) for p in (0.0, 0.5, 0.95, 1.0)})


def test_generated_cost_uses_whole_id(spark):
    ids = spark.range(40).selectExpr("concat('POF00', id % 4, 'L', id, 'P') as SkuId")
    assert M.add_reference_cost_price(ids).select("UnitCost").distinct().count() >= 38
