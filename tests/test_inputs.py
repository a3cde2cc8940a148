"""Derived inputs and joins of wide lines: equal rows by narrower plans."""

import pytest
from pyspark.sql import functions as F

from packflow.operators import master as M
from packflow.operators import network as N
from packflow.operators import packs as PK
from packflow.sources import binding as B
from packflow.sources import files as FS

SF0001 = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")


def test_lines_join_as_their_cells(spark, tmp_path):
    """Repeated lines, bad dates, other column orders, absent columns and an absent file."""
    write(tmp_path / "sales order.csv", "Date,Plant,a,b", "2020-01-01,P,1,2", "2020-01-01,P,5,x", "bad,P,7,8", "2020-01-02,P,,4",
          "2020-01-03,,1,1")
    write(tmp_path / "production.csv", "Date,Plant,b,c,a", "2020-01-01,P,10,20,30", "2020-01-01,P,11,21,31", "bad,P,1,1,1",
          "2020-01-03,,6,6,6")
    write(tmp_path / "delivery.csv", "Date,Plant,a", "2020-01-02,P,9", "2020-01-04,P,9")
    ids = ("Date", "Plant")
    lines = FS.read_signals(spark, str(tmp_path), ids, long=False)
    others = {k: v for k, v in lines.items() if k != "SalesOrderQty"}
    got = M.join_signals(lines["SalesOrderQty"], others)
    assert "Generate" in plan_of(got) and plan_of(got).count("Generate") == 1  # cells arise after the joins
    cells = FS.read_signals(spark, str(tmp_path), ids)
    want = cells["SalesOrderQty"]
    for k in others:
        want = want.withColumn(k, F.lit(0.0)) if cells[k] is None else want.join(cells[k], [*ids, "SkuId"], "left")
    same_rows(got, want.na.fill(0.0, subset=list(others)).select(*got.columns))
    assert got.count() == 2 * 2 * 2 + 6


def test_repeated_names_are_refused(spark, tmp_path):
    write(tmp_path / "sales order.csv", "Date,a,a", "2020-01-01,1,2")
    lines = FS.read_signals(spark, str(tmp_path), long=False)
    with pytest.raises(ValueError):
        M.join_signals(lines["SalesOrderQty"], {})


def test_lines_brought_together(spark, tmp_path):
    """Equal cells, and sums by (block, SKU) without a shuffle of cells."""
    write(tmp_path / "sales order.csv", "Date,Block,a,b", *[f"2020-01-0{1 + i % 9},{i % 3},{i},\"{i}\"" for i in range(30)])
    args = (spark, str(tmp_path), "SalesOrderQty", ("Date", "Block"))
    near = FS.read_signal(*args, together=["Block"])
    same_rows(near, FS.read_signal(*args))
    assert plan_of(near.groupBy("Block", "SkuId").agg(F.sum("SalesOrderQty"))).count("Exchange") == 1


def test_bridge_and_deliveries_read_few_columns(spark):
    m = B.master_table(spark, SF0001)
    bridge = B.sku_locations(spark, SF0001)
    same_rows(bridge, B.sku_locations(spark, SF0001, m).select(*bridge.columns))
    assert "l_shipdate" not in plan_of(bridge)
    dl = B.deliveries(spark, SF0001)
    same_rows(dl, m.select(*dl.columns))
    assert "l_extendedprice" not in plan_of(dl)


def test_endpoint_means_only(spark):
    """SKU endpoints count too; keys that end no edge are not summed up."""
    m = spark.createDataFrame([("P1", "SL1", 4.0), ("P1", "SL2", 2.0), ("P2", "SL2", 8.0)],
                              "SkuId string, StorageLocationId string, DeliveryQty double")
    e = spark.createDataFrame([("SL1", "SL2"), ("P1", "SL2"), ("SL1", "X"), ("SL1", None)], "node1 string, node2 string")
    w = N.network_edges(m, e)
    got = {(r["a"], r["b"]): r["weight"] for r in w.collect()}
    assert got == {("SL1", "SL2"): 1 / 5.5, ("P1", "SL2"): 1 / 5.0, ("SL1", "X"): 1 / 3.0}
    assert "LeftSemi" in plan_of(w)


def test_profile_is_written_once(spark):
    m = B.master_table(spark, SF0001)
    fc = m.groupBy("SkuId").agg(F.max("SalesOrderQty").alias("ForecastQty"))
    reco = PK.optimize_packs(m, fc, "rule")["recommendations"]
    assert "SalesOrderQty" not in plan_of(reco)  # the panel's demand is not read again


def test_pipeline_summary_stores_shared_steps(spark, monkeypatch):
    from packflow.plans import q_models as Q
    from packflow.plans.catalog import REGISTRY
    names, stored = [], Q._stored
    monkeypatch.setattr(Q, "_stored", lambda df, name: names.append(name) or stored(df, name))
    assert REGISTRY["pipeline_summary"].fn(spark, SF0001).columns == ["Metric", "Value"]
    assert names == ["forecast", "reco", "plan", "plants", "schedule", "rows"]


def test_wide_panel_cells(spark):
    """Equal to the series of the SKUs, by one shuffle of lines and one of cells."""
    w = B.wide_panel(spark, SF0001, "DeliveryQty")
    s = B.sku_day_signals(spark, SF0001).where("n_f > 0")
    cells = w.unpivot(["Date", "PlantId"], [f"s{i}" for i in range(10)], "slot", "v").where("v is not null")
    same_rows(cells.select("Date", B.slot_sku("PlantId", "slot").alias("SkuId"), "v"), s.select("Date", "SkuId", F.col("DeliveryQty").alias("v")))
    assert "pivotfirst" not in plan_of(w)
