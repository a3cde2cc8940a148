"""Plan shape: pruned scans, pushed filters, no Python in the exact chain."""

from conftest import SF0001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_master_scan_is_pruned(spark):
    from packflow.sources import binding as B
    p = plan(B.master(spark, SF0001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in p
    assert "l_returnflag" not in p and "c_name" not in p and "p_name" not in p


def test_filter_reaches_scan(spark):
    from packflow.operators.explore import filter_panel
    from packflow.sources import binding as B
    p = plan(filter_panel(B.master_table(spark, SF0001), group="ECONOMY"))
    assert "PushedFilters: [IsNotNull(ProductGroup), EqualTo(ProductGroup,ECONOMY)]" in p


def test_no_python_udf_in_exact_chain(spark):
    from packflow.plans.catalog import REGISTRY
    for name in ("financial_table", "dispatch_plan", "production_schedule", "build_features"):
        p = plan(REGISTRY[name].fn(spark, SF0001))
        assert "EvalPython" not in p and "ArrowEvalPython" not in p, name


def test_fact_windows_are_partitioned(spark):
    """Row frames over the SKU x day series never gather into one partition."""
    from packflow.operators import features as FE
    from packflow.sources import binding as B
    daily = FE.daily_series(B.master_table(spark, SF0001))
    p = plan(FE.trailing_std_7(FE.trailing_mean_7(FE.lag_features(daily))))
    assert "SinglePartition" not in p
    assert "Window" in p and "hashpartitioning(SkuId" in p


def test_master_has_no_single_partition(spark):
    from packflow.sources import binding as B
    assert "SinglePartition" not in plan(B.master(spark, SF0001))


def test_master_lines_meet_parts_in_one_shuffle(spark):
    """The aggregate and the part join share one shuffle of the lines."""
    from packflow.sources import binding as B
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(B.master(spark, SF0001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert p.count("Exchange hashpartitioning(l_partkey") == 1
    assert p.count("Exchange hashpartitioning(Date") == 0


def test_salted_parts_are_not_broadcast(spark, tmp_path):
    """Parts repeated for each salt never go through the driver, however few bytes their file has."""
    from packflow.sources import binding as B
    rows = {"lineitem": "SELECT 1L l_orderkey, 11L l_partkey, 1L l_suppkey, 2.0D l_quantity, 9.0D l_extendedprice, 0.1D l_discount, "
                        "0.1D l_tax, 'F' l_linestatus, TIMESTAMP'2020-01-05 00:00:00' l_shipdate",
            "orders": "SELECT 1L o_orderkey, 5L o_custkey", "customer": "SELECT 5L c_custkey, 3 c_nationkey",
            "part": "SELECT 11L p_partkey, 'T' p_type, 'B' p_brand, 4 p_size, 2.5D p_retailprice"}
    for name, sql in rows.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    for df in (B.master(spark, str(tmp_path)).select("Date").distinct(), B.sku_day_signals(spark, str(tmp_path)).select("Date", "SkuId")):
        p = plan(df)
        assert "SortMergeJoin [l_partkey" in p and not any("p_salt" in x for x in p.splitlines() if "BroadcastHashJoin" in x)
        assert [str(r["Date"]) for r in df.collect()] == ["2020-01-05"]


def test_build_master_repeats_no_work(spark):
    """The lines are read once for all signals and once for the locations, and what a SKU alone
    decides is made below the join that repeats its rows for each location."""
    from packflow.plans.catalog import REGISTRY
    p = plan(REGISTRY["build_master"].fn(spark, SF0001))
    assert p.count("lineitem.parquet") == 1  # of the locations; the signals are read from their own table
    above = p[:p.index("Join")]
    assert "md5" in p and "md5" not in above


def test_build_master_joins_as_before(spark):
    """Rows without a location, a group or a key stay, and each location repeats the measures."""
    from packflow.operators.master import build_master
    sales = spark.sql("SELECT * FROM VALUES (DATE'2020-01-01', 'P1', 5.0D), (DATE'2020-01-01', 'P2', 2.0D), "
                      "(DATE'2020-01-02', NULL, 1.0D) t(Date, SkuId, SalesOrderQty)")
    bridge = spark.sql("SELECT * FROM VALUES ('P1', 'PL0', 'SL1'), ('P1', 'PL0', 'SL2'), (NULL, 'PL9', 'SL9') t(SkuId, PlantId, StorageLocationId)")
    groups = spark.sql("SELECT * FROM VALUES ('P1', 'G', 'S'), ('P1', 'G', 'R') t(SkuId, ProductGroup, SubGroup)")
    got = build_master(sales, None, None, None, bridge, groups).collect()
    assert sorted((r["SkuId"] or "", r["ProductGroup"], r["SubGroup"], r["PlantId"], r["StorageLocationId"], r["SalesOrderQty"], r["LeadTimeDays"])
                  for r in got) == [("", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", 1.0, 7), ("P1", "G", "R", "PL0", "SL1", 5.0, 7),
                                    ("P1", "G", "R", "PL0", "SL2", 5.0, 7), ("P2", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN", 2.0, 7)]
    cost = {r["SkuId"]: (r["UnitCost"], r["Price"]) for r in got}
    assert cost["P1"][0] >= 5 and cost["P1"][1] >= cost["P1"][0] and cost[None] == (0.0, 0.0)


def test_history_days_meet_once(spark):
    """No shuffle carries a column for each day of the year."""
    from packflow.plans.q_sources import _history_wide
    rows = spark.sql("SELECT 'P1' AS item_id, DATE'2020-12-31' AS Date, 2.0D AS SalesOrderQty")
    p = plan(_history_wide(rows))
    assert p.count("Exchange ") == 1
