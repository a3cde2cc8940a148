"""Queries: reshaping, cleaning, signal joins, master (P01-P11, J01-J04,
E01-E02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from packflow.operators import master as M
from packflow.plans.registry import query
from packflow.sources import binding as B

SIG_CTES = {
    "sig_all": """SELECT "Date", "SkuId", SUM(units) AS "SalesOrderQty",
        ROUND(SUM(units * (1 + tax)), 2) AS "ProductionQty",
        ROUND(SUM(units * (1 - disc)), 2) AS "FactoryIssueQty" FROM fact GROUP BY 1, 2""",
    "sig_dl": """SELECT "Date", "SkuId", SUM(units) AS "DeliveryQty" FROM fact
        WHERE ls = 'F' GROUP BY 1, 2""",
    "signals": """SELECT a."Date", a."SkuId", a."SalesOrderQty", a."ProductionQty",
        COALESCE(d."DeliveryQty", 0.0) AS "DeliveryQty", a."FactoryIssueQty"
        FROM sig_all a LEFT JOIN sig_dl d ON a."Date" = d."Date" AND a."SkuId" = d."SkuId\"""",
}

WIDE_CTES = {
    "sig_plant": """SELECT "Date", "PlantId", "SkuId", SUM(units) AS v FROM fact GROUP BY 1, 2, 3""",
    "unpivoted": """SELECT dp."Date", dp."PlantId",
        'P' || (CAST(SUBSTR(dp."PlantId", 3) AS BIGINT) + s.slot) AS "SkuId", sp.v AS "SalesOrderQty"
        FROM (SELECT DISTINCT "Date", "PlantId" FROM sig_plant) dp
        CROSS JOIN range(0, 10) s(slot)
        LEFT JOIN sig_plant sp ON sp."Date" = dp."Date"
          AND sp."SkuId" = 'P' || (CAST(SUBSTR(dp."PlantId", 3) AS BIGINT) + s.slot)""",
}


def unpivoted_panel(spark, d):
    long = M.unpivot_panel(B.wide_panel(spark, d), "SalesOrderQty", ("Date", "PlantId"))
    return long.withColumn("SkuId", B.slot_sku("PlantId", "SkuId"))


@query("unpivot_panel", "Date:t, PlantId:s, SkuId:s, SalesOrderQty:x",
       "SELECT * FROM unpivoted", WIDE_CTES)
def q_unpivot_panel(spark, d):
    """P01 unpivot_panel: wide (Date x plant, one column per SKU slot) -> long."""
    return unpivoted_panel(spark, d)


@query("parse_dates", "Date:t, n_lines:i, n_bad_parsed:i",
       """SELECT TRY_CAST(CAST(l_shipdate AS VARCHAR) AS TIMESTAMP)::DATE AS "Date",
          COUNT(*) AS n_lines, COUNT(TRY_CAST(l_returnflag AS TIMESTAMP)) AS n_bad_parsed
          FROM lineitem GROUP BY 1""")
def q_parse_dates(spark, d):
    """P02 parse_dates: text dates -> date; an unparseable text -> null."""
    li = B.read_table(spark, d, "lineitem", "l_shipdate", "l_returnflag")
    t = li.select(F.col("l_shipdate").cast("string").alias("Date"),
                  F.col("l_returnflag").alias("Bad"))
    t = M.parse_dates(M.parse_dates(t, "Date"), "Bad")
    return t.groupBy("Date").agg(F.count("*").alias("n_lines"),
                                 F.count("Bad").alias("n_bad_parsed"))


@query("parse_quantities", "l_linestatus:s, qty:x, bad_as_zero:x",
       """SELECT l_linestatus, SUM(COALESCE(TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE), 0)) AS qty,
          SUM(COALESCE(TRY_CAST(l_returnflag AS DOUBLE), 0)) AS bad_as_zero
          FROM lineitem GROUP BY 1""")
def q_parse_quantities(spark, d):
    """P03 parse_quantities: text -> number, bad -> 0."""
    li = B.read_table(spark, d, "lineitem", "l_linestatus", "l_quantity", "l_returnflag")
    t = li.select("l_linestatus", F.col("l_quantity").cast("string").alias("qty"),
                  F.col("l_returnflag").alias("bad_as_zero"))
    t = M.parse_quantities(t, ["qty", "bad_as_zero"])
    return t.groupBy("l_linestatus").agg(F.sum("qty").alias("qty"),
                                         F.sum("bad_as_zero").alias("bad_as_zero"))


@query("rename_columns", "SkuId:s, ProductGroup:s, SubGroup:s",
       """SELECT 'P' || p_partkey AS "SkuId", p_type AS "ProductGroup", p_brand AS "SubGroup" FROM part""")
def q_rename_columns(spark, d):
    """P04 rename_columns: trimmed header names mapped to the unified names."""
    p = B.read_table(spark, d, "part", "p_partkey", "p_type", "p_brand")
    raw = p.select(B.sku_id("p_partkey").alias(" Node"), F.col("p_type").alias("Group "),
                   F.col("p_brand").alias(" Sub-Group "))
    return M.rename_columns(raw, {"Node": "SkuId", "Group": "ProductGroup",
                                  "Sub-Group": "SubGroup"})


@query("add_defaults", "Date:t, SkuId:s, SalesOrderQty:x, OnHandQty:x, Promotional_Flag:i, LeadTimeDays:i",
       """SELECT "Date", "SkuId", "SalesOrderQty", 0.0 AS "OnHandQty", 0 AS "Promotional_Flag",
          7 AS "LeadTimeDays" FROM signals""", SIG_CTES)
def q_add_defaults(spark, d):
    """P05 add_defaults."""
    return M.add_defaults(B.signals(spark, d)["SalesOrderQty"])


ITEM_PRICE_CTE = {"item_price": """SELECT item_id AS "SkuId", SUM(sell_price) / COUNT(sell_price)
    AS "M5_AvgPrice" FROM sell_prices GROUP BY 1"""}


def _gen_cost_sql(sku: str) -> str:
    n = f"CAST('0x' || SUBSTR(MD5({sku}), 1, 7) AS BIGINT)"
    return f"(5.0 + (({n} * 7919) % 4500) / 100.0)", f"(1.2 + (({n} * 104729) % 130) / 100.0)"


_COST, _MULT = _gen_cost_sql('p."SkuId"')


@query("add_reference_cost_price", "SkuId:s, UnitCost:d, Price:d",
       f"""SELECT p."SkuId", {_COST} AS "UnitCost", COALESCE(ip."M5_AvgPrice", {_COST} * {_MULT}) AS "Price"
       FROM (SELECT 'P' || p_partkey AS "SkuId" FROM part) p LEFT JOIN item_price ip ON p."SkuId" = ip."SkuId\"""",
       ITEM_PRICE_CTE)
def q_add_reference_cost_price(spark, d):
    """P06 add_reference_cost_price: generated cost; a known price wins."""
    from packflow.operators.finance import avg_item_price
    skus = B.sku_groups(spark, d).select("SkuId")
    known = avg_item_price(B.sell_prices(spark, d)).withColumnRenamed("M5_AvgPrice", "Price")
    return M.add_reference_cost_price(skus.join(known, "SkuId", "left"))


@query("fill_unknown_dims", "Date:t, SkuId:s, ProductGroup:s, SubGroup:s, PlantId:s, StorageLocationId:s",
       """SELECT s."Date", s."SkuId", COALESCE(g.pg, 'UNKNOWN') AS "ProductGroup",
          COALESCE(g.sg, 'UNKNOWN') AS "SubGroup", 'UNKNOWN' AS "PlantId", 'UNKNOWN' AS "StorageLocationId"
          FROM signals s LEFT JOIN (SELECT 'P' || p_partkey AS "SkuId", p_type AS pg, p_brand AS sg FROM part) g
          ON s."SkuId" = g."SkuId\"""", SIG_CTES)
def q_fill_unknown_dims(spark, d):
    """P07 fill_unknown_dims: null or absent dimensions -> 'UNKNOWN'."""
    s = B.signals(spark, d)["SalesOrderQty"].select("Date", "SkuId")
    return M.fill_unknown_dims(M.join_groups(s, B.sku_groups(spark, d)))


@query("fill_zero", "Date:t, SkuId:s, SalesOrderQty:x, DeliveryQty:x",
       """SELECT "Date", "SkuId", "SalesOrderQty", "DeliveryQty" FROM signals""", SIG_CTES)
def q_fill_zero(spark, d):
    """P08 fill_zero: delivery gaps after the left join -> 0."""
    sg = B.signals(spark, d)
    j = sg["SalesOrderQty"].join(sg["DeliveryQty"], ["Date", "SkuId"], "left")
    return M.fill_zero(j, ["DeliveryQty"])


UNIFIED_OUT = """Date:t, SkuId:s, ProductGroup:s, SubGroup:s, PlantId:s, StorageLocationId:s,
OnHandQty:x, UnitCost:d, LeadTimeDays:i, SalesOrderQty:x, ProductionQty:x, DeliveryQty:x,
FactoryIssueQty:x, Promotional_Flag:i, Price:d"""

UNIFIED_COLS = ", ".join(f'm."{c}"' for c in M.UNIFIED if c != "Promotional_Flag")

CAL_FLAG_SQL = """(SELECT "date", GREATEST("snap_CA", "snap_TX", "snap_WI") AS snap_flag,
    event_name_1, event_type_1, "month", "year" FROM calendar)"""


@query("project_unified", UNIFIED_OUT,
       f"""SELECT {UNIFIED_COLS.replace('m."Price"', 'CAST(COALESCE(c.snap_flag, 0) AS INTEGER) AS "Promotional_Flag", m."Price"')}
       FROM master m LEFT JOIN {CAL_FLAG_SQL} c ON m."Date" = c."date\"""")
def q_project_unified(spark, d):
    """P09 project_unified: the fixed 15 columns of the loaded panel."""
    m = B.master_table(spark, d)
    return M.project_unified(M.load_unified(m, B.calendar(spark, d, m)))


@query("any_state_flag", "date:t, snap_flag:i",
       """SELECT "date", GREATEST("snap_CA", "snap_TX", "snap_WI") AS snap_flag FROM calendar""")
def q_any_state_flag(spark, d):
    """P10 any_state_flag."""
    return M.any_state_flag(B.calendar(spark, d)).select("date", "snap_flag")


@query("promo_flag", "Date:t, SkuId:s, StorageLocationId:s, Promotional_Flag:i",
       f"""SELECT m."Date", m."SkuId", m."StorageLocationId", COALESCE(c.snap_flag, 0) AS "Promotional_Flag"
       FROM master m LEFT JOIN {CAL_FLAG_SQL} c ON m."Date" = c."date\"""")
def q_promo_flag(spark, d):
    """P11 promo_flag."""
    m = B.master_table(spark, d)
    c = M.any_state_flag(B.calendar(spark, d, m))
    j = M.join_calendar(m.select("Date", "SkuId", "StorageLocationId"), c, ["snap_flag"])
    return M.promo_flag(j)


@query("join_signals", "Date:t, SkuId:s, SalesOrderQty:x, ProductionQty:x, DeliveryQty:x, FactoryIssueQty:x",
       "SELECT * FROM signals", SIG_CTES)
def q_join_signals(spark, d):
    """J01 join_signals."""
    sg = B.signals(spark, d)
    return M.join_signals(sg["SalesOrderQty"], {k: v for k, v in sg.items() if k != "SalesOrderQty"})


@query("join_locations_fanout", "Date:t, SkuId:s, PlantId:s, StorageLocationId:s, SalesOrderQty:x",
       """SELECT s."Date", s."SkuId", l."PlantId", l."StorageLocationId", s."SalesOrderQty"
          FROM signals s LEFT JOIN sku_locations l ON s."SkuId" = l."SkuId\"""", SIG_CTES)
def q_join_locations_fanout(spark, d):
    """J02 join_locations_fanout: measures repeat once per location row."""
    return M.join_locations_fanout(B.signals(spark, d)["SalesOrderQty"], B.sku_locations(spark, d))


@query("join_groups", "Date:t, SkuId:s, ProductGroup:s, SubGroup:s, SalesOrderQty:x",
       """SELECT s."Date", s."SkuId", g.pg AS "ProductGroup", g.sg AS "SubGroup", s."SalesOrderQty"
          FROM signals s LEFT JOIN (SELECT 'P' || p_partkey AS "SkuId", MIN(p_type) AS pg,
          MIN(p_brand) AS sg FROM part GROUP BY 1) g ON s."SkuId" = g."SkuId\"""", SIG_CTES)
def q_join_groups(spark, d):
    """J03 join_groups (dimension keys de-duplicated first)."""
    return M.join_groups(B.signals(spark, d)["SalesOrderQty"], B.sku_groups(spark, d))


@query("join_calendar", """Date:t, SkuId:s, StorageLocationId:s, snap_CA:i, event_name_1:s,
event_type_1:s""",
       """SELECT m."Date", m."SkuId", m."StorageLocationId", c."snap_CA", c.event_name_1, c.event_type_1
          FROM master m LEFT JOIN calendar c ON m."Date" = c."date\"""")
def q_join_calendar(spark, d):
    """J04 join_calendar."""
    m = B.master_table(spark, d)
    return M.join_calendar(m.select("Date", "SkuId", "StorageLocationId"), B.calendar(spark, d, m),
                           ["snap_CA", "event_name_1", "event_type_1"])


_BCOST, _BMULT = _gen_cost_sql('s."SkuId"')


@query("build_master", UNIFIED_OUT,
       f"""SELECT s."Date", s."SkuId", COALESCE(g.pg, 'UNKNOWN') AS "ProductGroup",
          COALESCE(g.sg, 'UNKNOWN') AS "SubGroup", COALESCE(l."PlantId", 'UNKNOWN') AS "PlantId",
          COALESCE(l."StorageLocationId", 'UNKNOWN') AS "StorageLocationId", 0.0 AS "OnHandQty",
          {_BCOST} AS "UnitCost", 7 AS "LeadTimeDays", s."SalesOrderQty", s."ProductionQty",
          s."DeliveryQty", s."FactoryIssueQty", 0 AS "Promotional_Flag", {_BCOST} * {_BMULT} AS "Price"
          FROM signals s LEFT JOIN sku_locations l ON s."SkuId" = l."SkuId"
          LEFT JOIN (SELECT 'P' || p_partkey AS "SkuId", MIN(p_type) AS pg, MIN(p_brand) AS sg
                     FROM part GROUP BY 1) g ON s."SkuId" = g."SkuId\"""", SIG_CTES)
def q_build_master(spark, d):
    """E01 build_master (reference grain: signals fanned out to locations)."""
    sg = B.signals(spark, d, kept=True)
    return M.build_master(sg["SalesOrderQty"], sg["ProductionQty"], sg["DeliveryQty"],
                          sg["FactoryIssueQty"], B.sku_locations(spark, d), B.sku_groups(spark, d))


@query("load_unified", UNIFIED_OUT + ", event_name_1:s, event_type_1:s, month:i, year:i",
       f"""SELECT {UNIFIED_COLS.replace('m."Price"', 'COALESCE(c.snap_flag, 0) AS "Promotional_Flag", m."Price"')},
          c.event_name_1, c.event_type_1, c."month", c."year"
       FROM master m LEFT JOIN {CAL_FLAG_SQL} c ON m."Date" = c."date\"""")
def q_load_unified(spark, d):
    """E02 load_unified: master + calendar signals."""
    m = B.master_table(spark, d)
    u = M.load_unified(m, B.calendar(spark, d, m))
    return u.select(*M.UNIFIED, "event_name_1", "event_type_1", "month", "year")
