"""Queries: file sources and sinks (S01-S13), plus the remaining scalar /
join / report operators (P21-P23, J09, A35, T08).

Source queries write tables derived from the driver data into a fresh
folder under the shared checkpoint directory and read them back with the
library readers (a real round trip through CSV / Parquet)."""

from __future__ import annotations

from pyspark.sql import functions as F

from packflow.operators import explore as X
from packflow.operators import master as M
from packflow.operators import production as P
from packflow.operators.packs import optimize_packs
from packflow.plans.q_packs_finance import PF, _chain
from packflow.plans.q_production import (PLANT_STATS_OUT, PLANT_STATS_SQL_FULL, SKU_PLANT_OUT,
                                         UTIL_SQL, schedule_sql)
from packflow.plans.registry import query
from packflow.plans.sqlfrag import clip
from packflow.session import shared_path
from packflow.sources import binding as B
from packflow.sources import files as FS
from packflow.sources import layout as LY
from packflow.sources import manifest as MF
from packflow.sources import sinks as SK

SIGNAL_NAMES = {"SalesOrderQty": "Sales Order.csv", "ProductionQty": "Production .csv",
                "DeliveryQty": "Delivery To Distributor.csv", "FactoryIssueQty": "Factory Issue.csv"}


def _root(spark, what):
    return shared_path(spark, "io", what)


def _write_csv(df, path):
    df.write.mode("overwrite").option("header", True).csv(path)


def _write_signals(spark, d, root):
    for value, fname in SIGNAL_NAMES.items():
        _write_csv(B.wide_panel(spark, d, value), f"{root}/{fname}")


WIDE_OUT = "Date:t, PlantId:s, " + ", ".join(f"s{i}:x" for i in range(10))
SLOTS = [f"s{i}" for i in range(10)]


def _wide_sql(value: str, where: str = "") -> str:
    cols = ", ".join(f"""COALESCE(SUM({value}) FILTER (WHERE (l_partkey % 10) = {i}), 0.0e0) AS s{i}"""
                     for i in range(10))
    return f"""SELECT CAST(l_shipdate AS DATE) AS "Date", 'PL' || (l_partkey - l_partkey % 10) AS "PlantId", {cols}
        FROM (SELECT l_shipdate, l_partkey, l_quantity, l_tax, l_discount, l_linestatus, p_size
              FROM lineitem JOIN part ON l_partkey = p_partkey {where}) t GROUP BY 1, 2"""


def _parsed_wide(df):
    return M.parse_quantities(M.parse_dates(df), SLOTS)


@query("read_wide_panel", "SkuId:s, n_days:i, n_sold:i, total:x, first_sold:t, last_sold:t",
       """WITH s AS (SELECT CAST(l_shipdate AS DATE) AS dt, l_partkey AS k, SUM(l_quantity * p_size) AS q
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
          b AS (SELECT DISTINCT dt, k // 1024 AS b FROM s)
          SELECT 'P' || (b.b * 1024 + n.i) AS "SkuId", COUNT(*) AS n_days, COUNT(s.q) AS n_sold,
            COALESCE(SUM(s.q), 0.0e0) AS total, MIN(s.dt) AS first_sold, MAX(s.dt) AS last_sold
          FROM b CROSS JOIN range(0, 1024) n(i) LEFT JOIN s ON s.dt = b.dt AND s.k = b.b * 1024 + n.i
          GROUP BY 1""")
def q_read_wide_panel(spark, d):
    """S01 read_wide_panel: the daily sales panel with one column per SKU
    (1,024 of them), written as CSV and read back as lines; every cell of every
    day is parsed, then summed up per SKU."""
    root = _root(spark, "wide")
    # whole lines: a separator that no line holds
    B.wide_block_lines(spark, d).write.option("header", True).option("sep", "\x01").csv(f"{root}/Sales Order.csv")
    _write_csv(B.wide_panel(spark, d), f"{root}/weekly sales order.csv")  # a similar name: the first one is read
    cells = FS.read_signal(spark, root, "SalesOrderQty", ("Date", "Block"), together=["Block"])
    qty = F.col("SalesOrderQty")
    per = cells.groupBy("Block", "SkuId").agg(
        F.count("Date").alias("n_days"), F.count_if(qty > 0).alias("n_sold"), F.sum(qty).alias("total"),
        F.min(F.when(qty > 0, F.col("Date"))).alias("first_sold"), F.max(F.when(qty > 0, F.col("Date"))).alias("last_sold"))
    return per.withColumn("SkuId", B.block_sku())


_LONG = """SELECT w."Date", 'P' || (CAST(SUBSTR(w."PlantId", 3) AS BIGINT) + s.slot) AS "SkuId", s.slot
    FROM wide_sales w CROSS JOIN range(0, 10) s(slot)"""
_SIG_PARTS = {
    "sig_lines": """SELECT CAST(l_shipdate AS DATE) AS "Date", 'P' || l_partkey AS "SkuId",
        SUM(l_quantity * p_size) AS so, ROUND(SUM(l_quantity * p_size * (1 + l_tax)), 2) AS pr,
        SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity * p_size ELSE 0 END) AS dl,
        ROUND(SUM(l_quantity * p_size * (1 - l_discount)), 2) AS fi
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "wide_sales": """SELECT DISTINCT CAST(l_shipdate AS DATE) AS "Date", 'PL' || (l_partkey - l_partkey % 10) AS "PlantId"
        FROM lineitem""",
    "long_slots": _LONG,
}


@query("read_signals", "Date:t, SkuId:s, SalesOrderQty:x, ProductionQty:x, DeliveryQty:x, FactoryIssueQty:x",
       """SELECT l."Date", l."SkuId", COALESCE(g.so, 0.0e0) AS "SalesOrderQty", COALESCE(g.pr, 0.0e0) AS "ProductionQty",
          COALESCE(g.dl, 0.0e0) AS "DeliveryQty", COALESCE(g.fi, 0.0e0) AS "FactoryIssueQty"
          FROM long_slots l LEFT JOIN sig_lines g ON l."Date" = g."Date" AND l."SkuId" = g."SkuId\"""", _SIG_PARTS)
def q_read_signals(spark, d):
    """S02 read_signals: four wide CSVs -> J01 join of their lines -> long signals."""
    root = _root(spark, "signals")
    _write_signals(spark, d, root)
    sig = FS.read_signals(spark, root, ("Date", "PlantId"), long=False)
    long = M.join_signals(sig["SalesOrderQty"], {k: v for k, v in sig.items() if k != "SalesOrderQty"})
    return long.withColumn("SkuId", B.slot_sku("PlantId", "SkuId")).drop("PlantId")


@query("resolve_source", WIDE_OUT,
       f"""SELECT "Date", "PlantId", {", ".join(f"ROUND(s{i}, 2) AS s{i}" for i in range(10))}
       FROM ({_wide_sql("l_quantity * p_size * (1 + l_tax)")}) w""")
def q_resolve_source(spark, d):
    """S03 resolve_source: case-insensitive name match across two roots (the
    production panel is found under the second root)."""
    r1, r2 = _root(spark, "r1"), _root(spark, "r2")
    _write_csv(B.wide_panel(spark, d, "ProductionQty"), f"{r2}/PRODUCTION .CSV")
    _write_csv(B.wide_panel(spark, d, "SalesOrderQty").limit(0), f"{r1}/unrelated.csv")
    return _parsed_wide(FS.read_wide_panel(spark, FS.resolve_source([r1, r2], "production")))


@query("read_nodes", "SkuId:s", """SELECT 'P' || p_partkey AS "SkuId" FROM part""")
def q_read_nodes(spark, d):
    """S04 read_nodes."""
    path = _root(spark, "nodes")
    _write_csv(B.sku_groups(spark, d).select(F.col("SkuId").alias("Node")), path)
    return FS.read_nodes(spark, path)


@query("read_sku_locations", "SkuId:s, PlantId:s, StorageLocationId:s", "SELECT * FROM sku_locations")
def q_read_sku_locations(spark, d):
    """S05 read_sku_locations (header names padded, then trimmed)."""
    path = _root(spark, "locations")
    loc = B.sku_locations(spark, d, B.master_table(spark, d))
    _write_csv(loc.select(F.col("SkuId").alias(" Node"), F.col("PlantId").alias("Plant "),
                          F.col("StorageLocationId").alias("Storage Location")), path)
    return FS.read_sku_locations(spark, path)


@query("read_sku_groups", "SkuId:s, ProductGroup:s, SubGroup:s",
       """SELECT 'P' || p_partkey AS "SkuId", p_type AS "ProductGroup", p_brand AS "SubGroup" FROM part""")
def q_read_sku_groups(spark, d):
    """S06 read_sku_groups."""
    path = _root(spark, "groups")
    g = B.sku_groups(spark, d)
    _write_csv(g.select(F.col("SkuId").alias("Node"), F.col("ProductGroup").alias("Group"),
                        F.col("SubGroup").alias("Sub-Group")), path)
    return FS.read_sku_groups(spark, path)


@query("read_edges", "kind:s, label:s, node1:s, node2:s",
       "SELECT 'storage' AS kind, node1 AS label, node1, node2 FROM edges")
def q_read_edges(spark, d):
    """S07 read_edges(kind='storage')."""
    path = _root(spark, "edges")
    e = B.materialise(spark, "edges", d, lambda: B.storage_edges(spark, d))
    _write_csv(e.select(F.col("node1").alias("Storage Location"), "node1", "node2"), path)
    return FS.read_edges(spark, path, "storage")


@query("read_calendar", """date:t, snap_CA:i, snap_TX:i, snap_WI:i, event_name_1:s, event_type_1:s,
month:i, year:i, weekday:s, wday:i""",
       """SELECT *, DAYNAME("date") AS weekday, (EXTRACT(dow FROM "date") + 1) % 7 + 1 AS wday FROM calendar""")
def q_read_calendar(spark, d):
    """S08 read_calendar: the full layout with more columns, in another order
    and with padded names (``wday`` 1 is Saturday)."""
    path = _root(spark, "calendar")
    c = B.calendar(spark, d, B.master_table(spark, d))
    _write_csv(c.select("date", F.date_format("date", "yyyyMM").cast("int").alias("wm_yr_wk"),
                        F.date_format("date", "EEEE").alias(" weekday"),
                        (F.pmod(F.dayofweek("date"), F.lit(7)) + 1).alias("wday "), "month", "year",
                        F.dayofyear("date").alias("d"), "event_name_1", "event_type_1",
                        "snap_CA", "snap_TX", "snap_WI"), path)
    return FS.read_calendar(spark, path)


@query("read_sell_prices", "store_id:s, item_id:s, sell_price:d",
       "SELECT CAST(store_id AS VARCHAR) AS store_id, item_id, sell_price FROM sell_prices")
def q_read_sell_prices(spark, d):
    """S09 read_sell_prices: the layout with a week column, read by name."""
    path = _root(spark, "prices")
    _write_csv(B.sell_prices(spark, d).select("store_id", "item_id", F.lit(11325).alias("wm_yr_wk"),
                                              F.col("sell_price").alias(" sell_price")), path)
    return FS.read_sell_prices(spark, path)


def _history_wide(s):
    """(item_id, Date, SalesOrderQty) -> a row per item and year, a column per
    day of year. An item's days meet once, as narrow rows: the sums and the
    pivot share that shuffle."""
    w = (s.repartition("item_id").withColumn("doy", F.dayofyear("Date"))
         .groupBy("item_id", F.year("Date").alias("year"))
         .pivot("doy", list(range(1, 367))).agg(F.sum("SalesOrderQty")))
    return w.select("item_id", "year", *[F.col(str(i)).alias(f"d_{i}") for i in range(1, 367)])


def _history_series(h):
    """Counts, total and digest of each item's year, every day in order. Lists
    are gathered apart from the counts, of days with sales only (366 at most):
    with all days in one list aggregate the exploded rows are sorted and spilled."""
    per = h.groupBy("item_id", "year").agg(
        F.count("*").alias("n_days"), F.count_if(F.col("sales") == 0).alias("n_zero"), F.sum("sales").alias("total"))
    sold = h.where(F.col("sales") != 0).groupBy(F.col("item_id").alias("_i"), F.col("year").alias("_y")).agg(
        F.sort_array(F.collect_list(F.struct(F.substring("d", 3, 4).cast("int").alias("i"),
                                             F.col("sales").cast("bigint").alias("s")))).alias("e"))
    per = per.join(sold, F.col("item_id").eqNullSafe(F.col("_i")) & F.col("year").eqNullSafe(F.col("_y")), "left")
    # a day without sales is a gap between two days of the list
    before = lambda k: F.coalesce(F.get("e", k - 1)["i"], F.lit(0))
    filled = F.transform("e", lambda x, k: F.concat(F.repeat(F.lit("0,"), x["i"] - before(k) - 1), x["s"].cast("string")))
    last = F.coalesce(F.get("e", F.size("e") - 1)["i"], F.lit(0))
    series = F.concat_ws(",", filled, F.when(last < 366, F.concat(F.repeat(F.lit("0,"), 365 - last), F.lit("0"))))
    return per.select("item_id", "year", "n_days", "n_zero", "total", F.md5(series.cast("binary")).alias("series_md5"))


@query("read_sales_history", "item_id:s, year:s, n_days:i, n_zero:i, total:x, series_md5:s",
       """WITH s AS (SELECT 'P' || l_partkey AS item_id, YEAR(CAST(l_shipdate AS DATE)) AS y,
            DAYOFYEAR(CAST(l_shipdate AS DATE)) AS doy, SUM(l_quantity * p_size) AS sales
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
          h AS (SELECT k.item_id, k.y, n.i, COALESCE(s.sales, 0.0e0) AS sales
            FROM (SELECT DISTINCT item_id, y FROM s) k CROSS JOIN range(1, 367) n(i)
            LEFT JOIN s ON s.item_id = k.item_id AND s.y = k.y AND s.doy = n.i)
          SELECT item_id, CAST(y AS VARCHAR) AS "year", COUNT(*) AS n_days, COUNT(*) FILTER (WHERE sales = 0) AS n_zero,
            SUM(sales) AS total, MD5(STRING_AGG(CAST(CAST(sales AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS series_md5
          FROM h GROUP BY 1, 2""")
def q_read_sales_history(spark, d):
    """S10 read_sales_history: SKU x year rows with one column per day of year
    (``d_1``..``d_366``) written wide, read back long with every zero day. The
    result has a digest of each whole series in day order."""
    root = _root(spark, "history")
    s = B.sku_day_signals(spark, d).select(F.col("SkuId").alias("item_id"), "Date", "SalesOrderQty")
    w = _history_wide(s)
    _write_csv(w, f"{root}/sales_train_validation.csv")
    h = FS.read_sales_history(spark, root)
    return _history_series(h)


@query("empty_with_schema", "kind:s, label:s, node1:s, node2:s",
       "SELECT 'storage' AS kind, node1 AS label, node1, node2 FROM edges")
def q_empty_with_schema(spark, d):
    """S11 empty_with_schema: the plant edge table is absent, so it reads as
    an empty frame with fixed columns; unioned with the storage edges."""
    root = _root(spark, "edges2")
    e = B.materialise(spark, "edges", d, lambda: B.storage_edges(spark, d))
    _write_csv(e.select(F.col("node1").alias("Storage Location"), "node1", "node2"),
               f"{root}/Edges (Storage Location).csv")
    plant = FS.read_edges(spark, FS.resolve_source(root, "edges (plant)"), "plant")
    storage = FS.read_edges(spark, FS.resolve_source(root, "storage location"), "storage")
    return plant.unionByName(storage)


@query("write_results", "table:s, rows:i",
       """SELECT 'plant_statistics' AS "table", COUNT(DISTINCT "PlantId") AS rows FROM master UNION ALL
          SELECT 'sku_plant_averages', COUNT(*) FROM (SELECT DISTINCT "SkuId", "PlantId" FROM master) t UNION ALL
          SELECT 'daily_dates', COUNT(DISTINCT "Date") FROM master""")
def q_write_results(spark, d):
    """S12 write_results: named tables written with row counts observed
    during the write (empty tables skipped)."""
    m = B.master_table(spark, d)
    out = _root(spark, "results")
    tables = {"plant_statistics": P.plant_statistics(m), "sku_plant_averages": P.sku_plant_averages(m),
              "daily_dates": m.select("Date").distinct(), "empty": m.limit(0)}
    return SK.write_results(spark, out, tables).select("table", "rows")


@query("read_results", PLANT_STATS_OUT, PLANT_STATS_SQL_FULL)
def q_read_results(spark, d):
    """S13 read_results: plant statistics written and read back."""
    out = _root(spark, "results2")
    SK.write_results(spark, out, {"06_plant_statistics": P.plant_statistics(B.master_table(spark, d))})
    return SK.read_results(spark, out, ["06_plant_statistics"])["06_plant_statistics"]


# ---- remaining scalar / join / report operators -------------------------------------

def _sched(spark, d, reco=None):
    m = B.master_table(spark, d)
    return P.production_schedule(m, P.plant_statistics(m), reco)


@query("clip", "SkuId:s, PlantId:s, raw_score:d, clipped:d",
       f"""SELECT "SkuId", "PlantId", 1.0e0 - "FactoryIssueRate" * 10 AS raw_score,
          {clip('1.0e0 - "FactoryIssueRate" * 10', '0.0e0', '1.0e0')} AS clipped FROM ({schedule_sql(None)}) s""")
def q_clip(spark, d):
    """P21 clip: bound to [0, 1], null stays null."""
    from packflow.functions.exprs import clip as clip_
    s = _sched(spark, d)
    raw = 1.0 - F.col("FactoryIssueRate") * 10
    return s.select("SkuId", "PlantId", raw.alias("raw_score"), clip_(raw, 0.0, 1.0).alias("clipped"))


@query("row_min_of_two", "SkuId:s, PlantId:s, demand_cap:d, capacity_cap:d, row_min:d",
       f"""SELECT "SkuId", "PlantId", "AvgDailyDemand" * 1.05e0 AS demand_cap,
          "CapacitySharePerSKU" * 0.82e0 AS capacity_cap, LEAST(demand_cap, capacity_cap) AS row_min
          FROM ({schedule_sql(None)}) s""")
def q_row_min_of_two(spark, d):
    """P22 row_min_of_two."""
    s = _sched(spark, d)
    a, b = F.col("AvgDailyDemand") * 1.05, F.col("CapacitySharePerSKU") * 0.82
    return s.select("SkuId", "PlantId", a.alias("demand_cap"), b.alias("capacity_cap"),
                    F.least(a, b).alias("row_min"))


@query("bin_right_closed", "SkuId:s, PlantId:s, AvgDailyDemand:d, SchedulePriority:s",
       f"""SELECT "SkuId", "PlantId", "AvgDailyDemand", "SchedulePriority" FROM ({schedule_sql(None)}) s""")
def q_bin_right_closed(spark, d):
    """P23 bin_right_closed: (0,100], (100,500], (500,inf); outside -> null."""
    return _sched(spark, d).select("SkuId", "PlantId", "AvgDailyDemand", "SchedulePriority")


@query("join_reco_schedule", SKU_PLANT_OUT + ", VelocityClass:s, PackMultiplier:i, RecommendedPackQty:d",
       f"""SELECT "SkuId", "PlantId", "AvgDailyDemand", "AvgDailyProduction", "AvgFactoryIssue", "AvgUnitCost",
          "ProductGroup", "SubGroup", "VelocityClass", "PackMultiplier", "RecommendedPackQty"
          FROM ({schedule_sql('SELECT * FROM reco_cap')}) s""", PF)
def q_join_reco_schedule(spark, d):
    """J09 join_reco_schedule with the rule-class recommendations."""
    m, fc = _chain(spark, d)
    reco = optimize_packs(m, fc, "rule")["recommendations"]
    s = P.join_reco_schedule(P.sku_plant_averages(m), reco)
    return s.select(*[c.split(":")[0].strip() for c in SKU_PLANT_OUT.replace("\n", " ").split(",")],
                    "VelocityClass", "PackMultiplier", "RecommendedPackQty")


@query("top_plants", "PlantId:s, TargetTotalDailyProd:d, CurrentUtilisation:d, Marker:s",
       f"""SELECT "PlantId", "TargetTotalDailyProd", "CurrentUtilisation",
          CASE WHEN "CurrentUtilisation" < 0.82e0 THEN 'below 82%' ELSE 'at or above 82%' END AS "Marker"
          FROM ({UTIL_SQL}) u ORDER BY "TargetTotalDailyProd" DESC, "PlantId" LIMIT 15""")
def q_top_plants(spark, d):
    """T08 top_plants with the 82 % marker."""
    m = B.master_table(spark, d)
    ps = P.plant_statistics(m)
    u = P.plant_utilisation(ps, P.production_schedule(m, ps))
    t = u.orderBy(F.desc("TargetTotalDailyProd"), F.asc("PlantId")).limit(15)
    return t.select("PlantId", "TargetTotalDailyProd", "CurrentUtilisation",
                    F.when(F.col("CurrentUtilisation") < 0.82, "below 82%").otherwise("at or above 82%")
                    .alias("Marker"))


MASTER_TYPES = [("Date", "date"), ("SkuId", "string"), ("ProductGroup", "string"), ("SubGroup", "string"),
                ("PlantId", "string"), ("StorageLocationId", "string"), ("OnHandQty", "double"),
                ("UnitCost", "double"), ("LeadTimeDays", "int"), ("SalesOrderQty", "double"),
                ("ProductionQty", "double"), ("DeliveryQty", "double"), ("FactoryIssueQty", "double"),
                ("Promotional_Flag", "int"), ("Price", "double")]


def _fmt_sql(agg: str, c: str, t: str) -> str:
    e = f'{agg}("{c}")'
    if t in ("double", "int"):
        return f"PRINTF('%.2f', CAST({e} AS DOUBLE))"
    return f"SUBSTR(CAST({e} AS VARCHAR), 1, 10)"


_SCHEMA_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, COUNT(*) FILTER (WHERE "{c}" IS NULL) AS nulls,
        {_fmt_sql('MIN', c, t)} AS "min", {_fmt_sql('MAX', c, t)} AS "max", 'ok' AS status FROM master"""
    for c, t in MASTER_TYPES)


@query("schema_report", "column:s, dtype:s, nulls:i, min:s, max:s, status:s", _SCHEMA_SQL)
def q_schema_report(spark, d):
    """A35 schema_report of the master panel."""
    return X.schema_report(B.master_table(spark, d))


@query("master_layout", "Month:s, SkuId:s, n_rows:i, sales:x",
       """SELECT STRFTIME("Date", '%Y-%m') AS "Month", "SkuId", COUNT(*) AS n_rows, SUM("SalesOrderQty") AS sales
          FROM master WHERE "Date" >= DATE '1995-01-01' AND "Date" <= DATE '1995-06-30' GROUP BY 1, 2""")
def q_master_layout(spark, d):
    """E01 / E02 stored by month and SKU bucket, half a year of it read back."""
    import datetime as dt
    import uuid
    name = f"master_{uuid.uuid4().hex}"
    LY.save_master(B.master_table(spark, d), name, buckets=8)
    half = LY.load_master(spark, name, dt.date(1995, 1, 1), dt.date(1995, 6, 30))
    return half.groupBy(F.date_format("Date", "yyyy-MM").alias("Month"), "SkuId").agg(
        F.count("*").alias("n_rows"), F.sum("SalesOrderQty").alias("sales"))


@query("export_results", "table:s, rows:i",
       """SELECT 'plant_statistics' AS "table", COUNT(DISTINCT "PlantId") AS rows FROM master UNION ALL
          SELECT 'daily_dates', COUNT(DISTINCT "Date") FROM master""")
def q_export_results(spark, d):
    """S12 / S13 with published versions: a first version is published, a
    second run dies before it publishes, the first is what is read."""
    m = B.master_table(spark, d)
    root = _root(spark, "published")
    MF.export_results(spark, root, {"plant_statistics": P.plant_statistics(m), "daily_dates": m.select("Date").distinct()})
    SK.write_results(spark, MF.new_run(root)[1], {"daily_dates": m.select("Date").limit(1)})  # never published
    got = MF.read_current(spark, root, ["plant_statistics", "daily_dates"])
    out = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in got.items()]
    return out[0].unionByName(out[1])
