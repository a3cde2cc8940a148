"""Binding of the driver tables to the supply-chain panel.

A part is a SKU (its size is the pack size, so units = quantity x size), ten
neighbouring part keys share a plant, the customer's nation is the storage
location and the supplier's nation the shipping origin.

Plan shape (what a 100 TB run does):

* ``lineitem`` is shuffled once, on ``l_orderkey``, to meet ``orders``
  (which met ``customer`` on ``o_custkey`` first, so only the order-sized
  side is shuffled twice). Co-bucketing both on the order key removes that
  shuffle when the tables are stored bucketed.
* The lines are aggregated to (day, part, nation) *before* the part
  attributes are joined: every part attribute is constant per part, and the
  unit sums factor as ``size * sum(quantity)``. Lines meet on (part, salt), the
  salt being one of ``SALTS`` by day and nation: that one shuffle serves both
  the aggregate and the part join (whose small side is repeated for each salt),
  and a hot part is spread over as many tasks. Few lines share a (day, part,
  nation), so partial sums before the shuffle would be wider than the lines.
* No broadcast hints on data-sized tables: AQE switches a join to broadcast
  only when the runtime size is under ``autoBroadcastJoinThreshold``. The parts
  that are repeated for each salt are merged (``salted``): their estimate, from
  the compressed file and a few columns of it, knows nothing of the repeats, and
  the driver would collect them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packflow.sources.tables import read_table

SALTS = 4  # tasks that a part's lines are spread over


def sku_id(partkey) -> F.Column:
    return F.concat(F.lit("P"), F.col(partkey).cast("string"))


def plant_id(partkey) -> F.Column:
    pk = F.col(partkey)
    return F.concat(F.lit("PL"), (pk - F.pmod(pk, F.lit(10))).cast("string"))


def location_id(nation) -> F.Column:
    return F.concat(F.lit("SL"), F.col(nation).cast("string"))


def order_nations(spark: SparkSession, d: str) -> DataFrame:
    """order key -> customer nation (orders-sized)."""
    o = read_table(spark, d, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, d, "customer", "c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_nationkey")


def line_facts(spark: SparkSession, d: str, with_supplier: bool = False) -> DataFrame:
    """Lines with their destination nation (and origin nation on request)."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
                    "l_tax", "l_linestatus")
    on = order_nations(spark, d)
    lf = li.join(on, li.l_orderkey == on.o_orderkey)
    if with_supplier:
        s = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
        lf = lf.join(s, lf.l_suppkey == s.s_suppkey)
    return lf


def parts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part", "p_partkey", "p_type", "p_brand", "p_size",
                      "p_retailprice")


def salted(p: DataFrame) -> DataFrame:
    """Parts once for each salt, to be merged with lines that lie by (part, salt)."""
    return p.withColumn("p_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")


def master(spark: SparkSession, d: str) -> DataFrame:
    """The unified 15-column panel at (Date, SKU, plant, storage) grain."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_shipdate", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_linestatus")
    li = li.where(F.col("l_partkey").isNotNull()).select(
        "l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("Date"), "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", (F.col("l_linestatus") == "F").alias("is_f"))
    on = order_nations(spark, d)
    lf = li.join(on, li.l_orderkey == on.o_orderkey).select(
        *[c for c in li.columns if c != "l_orderkey"], "c_nationkey",
        F.pmod(F.xxhash64("Date", "c_nationkey"), F.lit(SALTS)).cast("int").alias("salt"))
    q = F.col("l_quantity")
    agg = (lf.repartition("l_partkey", "salt").groupBy("l_partkey", "salt", "Date", "c_nationkey")
           .agg(F.sum(q).alias("q"),
                F.sum(q * (1 + F.col("l_tax"))).alias("q_tax"),
                F.sum(F.when(F.col("is_f"), q).otherwise(0.0)).alias("q_f"),
                F.sum(q * (1 - F.col("l_discount"))).alias("q_disc"),
                F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("rev")))
    p = salted(parts(spark, d))
    j = agg.join(p, (agg.l_partkey == p.p_partkey) & (agg.salt == p.p_salt))
    size = F.col("p_size")
    units = F.col("q") * size
    return j.select(
        F.col("Date"),
        sku_id("l_partkey").alias("SkuId"),
        F.col("p_type").alias("ProductGroup"),
        F.col("p_brand").alias("SubGroup"),
        plant_id("l_partkey").alias("PlantId"),
        location_id("c_nationkey").alias("StorageLocationId"),
        F.lit(0.0).alias("OnHandQty"),
        F.col("p_retailprice").alias("UnitCost"),
        F.lit(7).alias("LeadTimeDays"),
        units.alias("SalesOrderQty"),
        F.round(F.col("q_tax") * size, 2).alias("ProductionQty"),
        (F.col("q_f") * size).alias("DeliveryQty"),
        F.round(F.col("q_disc") * size, 2).alias("FactoryIssueQty"),
        F.when(F.dayofmonth("Date") <= 10, 1).otherwise(0).alias("Promotional_Flag"),
        (F.col("rev").cast("double") / units).alias("Price"),
    )


def calendar(spark: SparkSession, d: str, m: DataFrame | None = None) -> DataFrame:
    """Calendar over the days that carry facts: state flags, events, parts."""
    m = m if m is not None else master(spark, d)
    dd = F.col("date")
    day, mon = F.dayofmonth(dd), F.month(dd)
    return (m.select(F.col("Date").alias("date")).distinct()
            .select(
                dd,
                F.when(day <= 10, 1).otherwise(0).alias("snap_CA"),
                F.when((day <= 15) & (day % 2 == 1), 1).otherwise(0).alias("snap_TX"),
                F.when(day.between(2, 15) & (day % 3 != 1), 1).otherwise(0).alias("snap_WI"),
                F.when((mon == 12) & (day == 25), "WinterHoliday")
                 .when((mon == 7) & (day == 4), "SummerHoliday")
                 .when((mon == 2) & (day == 1), "SportFinal").alias("event_name_1"),
                F.when((mon == 12) & (day == 25), "National")
                 .when((mon == 7) & (day == 4), "National")
                 .when((mon == 2) & (day == 1), "Sporting").alias("event_type_1"),
                mon.alias("month"),
                F.year(dd).alias("year"),
            ))


def sell_prices(spark: SparkSession, d: str) -> DataFrame:
    """Item x store prices of every sold line."""
    li = read_table(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_extendedprice",
                    "l_quantity")
    p = read_table(spark, d, "part", "p_partkey", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(F.col("l_suppkey").alias("store_id"), sku_id("l_partkey").alias("item_id"),
                    (F.col("l_extendedprice") / (F.col("l_quantity") * F.col("p_size")))
                    .alias("sell_price"))


def typed_prices(spark: SparkSession, d: str) -> DataFrame:
    """The prices under item ids of the form ``type_item``."""
    t = read_table(spark, d, "part", "p_partkey", "p_type").select(sku_id("p_partkey").alias("item_id"), "p_type")
    return sell_prices(spark, d).join(t, "item_id").select(
        "store_id", F.concat_ws("_", "p_type", "item_id").alias("item_id"), "sell_price")


def sku_locations(spark: SparkSession, d: str, m: DataFrame | None = None) -> DataFrame:
    """Bridge SKU -> plant, location: of a given panel, else from the lines
    alone (part and nation pairs, without the days and measures of the panel)."""
    if m is not None:
        return m.select("SkuId", "PlantId", "StorageLocationId").distinct()
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_partkey").where(F.col("l_partkey").isNotNull())
    on = order_nations(spark, d)
    pairs = li.join(on, li.l_orderkey == on.o_orderkey).select("l_partkey", "c_nationkey").distinct()
    p = read_table(spark, d, "part", "p_partkey")
    return pairs.join(p, pairs.l_partkey == p.p_partkey, "left_semi").select(
        sku_id("l_partkey").alias("SkuId"), plant_id("l_partkey").alias("PlantId"),
        location_id("c_nationkey").alias("StorageLocationId"))


def storage_edges(spark: SparkSession, d: str) -> DataFrame:
    """Undirected location edges: nations of one region with traffic between
    them (regions stay apart, so some pairs are unreachable). Output: node1 < node2."""
    # (supplier, nation) pairs: lines go no further than the task that met their order
    met = line_facts(spark, d).select("l_suppkey", "c_nationkey").distinct()
    s = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    lf = met.join(s, met.l_suppkey == s.s_suppkey)
    n = read_table(spark, d, "nation", "n_nationkey", "n_regionkey")
    src = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("r1"))
    dst = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r2"))
    pairs = (lf.where(F.col("s_nationkey") != F.col("c_nationkey")).select("s_nationkey", "c_nationkey").distinct()
             .join(src, "s_nationkey").join(dst, "c_nationkey").where(F.col("r1") == F.col("r2")))
    return (pairs.select(F.concat(F.lit("SL"), F.least("s_nationkey", "c_nationkey").cast("string")).alias("node1"),
                         F.concat(F.lit("SL"), F.greatest("s_nationkey", "c_nationkey").cast("string")).alias("node2"))
            .distinct())


def sku_day_signals(spark: SparkSession, d: str) -> DataFrame:
    """The four signals per (Date, SkuId), from lines x part sizes; the
    delivery count tells whether any finished line exists that day."""
    li = read_table(spark, d, "lineitem", "l_partkey", "l_shipdate", "l_quantity", "l_tax",
                    "l_discount", "l_linestatus")
    li = li.where(F.col("l_partkey").isNotNull()).withColumn("Date", F.to_date("l_shipdate")).withColumn(
        "salt", F.pmod(F.xxhash64("Date"), F.lit(SALTS)).cast("int"))
    q = F.col("l_quantity")
    is_f = F.col("l_linestatus") == "F"
    # one shuffle for the sums and the part join; few lines share a day and part, a hot part is spread by day
    agg = (li.repartition("l_partkey", "salt").groupBy("l_partkey", "salt", "Date")
           .agg(F.sum(q).alias("q"), F.sum(q * (1 + F.col("l_tax"))).alias("q_tax"),
                F.sum(F.when(is_f, q).otherwise(0.0)).alias("q_f"),
                F.count_if(is_f).alias("n_f"),
                F.sum(q * (1 - F.col("l_discount"))).alias("q_disc")))
    p = salted(read_table(spark, d, "part", "p_partkey", "p_size"))
    s = F.col("p_size")
    return agg.join(p, (agg.l_partkey == p.p_partkey) & (agg.salt == p.p_salt)).select(
        "Date", sku_id("l_partkey").alias("SkuId"), "l_partkey",
        (F.col("q") * s).alias("SalesOrderQty"),
        F.round(F.col("q_tax") * s, 2).alias("ProductionQty"),
        (F.col("q_f") * s).alias("DeliveryQty"), "n_f",
        F.round(F.col("q_disc") * s, 2).alias("FactoryIssueQty"))


def signals(spark: SparkSession, d: str, kept: bool = False) -> dict[str, DataFrame]:
    """Signal frames (Date, SkuId, value). Delivery only has days with
    finished lines, so joining it leaves gaps. Every frame reads other columns
    of the lines, so Spark aggregates them anew for each; ``kept`` writes the
    aggregate once per session, for a caller that joins the frames."""
    s = materialise(spark, "signals", d, lambda: sku_day_signals(spark, d)) if kept else sku_day_signals(spark, d)
    return {
        "SalesOrderQty": s.select("Date", "SkuId", "SalesOrderQty"),
        "ProductionQty": s.select("Date", "SkuId", "ProductionQty"),
        "DeliveryQty": s.where(F.col("n_f") > 0).select("Date", "SkuId", "DeliveryQty"),
        "FactoryIssueQty": s.select("Date", "SkuId", "FactoryIssueQty"),
    }


def sku_groups(spark: SparkSession, d: str) -> DataFrame:
    """SKU -> group (part type), sub-group (brand)."""
    return read_table(spark, d, "part", "p_partkey", "p_type", "p_brand").select(
        sku_id("p_partkey").alias("SkuId"), F.col("p_type").alias("ProductGroup"),
        F.col("p_brand").alias("SubGroup"))


SLOTS = list(range(10))


def wide_panel(spark: SparkSession, d: str, value: str = "SalesOrderQty") -> DataFrame:
    """A signal in the wide daily layout: one row per (Date, plant), one
    column per SKU slot of the plant (``s0``..``s9``: part key mod 10). The
    column count stays fixed however many SKUs exist."""
    s = sku_day_signals(spark, d)
    if value == "DeliveryQty":
        s = s.where(F.col("n_f") > 0)
    s = s.select("Date", plant_id("l_partkey").alias("PlantId"),
                 F.pmod("l_partkey", F.lit(10)).alias("slot"), value)
    # narrow rows meet once: partial rows of all slots would be wider than the cells
    return s.repartition("Date", "PlantId").groupBy("Date", "PlantId").agg(
        *[F.max(F.when(F.col("slot") == i, F.col(value))).alias(f"s{i}") for i in SLOTS])


def slot_sku(plant: str = "PlantId", slot: str = "SkuId") -> F.Column:
    """Back from (plant, slot column name) to the SKU id."""
    base = F.substring(F.col(plant), 3, 100).cast("bigint")
    return F.concat(F.lit("P"), (base + F.substring(F.col(slot), 2, 3).cast("bigint"))
                    .cast("string"))


WIDE_SLOTS = 1024


def wide_block_lines(spark: SparkSession, d: str, value: str = "SalesOrderQty") -> DataFrame:
    """A signal with one field per SKU of a block of 1,024 part keys: CSV lines
    (Date, Block, ``s0``..``s1023``) in one column that is named by the header."""
    cell = F.struct(F.pmod("l_partkey", F.lit(WIDE_SLOTS)).cast("int").alias("slot"), F.col(value).cast("string").alias("v"))
    s = sku_day_signals(spark, d).select(
        "Date", F.floor(F.col("l_partkey") / WIDE_SLOTS).cast("bigint").alias("Block"), cell.alias("e"))
    w = s.repartition("Date", "Block").groupBy("Date", "Block").agg(F.sort_array(F.collect_list("e")).alias("e"))  # at most 1,024 cells
    # as many commas before a value as places since the value before it
    gap = lambda e, i: e["slot"] - F.coalesce(F.get("e", i - 1)["slot"], F.lit(0))
    fields = F.concat(F.array_join(F.transform("e", lambda e, i: F.concat(F.repeat(F.lit(","), gap(e, i)), e["v"])), ""),
                      F.repeat(F.lit(","), F.lit(WIDE_SLOTS - 1) - F.element_at("e", -1)["slot"]))
    header = ",".join(["Date", "Block", *[f"s{i}" for i in range(WIDE_SLOTS)]])
    return w.select(F.concat_ws(",", F.col("Date").cast("string"), F.col("Block").cast("string"), fields).alias(header))


def block_sku(block: str = "Block", slot: str = "SkuId") -> F.Column:
    """Back from (block, slot column name) to the SKU id."""
    return F.concat(F.lit("P"), (F.col(block).cast("bigint") * WIDE_SLOTS
                                 + F.substring(F.col(slot), 2, 4).cast("bigint")).cast("string"))


_MATERIALISED: dict[tuple, str] = {}


def materialise(spark: SparkSession, key: str, d: str, build) -> DataFrame:
    """Write a derived table once per session to the shared checkpoint folder
    and read it back: every later plan starts from a Parquet scan instead of
    re-analysing (and re-joining) the derivation. Survives executor loss,
    unlike cached blocks."""
    from packflow.session import shared_path
    k = (spark.sparkContext.applicationId, key, d)
    path = _MATERIALISED.get(k)
    if path is None:
        path = shared_path(spark, "tables", key)
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _MATERIALISED[k] = path
    return spark.read.parquet(path)


def deliveries(spark: SparkSession, d: str) -> DataFrame:
    """SkuId, StorageLocationId and DeliveryQty of every row of the panel, from
    the few columns of the lines that they need."""
    return master(spark, d).select("SkuId", "StorageLocationId", "DeliveryQty")


def deliveries_table(spark: SparkSession, d: str) -> DataFrame:
    """The panel's deliveries: its own columns where the panel has been
    materialised, else a table of these three, materialised once per session."""
    if (spark.sparkContext.applicationId, "master", d) in _MATERIALISED:
        return master_table(spark, d).select("SkuId", "StorageLocationId", "DeliveryQty")
    return materialise(spark, "deliveries", d, lambda: deliveries(spark, d))


def master_table(spark: SparkSession, d: str) -> DataFrame:
    """The master panel, materialised once per session (see ``materialise``)."""
    return materialise(spark, "master", d, lambda: master(spark, d))
