"""Master panel: reshaping, cleaning, signal joins, calendar (P01-P11,
J01-J04, E01-E02).

The four signals are co-grouped on (Date, SkuId); each side is an aggregate
keyed the same way, so Spark shuffles each once and the three left joins run
as sort-merge joins on the same partitioning (no re-shuffle between them).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.functions.exprs import any_flag, fill_unknown, parse_date, parse_qty

UNIFIED = ["Date", "SkuId", "ProductGroup", "SubGroup", "PlantId", "StorageLocationId",
           "OnHandQty", "UnitCost", "LeadTimeDays", "SalesOrderQty", "ProductionQty",
           "DeliveryQty", "FactoryIssueQty", "Promotional_Flag", "Price"]
SIGNALS = ["SalesOrderQty", "ProductionQty", "DeliveryQty", "FactoryIssueQty"]
DIMENSIONS = ["ProductGroup", "SubGroup", "PlantId", "StorageLocationId"]


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def unpivot_panel(wide: DataFrame, value_name: str, id_cols: Sequence[str] = ("Date",),
                  var_name: str = "SkuId") -> DataFrame:
    """Wide (one column per SKU) -> (ids..., SkuId, value).

    Column names may contain dots, so every name is back-quoted."""
    ids = list(id_cols)
    vals = [c for c in wide.columns if c not in ids]
    return wide.unpivot([F.col(_q(c)) for c in ids], [F.col(_q(c)) for c in vals],
                        var_name, value_name)


def parse_dates(df: DataFrame, col: str = "Date") -> DataFrame:
    """Text -> date, bad -> null."""
    return df.withColumn(col, parse_date(F.col(_q(col))))


def parse_quantities(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text -> double, bad or null -> 0."""
    return df.withColumns({c: parse_qty(c) for c in cols})


def rename_columns(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Trim header names, then rename by ``mapping``."""
    df = df.toDF(*[c.strip() for c in df.columns])
    mapping = {k: v for k, v in (mapping or {}).items() if k in df.columns}
    return df.withColumnsRenamed(mapping) if mapping else df


def add_defaults(df: DataFrame, lead_time_days: int | None = None) -> DataFrame:
    """OnHandQty 0 and Promotional_Flag 0 when absent; LeadTimeDays."""
    out = {}
    if "OnHandQty" not in df.columns:
        out["OnHandQty"] = F.lit(0.0)
    if "Promotional_Flag" not in df.columns:
        out["Promotional_Flag"] = F.lit(0)
    if lead_time_days is not None or "LeadTimeDays" not in df.columns:
        out["LeadTimeDays"] = F.lit(7 if lead_time_days is None else lead_time_days)
    return df.withColumns(out) if out else df


def sku_number(sku: str = "SkuId") -> F.Column:
    """Stable number of a SKU id: 28 bits of the MD5 of the whole id."""
    return F.conv(F.substring(F.md5(F.col(_q(sku)).cast("binary")), 1, 7), 16, 10).cast("bigint")


def add_reference_cost_price(df: DataFrame, sku: str = "SkuId") -> DataFrame:
    """Reproducible cost in [5, 50) and price = cost x [1.2, 2.5) from
    SKU-key arithmetic (partition-independent); a known cost / price wins."""
    n = sku_number(sku)
    gen_cost = F.lit(5.0) + F.pmod(n * 7919, F.lit(4500)) / 100.0
    gen_mult = F.lit(1.2) + F.pmod(n * 104729, F.lit(130)) / 100.0
    cost = F.coalesce(F.col("UnitCost"), gen_cost) if "UnitCost" in df.columns else gen_cost
    price = (F.coalesce(F.col("Price"), cost * gen_mult) if "Price" in df.columns
             else cost * gen_mult)
    return df.withColumn("UnitCost", cost).withColumn("Price", price)


def fill_unknown_dims(df: DataFrame, cols: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Null dimension -> 'UNKNOWN' (as string); absent column -> default."""
    out = {}
    for c in cols:
        out[c] = fill_unknown(c) if c in df.columns else F.lit("UNKNOWN")
    return df.withColumns(out)


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null numeric measures -> 0 (never touches strings)."""
    num = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    cols = cols or [f.name for f in df.schema if f.dataType.simpleString() in num]
    return df.na.fill(0, subset=list(cols))


def project_unified(df: DataFrame) -> DataFrame:
    """The fixed 15-column projection."""
    return df.select(*UNIFIED)


def any_state_flag(cal: DataFrame, prefix: str = "snap_", name: str = "snap_flag") -> DataFrame:
    """P10: row-wise max over all ``snap_*`` columns, 0 if there are none."""
    return cal.withColumn(name, any_flag([c for c in cal.columns if c.startswith(prefix)]))


def promo_flag(df: DataFrame, flag: str = "snap_flag") -> DataFrame:
    """Calendar flag -> int Promotional_Flag, null -> 0."""
    return df.withColumn("Promotional_Flag", F.coalesce(F.col(flag), F.lit(0)).cast("int"))


def join_signals(sales: DataFrame, others: dict[str, DataFrame | None]) -> DataFrame:
    """Sales left-joined with the other signals on (Date, SkuId);
    an absent signal or a gap -> 0. Signals given as wide lines
    (``sources.wide``) meet as lines, on all their id columns, and are unpivoted
    and parsed after that."""
    if not isinstance(sales, DataFrame):
        long = sales.long_with({k: v for k, v in others.items() if v is not None})
        parsed = parse_quantities(long, [sales.value, *[k for k, v in others.items() if v is not None]])
        return parsed.withColumns({k: F.lit(0.0) for k, v in others.items() if v is None}).na.fill(
            0.0, subset=list(others)).select(*sales.ids, "SkuId", sales.value, *others)
    base = sales
    for name, df in others.items():
        if df is None:
            base = base.withColumn(name, F.lit(0.0))
        else:
            base = base.join(df.select("Date", "SkuId", name), ["Date", "SkuId"], "left")
    return base.na.fill(0.0, subset=list(others))


def join_locations_fanout(df: DataFrame, bridge: DataFrame) -> DataFrame:
    """SKU -> many (plant, storage) rows; measures repeat per location."""
    return df.join(bridge.select("SkuId", "PlantId", "StorageLocationId"), "SkuId", "left")


def dedup_dimension(dim: DataFrame, key: str = "SkuId") -> DataFrame:
    """One row per key (smallest attributes win), so a duplicated node cannot
    fan out a join."""
    attrs = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(F.min(F.struct(*attrs)).alias("_a")).select(key, "_a.*")


def join_groups(df: DataFrame, groups: DataFrame) -> DataFrame:
    """SKU -> group, sub-group after key de-duplication."""
    return df.join(dedup_dimension(groups.select("SkuId", "ProductGroup", "SubGroup")),
                   "SkuId", "left")


def join_calendar(df: DataFrame, cal: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Left join by date. The calendar is a dimension (one row per day,
    ~365 rows a year), so it is broadcast."""
    c = cal.withColumnRenamed("date", "Date")
    if cols is not None:
        c = c.select("Date", *cols)
    return df.join(F.broadcast(c), "Date", "left")


def build_master(sales: DataFrame, production: DataFrame | None, delivery: DataFrame | None,
                 issue: DataFrame | None, bridge: DataFrame | None,
                 groups: DataFrame | None) -> DataFrame:
    """Signals -> joined panel -> groups -> defaults -> locations (fan-out)
    -> 15 columns. What a SKU alone decides is made before its rows are repeated
    for each location. The sales signal is required."""
    if sales is None:
        raise ValueError("build_master needs the sales signal")
    base = join_signals(sales, {"ProductionQty": production, "DeliveryQty": delivery,
                                "FactoryIssueQty": issue})
    if groups is not None:
        base = join_groups(base, groups)
    base = add_defaults(base)
    base = add_reference_cost_price(base)
    if bridge is not None:
        base = join_locations_fanout(base, bridge)
    base = fill_unknown_dims(base)
    base = fill_zero(base, ["OnHandQty", "UnitCost", "LeadTimeDays", "Promotional_Flag",
                            "Price"] + SIGNALS)
    return project_unified(base)


def load_unified(master: DataFrame, cal: DataFrame | None) -> DataFrame:
    """Master + calendar: promo flag from any state flag, event and
    calendar columns attached."""
    if cal is None:
        return master
    c = any_state_flag(cal)
    keep = ["snap_flag"] + [x for x in ("event_name_1", "event_type_1", "month", "year", "weekday", "wday")
                            if x in c.columns]
    j = join_calendar(master.drop("Promotional_Flag"), c, keep)
    return promo_flag(j).drop("snap_flag")
