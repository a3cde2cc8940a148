"""File sources of the panel (S01-S11): wide daily CSVs, node / edge lists,
calendar, prices, wide sales history.

Files are read as text under their header and cast by column name (no
inference pass, no dependence on column order). Paths may be local or any
Hadoop filesystem URI; name matching is a case-insensitive glob that the file
listing resolves; of several matches the first in name order is read.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packflow.operators.master import build_master, load_unified, parse_dates, parse_quantities, rename_columns
from packflow.sources.wide import WideLines, read_wide_lines

SIGNAL_FILES = {
    "SalesOrderQty": "sales order",
    "ProductionQty": "production",
    "DeliveryQty": "delivery",
    "FactoryIssueQty": "factory issue",
}


def ci_glob(pattern: str) -> str:
    """'sales order' -> '*[sS][aA][lL][eE][sS] [oO][rR][dD][eE][rR]*'."""
    out = []
    for ch in pattern:
        out.append(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch)
    return "*" + "".join(out) + "*"


def resolve_source(root: str | Sequence[str], pattern: str) -> list[str]:
    """One path glob per root, each matching the files (or written table
    folders) whose name contains ``pattern``, case-insensitively. The readers
    take the first match of the first root that has one (see ``first_match``)."""
    roots = [root] if isinstance(root, str) else list(root)
    return [f"{r.rstrip('/')}/{ci_glob(pattern)}" for r in roots]


def first_match(spark: SparkSession, glob: str) -> str | None:
    """The first file or table folder, in name order, that ``glob`` matches.
    Similar names next to it are not mixed into it."""
    try:
        files = (spark.read.option("recursiveFileLookup", True).text(glob)).inputFiles()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    where = urlparse(glob)
    depth = len((where.path if where.scheme else os.path.abspath(glob)).split("/"))
    entries = {"/".join(unquote(urlparse(f).path).split("/")[:depth]) for f in files}
    if not entries:
        return None
    scheme, host = urlparse(files[0])[:2]
    first = min(entries, key=lambda e: (e.lower(), e))
    return f"{scheme}://{host}" + "".join("\\" + c if c in "[]{}*?" else c for c in first)


def _read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame | None:
    """A CSV file or folder with a header, every column text, names trimmed.
    A list of globs reads the first match of the first root that has one;
    ``None`` when there is no such file."""
    if isinstance(path, (list, tuple)):
        found = (first_match(spark, g) for g in path)
        path = next((f for f in found if f is not None), None)
        if path is None:
            return None
    try:
        df = spark.read.option("header", True).option("recursiveFileLookup", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rename_columns(df)


def _read_named(spark: SparkSession, path, schema: T.StructType,
                required: Sequence[str]) -> DataFrame | None:
    """The columns of ``schema`` taken by name, whatever their order and
    whatever else the file holds; an absent optional column is null, values
    that do not parse are null, an absent required one is an error."""
    df = _read_csv(spark, path)
    if df is None:
        return None
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} among {', '.join(df.columns)}")
    return df.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def _first_path(spark: SparkSession, path) -> str | None:
    """``path``, or the first match of the first glob of a list that has one."""
    if not isinstance(path, (list, tuple)):
        return path
    return next((f for f in (first_match(spark, g) for g in path) if f is not None), None)


def read_wide(spark: SparkSession, path, id_cols: Sequence[str] = ("Date",),
              together: Sequence[str] = ()) -> WideLines | None:
    """Wide daily CSV, first column the date, then (after further id
    columns) one column per SKU, as lines with one array column: any number of
    SKUs. ``.long(...)`` unpivots it, ``.columns(...)`` takes a few SKUs."""
    found = _first_path(spark, path)
    return None if found is None else read_wide_lines(spark, found, id_cols, rename_first="Date", together=together)


def read_wide_panel(spark: SparkSession, path) -> DataFrame | None:
    """S01 as a DataFrame with one column per SKU, for panels of at most a few
    thousand: all columns are text; the first is renamed ``Date``."""
    df = _read_csv(spark, path)
    if df is None:
        return None
    return df.withColumnRenamed(df.columns[0], "Date")


def read_signal(spark: SparkSession, root: str | Sequence[str], value_name: str,
                id_cols: Sequence[str] = ("Date",), together: Sequence[str] = ()) -> DataFrame | None:
    """One signal in long form: wide lines -> exploded by the header -> parsed
    date and qty, in one stage however many SKUs the file has. ``together``:
    see ``read_wide_lines``."""
    wide = read_signal_lines(spark, root, value_name, id_cols, together)
    return None if wide is None else parse_quantities(wide.long(value_name), [value_name])


def read_signal_lines(spark: SparkSession, root: str | Sequence[str], value_name: str,
                      id_cols: Sequence[str] = ("Date",), together: Sequence[str] = ()) -> WideLines | None:
    """The lines of one signal, dates parsed once a line, not once a cell."""
    wide = read_wide(spark, resolve_source(root, SIGNAL_FILES[value_name]), id_cols, together)
    if wide is not None:
        wide.rows, wide.value = parse_dates(wide.rows), value_name
    return wide


def read_signals(spark: SparkSession, root: str | Sequence[str],
                 id_cols: Sequence[str] = ("Date",), long: bool = True) -> dict[str, DataFrame | WideLines | None]:
    """The four signals, in long form or (``long=False``) as lines, which
    ``join_signals`` joins before it unpivots them; an absent file gives ``None``."""
    read = read_signal if long else read_signal_lines
    return {k: read(spark, root, k, id_cols) for k in SIGNAL_FILES}


NODE_SCHEMA = T.StructType([T.StructField("Node", T.StringType())])


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """SKU list, Node -> SkuId."""
    df = _read_named(spark, path, NODE_SCHEMA, ["Node"])
    if df is None:
        return empty_with_schema(spark, ["SkuId"])
    return df.withColumnRenamed("Node", "SkuId")


def read_sku_locations(spark: SparkSession, path: str) -> DataFrame:
    """SKU -> plant, storage bridge; header names are trimmed."""
    df = _read_csv(spark, path)
    if df is None:
        return empty_with_schema(spark, ["SkuId", "PlantId", "StorageLocationId"])
    return rename_columns(df, {"Node": "SkuId", "Plant": "PlantId",
                               "Storage Location": "StorageLocationId"})


def read_sku_groups(spark: SparkSession, path: str) -> DataFrame:
    """SKU -> group, sub-group."""
    df = _read_csv(spark, path)
    if df is None:
        return empty_with_schema(spark, ["SkuId", "ProductGroup", "SubGroup"])
    return rename_columns(df, {"Node": "SkuId", "Group": "ProductGroup",
                               "Sub-Group": "SubGroup"})


EDGE_KIND_COLUMN = {"storage": "Storage Location", "plant": "Plant",
                    "group": "GroupCode", "subgroup": "SubGroupCode"}
EDGE_KIND_FILE = {"storage": "storage location", "plant": "plant",
                  "group": "product group", "subgroup": "product sub-group"}


def read_edges(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Storage / plant / group / sub-group edges as (kind, label,
    node1, node2)."""
    label = EDGE_KIND_COLUMN[kind]
    df = _read_csv(spark, path)
    if df is None:
        df = empty_with_schema(spark, [label, "node1", "node2"])
    lab = F.col(f"`{label}`") if label in df.columns else F.lit(None).cast("string")
    return df.select(F.lit(kind).alias("kind"), lab.cast("string").alias("label"),
                     F.col("node1").cast("string"), F.col("node2").cast("string"))


CALENDAR_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()), T.StructField("snap_CA", T.IntegerType()),
    T.StructField("snap_TX", T.IntegerType()), T.StructField("snap_WI", T.IntegerType()),
    T.StructField("event_name_1", T.StringType()), T.StructField("event_type_1", T.StringType()),
    T.StructField("month", T.IntegerType()), T.StructField("year", T.IntegerType()),
])


def read_calendar(spark: SparkSession, path,
                  schema: T.StructType = CALENDAR_SCHEMA) -> DataFrame | None:
    """Calendar with parsed date, columns taken by name."""
    df = _read_named(spark, path, schema, ["date"])
    return None if df is None else parse_dates(df, "date")


PRICE_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()), T.StructField("item_id", T.StringType()),
    T.StructField("sell_price", T.DoubleType()),
])


def read_sell_prices(spark: SparkSession, path, fmt: str = "csv") -> DataFrame | None:
    """Item x store (x week) prices, columns taken by name."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return _read_named(spark, path, PRICE_SCHEMA, ["item_id", "sell_price"])


def read_sales_history(spark: SparkSession, path: str, evaluation: bool = False) -> DataFrame | None:
    """Wide item x day history (``d_*`` columns) -> (ids, d, sales), any
    number of days; a day without a value is 0."""
    name = "sales_train_evaluation" if evaluation else "sales_train_validation"
    found = _first_path(spark, resolve_source(path, name))
    wide = None if found is None else read_wide_lines(spark, found, lambda c: not c.startswith("d_"))
    return None if wide is None else parse_quantities(wide.long("sales", "d"), ["sales"])


def empty_with_schema(spark: SparkSession, cols: Sequence[str],
                      types: dict[str, T.DataType] | None = None) -> DataFrame:
    """An absent optional table as an empty frame with fixed columns."""
    types = types or {}
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in cols])
    return spark.createDataFrame([], schema)


def load_panel(spark: SparkSession, root: str) -> dict:
    """E01 + E02 over the files under ``root`` (in its usual sub-folders or in
    ``root`` itself): the master panel with its calendar columns, plus nodes,
    prices, calendar and edges by kind. The sales file is required; every other
    file may be absent."""
    top = root.rstrip("/")

    def at(name: str, folder: str) -> list[str]:
        return resolve_source([f"{top}/{folder}", top], name)

    sig = read_signals(spark, [f"{top}/Temporal Data/Unit", top])
    if sig["SalesOrderQty"] is None:
        raise FileNotFoundError(f"no '{SIGNAL_FILES['SalesOrderQty']}' file under {root}")
    cal = read_calendar(spark, at("calendar", "m5"))
    master = build_master(sig["SalesOrderQty"], sig["ProductionQty"], sig["DeliveryQty"],
                          sig["FactoryIssueQty"],
                          read_sku_locations(spark, at("node types (plant", "Nodes")),
                          read_sku_groups(spark, at("node types (product", "Nodes")))
    return {"master": load_unified(master, cal), "calendar": cal,
            "nodes": read_nodes(spark, at("nodes.csv", "Nodes")),
            "prices": read_sell_prices(spark, at("sell_prices", "m5")),
            "edges": {k: read_edges(spark, at(f"edges ({name})", "Edges"), k)
                      for k, name in EDGE_KIND_FILE.items()}}
