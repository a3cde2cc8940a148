"""Result sinks.

Row counts are taken with ``DataFrame.observe`` during the write itself, so
reporting costs no second pass over a result table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_results(spark: SparkSession, out_dir: str, tables: dict[str, DataFrame | None],
                  fmt: str = "parquet") -> DataFrame:
    """Write each named non-empty table to ``out_dir/name``; return
    (table, rows, path) for the non-empty ones."""
    rows = []
    for name, df in tables.items():
        if df is None:
            continue
        obs = Observation(f"count_{name}")
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.parquet(path)
        n = int(obs.get["rows"])
        if n:
            rows.append((name, n, path))
    schema = T.StructType([T.StructField("table", T.StringType()),
                           T.StructField("rows", T.LongType()),
                           T.StructField("path", T.StringType())])
    return spark.createDataFrame(rows, schema)


def read_results(spark: SparkSession, out_dir: str, names: list[str],
                 fmt: str = "parquet",
                 schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Read result tables back for reporting; CSV columns are text unless
    ``schemas`` gives the table's types."""
    out = {}
    for n in names:
        p = f"{out_dir.rstrip('/')}/{n}"
        if fmt == "csv":
            out[n] = spark.read.option("header", True).csv(p, schema=(schemas or {}).get(n))
        else:
            out[n] = spark.read.parquet(p)
    return out
