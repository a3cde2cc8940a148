"""Stored layout of the master panel (E01, E02): one folder a month, rows
bucketed by SKU.

A date filter lists only the months it touches, and per-SKU windows, joins and
aggregates read the buckets as they are: no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packflow.session import shared_path

MONTH = "Month"


def dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows of a bucket of a month in one task, the months of a bucket in
    many: what a task reads does not grow with the rows of a whole bucket."""
    return rows.repartition(F.pmod(F.hash("SkuId"), F.lit(buckets)), F.col(MONTH))  # Spark's own bucket number


def save_master(master: DataFrame, name: str, buckets: int = 64, path: str | None = None) -> None:
    """Write the panel as table ``name``: partitioned by month (``yyyy-MM``, a
    null date has its own folder), bucketed and sorted by SKU and date. A bucket
    of a month is one file: rows are dealt to (bucket, month) before the write."""
    spark = master.sparkSession
    path = path or shared_path(spark, "layout", name)
    (dealt(master.withColumn(MONTH, F.date_format("Date", "yyyy-MM")), buckets)
     .write.mode("overwrite").option("path", path).partitionBy(MONTH)
     .bucketBy(buckets, "SkuId").sortBy("SkuId", "Date").saveAsTable(name))


def load_master(spark: SparkSession, name: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The panel, or its days from ``first`` to ``last`` (both included): the
    month predicate reaches the file listing, the day predicate the scan."""
    df = spark.table(name)
    for day, text in ((first, ">="), (last, "<=")):
        if day is not None:
            month = F.lit(day.strftime("%Y-%m"))
            df = df.where((F.col(MONTH) >= month if text == ">=" else F.col(MONTH) <= month)
                          & (F.col("Date") >= F.lit(day) if text == ">=" else F.col("Date") <= F.lit(day)))
    return df.drop(MONTH)
