"""Helpers shared by the operators: shared folder, interim tables, row keys, partition counts."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packflow.session import ensure_checkpoint_dir, shared_path

ARROW_ROWS = "500"
WORD = r"[^\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Shared folder known, and this package importable by Python workers
    whatever folder they start in (Spark's own file distribution)."""
    ensure_checkpoint_dir(spark)
    # texts are long rows: smaller Arrow batches keep workers small
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="packflow-ship-"), "packflow-llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "packflow")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


_STATE: dict = {}


def worker_state(key, make):
    """Tables that a Python worker keeps between tasks, of one operator at a
    time: workers outlive a stage, and the next one needs their memory."""
    if key not in _STATE:
        release_worker_state()
        _STATE[key] = make()
        _return_pages()
    return _STATE[key]


def release_worker_state() -> None:
    """Give up the kept tables and the memory they took."""
    _STATE.clear()
    _return_pages()


def tidy(run):
    """``run`` (a function of Arrow batches) that gives the worker's tables and
    memory back when its task ends: idle workers live on beside other stages."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_worker_state()
    return wrapped


def tidy_groups(run):
    """``tidy`` for a function of one group's table: the memory of a group is
    given back before the next one, and before another stage runs."""
    def wrapped(table):
        try:
            return run(table)
        finally:
            release_worker_state()
    return wrapped


def _return_pages() -> None:
    """Return freed pages that allocators would hold on to, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: cuts the
    lineage and survives lost executors. Packed bytes are better written with
    compression ``none``: large pages would need large codec buffers."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, null texts empty: other columns cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Key of a row when ids may repeat: equal only for equal id and text
    (used next to the id, never alone)."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def folds(id_col: str, k: int) -> Column:
    """crc32 of the id as text, modulo ``k`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(k))


def text_chars(docs: DataFrame) -> int:
    """Characters of the text column, one row to the driver."""
    return int(docs.agg(F.sum(F.length("text"))).first()[0] or 0)


def buckets_for(units: int, per_bucket: int, at_least: int = 8) -> int:
    """Bucket count that keeps ``per_bucket`` units in a task at any input size."""
    return max(at_least, -(-units // per_bucket))
