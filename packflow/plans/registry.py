"""Named queries with a declared output schema.

``out`` declares every output column once, ``name:kind``:

* ``s`` string, ``b`` boolean, ``t`` date, ``i`` bigint,
* ``x`` double compared as is (integer-valued or exactly computed),
* ``d`` double compared at 10 significant digits (ties to even).

The same spec shapes the Spark result and wraps the oracle SQL, so both
engines return identical column names and types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packflow.plans.oracle_base import compose

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    out: list[tuple[str, str]]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def parse_out(spec: str) -> list[tuple[str, str]]:
    cols = []
    for part in spec.replace("\n", " ").split(","):
        part = part.strip()
        if not part:
            continue
        name, kind = part.rsplit(":", 1)
        cols.append((name.strip(), kind.strip()))
    return cols


_SPARK_CAST = {"s": "string", "b": "boolean", "t": "date", "i": "bigint", "x": "double",
               "d": "double"}
_SQL_CAST = {"s": "VARCHAR", "b": "BOOLEAN", "t": "DATE", "i": "BIGINT", "x": "DOUBLE",
             "d": "DOUBLE"}


def sig10_col(c: F.Column) -> F.Column:
    """Round a double to 10 significant digits, ties to even."""
    x = c.cast("double")
    k = F.lit(9) - F.floor(F.log10(F.abs(x)))
    up = F.pow(F.lit(10.0), k)
    down = F.pow(F.lit(10.0), -k)
    r = F.when(k >= 0, F.rint(x * up) / up).otherwise(F.rint(x / down) * down)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(x == 0, F.lit(0.0)).otherwise(r)


def sig10_sql(e: str) -> str:
    x = f"CAST({e} AS DOUBLE)"
    k = f"(9 - FLOOR(LOG10(ABS({x}))))"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN 0.0 "
            f"WHEN {k} >= 0 THEN ROUND_EVEN({x} * POW(10.0, {k}), 0) / POW(10.0, {k}) "
            f"ELSE ROUND_EVEN({x} / POW(10.0, -{k}), 0) * POW(10.0, -{k}) END")


def shape_df(df: DataFrame, out: list[tuple[str, str]]) -> DataFrame:
    cols = []
    for name, kind in out:
        c = F.col(f"`{name}`")
        if kind == "d":
            c = sig10_col(c)
        cols.append(c.cast(_SPARK_CAST[kind]).alias(name))
    return df.select(*cols)


def shape_sql(sql: str, out: list[tuple[str, str]]) -> str:
    cols = []
    for name, kind in out:
        q = f'"{name}"'
        e = sig10_sql(f"q.{q}") if kind == "d" else f"q.{q}"
        cols.append(f"CAST({e} AS {_SQL_CAST[kind]}) AS {q}")
    return "SELECT " + ",\n       ".join(cols) + "\nFROM (\n" + sql + "\n) q"


def query(name: str, out: str, sql: str | None = None, ctes: dict[str, str] | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    spec = parse_out(out)

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shape_df(fn(spark, sf_dir), spec)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        full = shape_sql(compose(sql, ctes), spec) if sql is not None else None
        REGISTRY[name] = Query(name, run, spec, full)
        return fn

    return deco
