"""Exact global positions without a single-partition window.

``global_index`` sorts with a range-partitioned ``orderBy``, numbers rows
inside each partition, and adds the row count of all earlier partitions.
Only the per-partition count table (one row per partition) is gathered; the
facts never meet in one task. The sorted, numbered frame is written with
``checkpoint()`` to the shared checkpoint folder, so a lost executor cannot
renumber rows between the two passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def global_index(df: DataFrame, order_cols: Sequence[str | F.Column], name: str = "idx",
                 checkpoint: bool = True) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order_cols`` order.
    ``order_cols`` must be a total order (include a unique key)."""
    s = (df.orderBy(*order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        s = s.checkpoint(eager=True)
    counts = s.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (s.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + pos)
            .drop("_pid", "_mid", "_off"))


def dense_codes(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Sorted distinct values of ``col`` -> codes 0..n-1."""
    name = name or f"{col}_enc"
    d = df.select(F.col(col).cast("string").alias(col)).where(F.col(col).isNotNull()).distinct()
    return global_index(d, [col], name)


#: bins a value range is cut into by one pass, and rows below which the rest is counted value by value
BINS = 4096
FEW = 1 << 17
GROUPS = 100_000  # groups whose open ranges are broadcast to the rows; beyond it they are joined


def _wanted(n: F.Column, probs: Sequence[float]) -> F.Column:
    """0-based ranks that the quantiles of a group of n rows interpolate between."""
    h = [(n - 1) * F.lit(float(p)) for p in probs]
    return F.array_distinct(F.array(*[x.cast("bigint") for q in h for x in (F.floor(q), F.ceil(q))]))


def _bin(v: F.Column, lo: F.Column, hi: F.Column) -> F.Column:
    """Bin of a value in [lo, hi]; halves keep the width finite."""
    share = F.coalesce(F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2), F.lit(0.0))
    inner = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
    return (F.when(F.isnan(v), BINS + 1).when(v == float("inf"), BINS).when(v == float("-inf"), -1).otherwise(inner))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    group: str | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (NumPy's default) per group, by
    selection: a pass counts the values of each open range by 4,096 bins with
    their least and greatest value, and only bins that hold a wanted rank stay
    open. A bin of one value is done; when few rows are left, or a range does
    not shrink, its distinct values are counted. Every pass is a partial
    aggregate over the rows: no sort of the column, no copy of it, and neither
    a hot group nor a hot value meets in one task. Output: (group, p, q); a
    group without a value has no row. NaN counts as the greatest value."""
    rows = df.select((F.col(group) if group else F.lit(0)).alias("_g"), F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull())
    finite = F.when(~F.isnan("_v") & (F.abs("_v") != float("inf")), F.col("_v"))
    groups = rows.groupBy("_g").agg(F.count("*").alias("_n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"))
    groups = groups.withColumn("wanted", _wanted(F.col("_n"), probs)).checkpoint(eager=True)
    small = F.broadcast if groups.limit(GROUPS + 1).count() <= GROUPS else (lambda d: d)
    wanted = groups.select("_g", "wanted")
    # an open range: values within [lo, hi] (odd: and the values that are not finite), rows before it
    nodes = groups.select("_g", F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce("hi", F.lit(0.0)).alias("hi"),
                          F.lit(True).alias("odd"), F.lit(0).cast("bigint").alias("before"), F.col("_n").alias("count"))
    done = None

    def within(nodes: DataFrame) -> DataFrame:
        """Rows with the open range of their group that holds them."""
        open_ = nodes.groupBy(F.col("_g").alias("_og")).agg(F.collect_list(F.struct("lo", "hi", "odd", "before")).alias("open"))
        v = F.col("_v")
        met = rows.join(small(open_), F.col("_g").eqNullSafe(F.col("_og")))
        strange = F.isnan(v) | (F.abs(v) == float("inf"))
        return met.select("_g", "_v", F.explode(F.filter("open", lambda r: F.when(strange, r["odd"]).otherwise(
            (v >= r["lo"]) & (v <= r["hi"])))).alias("r"))

    def ranked(counts: DataFrame, order: str) -> DataFrame:
        """Counts with the rows before them, those that hold a wanted rank."""
        over = Window.partitionBy("_g", "start").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.col("start") + F.coalesce(F.sum("count").over(over), F.lit(0)))
        want = wanted.withColumnRenamed("_g", "_wg")
        held = counts.join(small(want), F.col("_g").eqNullSafe(F.col("_wg")))
        return held.withColumn("ranks", F.filter("wanted", lambda k: (k >= F.col("before")) & (
            k < F.col("before") + F.col("count")))).where(F.size("ranks") > 0)

    def answers(held: DataFrame, value: str) -> DataFrame:
        return held.select("_g", F.explode("ranks").alias("rank"), F.col(value).alias("x"))

    left = nodes.agg(F.sum("count")).first()[0] or 0
    while left > FEW:
        binned = (within(nodes).groupBy("_g", F.col("r.before").alias("start"), F.col("r.lo").alias("lo"),
                                        F.col("r.hi").alias("hi"),
                                        _bin(F.col("_v"), F.col("r.lo"), F.col("r.hi")).alias("bin"))
                  .agg(F.count("*").alias("count"), F.min("_v").alias("least"), F.max("_v").alias("most")))
        held = ranked(binned, "bin").select(
            "_g", "least", "most", "ranks", "before", "count",
            ((F.col("least") == F.col("lo")) & (F.col("most") == F.col("hi"))).alias("stuck")).checkpoint(eager=True)
        one = (F.col("least") == F.col("most"))
        found = answers(held.where(one), "least")
        done = found if done is None else done.unionByName(found)
        held = held.where(~one)
        nodes = held.select("_g", F.col("least").alias("lo"), F.col("most").alias("hi"), F.lit(False).alias("odd"),
                            "before", "count")
        sums = held.agg(F.sum("count").alias("n"), F.max("stuck").alias("stuck")).first()
        left = sums["n"] or 0
        if sums["stuck"]:
            break
    if left:
        counts = within(nodes).groupBy("_g", F.col("r.before").alias("start"), "_v").agg(F.count("*").alias("count"))
        found = answers(ranked(counts, "_v"), "_v")
        done = found if done is None else done.unionByName(found)
    if done is None:
        done = rows.select("_g", F.lit(0).cast("bigint").alias("rank"), F.col("_v").alias("x")).limit(0)
    h = (F.col("_n") - 1) * F.col("p")
    asked = groups.select(F.col("_g").alias("_ag"), "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    asked = asked.withColumns({"f": h - F.floor(h), "a": F.floor(h), "b": F.ceil(h)})
    met = asked.join(done, F.col("_ag").eqNullSafe(F.col("_g")) & ((F.col("rank") == F.col("a")) | (F.col("rank") == F.col("b"))))
    out = met.groupBy("_ag", "p", "f").agg(F.max(F.when(F.col("rank") == F.col("a"), F.col("x"))).alias("lo"),
                                           F.max(F.when(F.col("rank") == F.col("b"), F.col("x"))).alias("hi"))
    q = F.when(F.col("f") == 0, F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("f")).alias("q")
    return out.select(*([F.col("_ag").alias(group)] if group else []), "p", q)


def distinct_counts(df: DataFrame, cols: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of distinct non-null values of each column: the
    rows meet as distinct tuples first, then once as (column, value)."""
    names = list(names or cols)
    tagged = F.array(*[F.struct(F.lit(n).alias("tag"), F.col(c).cast("string").alias("value")) for n, c in zip(names, cols)])
    values = (df.select(*cols).distinct().select(F.explode(tagged).alias("t")).select("t.*")
              .where(F.col("value").isNotNull()).distinct())
    return values.agg(*[F.count_if(F.col("tag") == n).alias(n) for n in names])
