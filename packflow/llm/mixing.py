"""Operator 8: mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Each source's target is its weight's share of all words, held to ``most`` times
the source; what is cut off is shared again by weight (water filling over one
row per source). A source takes every document floor(target / size) whole
times. What is left is an unequal-probability sample: a document's inclusion
probability is min(1, f x its words), f being set for each source so that the
expected words add up to what is left. Documents whose probability is 1 are
certain; the others are ranked by random odds over inclusion odds and taken in
that order up to the document nearest to the words left.

A hot source never meets in one task: f comes from counts by (source, size),
word sums go by (source, slice of the rank), the slice that holds the end is
found from those sums, and only its documents are ranked one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packflow.llm.common import WORD, prepare, written

SLICES = 4096  # at least; more where a source has many documents
SLICE_DOCS = 4096  # documents of a source for which there is one slice
CYCLE = 3
BROADCAST_SOURCES = 100_000


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_col: str, seed: str):
    """Uniform in (0, 1) from 52 bits of the md5 of the id and a seed."""
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """source, source_size -> also weight and target. One row per source;
    sources by code point, null last, weigh 1, 2, 3, repeating."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", (F.col("rank") - 1) % CYCLE + 1)
    cap = F.col("source_size") * most
    fill = Window.orderBy(cap / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (w.withColumn("cap", cap)
         .withColumn("place", F.row_number().over(fill))
         .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("weights", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("open", F.col("cap") * F.col("weights") >= F.col("left") * F.col("weight")))
    first = F.min(F.when(F.col("open"), F.col("place"))).over(every)
    level = F.min_by(F.struct("left", "weights"), F.when(F.col("open"), F.col("place"))).over(every)
    return (w.withColumn("first", first).withColumn("level", level)
            .select("source", "source_size", "weight",
                    F.when(F.col("place") < F.coalesce(F.col("first"), F.lit(1 << 30)), F.col("cap").cast("double"))
                    .otherwise((F.col("level.left") * F.col("weight")).cast("double") / F.col("level.weights"))
                    .alias("target")))


def leftover(per_source: DataFrame) -> DataFrame:
    """Whole copies and the words that the sample must add."""
    some = F.col("source_size") > 0
    whole = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return (per_source.withColumn("whole", whole)
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))


def inclusion_factor(counts: DataFrame) -> DataFrame:
    """source, size, n, rest -> source, factor: inclusion is min(1, factor x
    size), and the expected words of the sample are ``rest``.

    From the largest size down, sizes are certain as long as the factor that
    the rest asks for would put them above 1. One row per source and size."""
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    words = F.col("size").cast("decimal(20,0)") * F.col("n")
    above = F.coalesce(F.sum(words).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double")
    squares = F.sum(words * F.col("size")).over(down.rowsBetween(0, Window.unboundedFollowing)).cast("double")
    fits = counts.where(F.col("size") > 0).withColumn("factor", (F.col("rest") - above) / squares)
    fits = fits.where(F.col("factor") * F.col("size") <= 1)
    return fits.groupBy("source").agg(F.max_by("factor", "size").alias("factor"))


def pareto_rank(u, chance):
    """Random odds over inclusion odds, mapped to [0, 1); 0 when certain, null
    without a chance."""
    q = (u / (1 - u)) / (chance / (1 - chance))
    return F.when(chance >= 1, F.lit(0.0)).when(chance > 0, q / (1 + q))


def mix(docs: DataFrame, seed: str = "mix", most: int = 3) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken.

    Null texts and texts without a word have size 0 and take nothing; a null
    source is a source of its own; rows with equal id and source are taken
    alike; extra columns are kept whatever their names (columns called like
    the results are replaced). Reruns agree: ranks come from ids alone."""
    prepare(docs.sparkSession)
    results = ("size", "source_size", "target", "copies", "taken")
    # own names apart from any a caller may use
    own = [f"_d{k}" for k in range(len(docs.columns))]
    named = docs.toDF(*own)
    col = dict(zip(docs.columns, own))
    ranked = named.withColumns({"m_size": word_count(col["text"]), "m_u": uniform(col["doc_id"], seed),
                                "m_id": F.col(col["doc_id"]).cast("long"), "m_source": F.col(col["source"])})
    slim = ranked.select("m_id", "m_source", "m_size", "m_u")
    # one row per source and document size
    counts = written(slim.groupBy(F.col("m_source").alias("source"), F.col("m_size").alias("size"))
                     .agg(F.count("*").alias("n")), "sizes")
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    facts = sizes.agg(F.count("*").alias("sources"), F.max("docs").alias("docs")).first()
    slices = max(SLICES, -(-(facts["docs"] or 0) // SLICE_DOCS))
    # one row per source: broadcast up to a checked number, beyond it AQE splits the hot source's join
    small = F.broadcast if facts["sources"] <= BROADCAST_SOURCES else (lambda df: df)
    plan = leftover(targets(sizes.drop("docs"), most))
    on = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    met = counts.join(small(plan.select(F.col("source").alias("p_source"), "rest")), on("source", "p_source"))
    factor = inclusion_factor(met).select(F.col("source").alias("f_source"), "factor")
    plan = plan.join(factor, on("source", "f_source"), "left").select(
        F.col("source").alias("p_source"), F.col("source_size").alias("p_size"), F.col("target").alias("p_target"),
        F.col("whole").alias("p_whole"), F.col("rest").alias("p_rest"), F.col("factor").alias("p_factor"))
    per = small(written(plan, "targets"))
    chance = F.least(F.lit(1.0), F.col("p_factor") * F.col("m_size"))
    by_rank = pareto_rank(F.col("m_u"), chance)
    rank = slim.join(per, on("m_source", "p_source")).drop("p_source").withColumn("m_rank", by_rank)
    rank = rank.where(F.col("m_rank").isNotNull()).withColumn("m_slice", F.floor(F.col("m_rank") * slices))
    by_slice = Window.partitionBy("m_source").orderBy("m_slice")
    ends = (rank.groupBy("m_source", "m_slice").agg(F.sum("m_size").alias("words"), F.max("p_rest").alias("rest"))
            .withColumn("end", F.sum("words").over(by_slice))
            .where(F.col("end") > F.col("rest"))
            .groupBy(F.col("m_source").alias("e_source")).agg(F.min(F.struct(
                F.col("m_slice").alias("slice"), (F.col("end") - F.col("words")).alias("before"))).alias("at")))
    edge = rank.join(small(ends), on("m_source", "e_source")).where(F.col("m_slice") == F.col("at.slice"))
    in_edge = Window.partitionBy("m_source").orderBy("m_rank", "m_id", "m_size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    middle = F.col("at.before") + F.sum("m_size").over(in_edge) - F.col("m_size") / 2
    cuts = (edge.withColumn("in", middle <= F.col("p_rest"))
            .groupBy(F.col("m_source").alias("c_source")).agg(
                F.max(F.when(F.col("in"), F.struct("m_rank", "m_id", "m_size"))).alias("c_last"),
                F.min(F.col("at.slice")).alias("c_edge")))
    whole_plan = small(per.join(cuts, on("p_source", "c_source"), "left"))
    out = ranked.join(whole_plan, on("m_source", "p_source")).withColumn("m_rank", by_rank)
    at = F.floor(F.col("m_rank") * slices)
    taken = (F.col("m_rank").isNotNull()
             & (F.col("c_edge").isNull() | (at < F.col("c_edge"))
                | (F.col("c_last").isNotNull() & (at == F.col("c_edge"))
                   & (F.struct("m_rank", "m_id", "m_size") <= F.col("c_last")))))
    copies = F.col("p_whole") + taken.cast("long")
    kept = [F.col(o).alias(c) for c, o in col.items() if c not in results]
    return out.select(*kept, F.col("m_size").alias("size"), F.col("p_size").alias("source_size"),
                      F.col("p_target").alias("target"), copies.alias("copies"),
                      (copies * F.col("m_size")).alias("taken"))


def op8(docs: DataFrame) -> DataFrame:
    """Mix of all documents; the words are counted once and kept in the shared folder."""
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 13)) AS BIGINT) + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
f AS (SELECT *, row_number() OVER o AS place,
             sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
             sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
      FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, rank)),
l AS (SELECT place, remaining, weights FROM f WHERE cap * weights >= remaining * weight ORDER BY place LIMIT 1),
t AS (SELECT f.source, f.source_size,
             CASE WHEN l.place IS NULL OR f.place < l.place THEN f.cap::DOUBLE
                  ELSE (l.remaining * f.weight)::DOUBLE / l.weights::DOUBLE END AS target
      FROM f LEFT JOIN l ON true),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
i AS (SELECT *, target - whole * source_size AS rest FROM p),
n AS (SELECT d.source, d.size, CAST(count(*) AS BIGINT) AS n, any_value(i.rest) AS rest
      FROM d JOIN i ON d.source IS NOT DISTINCT FROM i.source WHERE d.size > 0 GROUP BY d.source, d.size),
g AS (SELECT source, size, (rest - coalesce(sum(size * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
             / (sum(size * n * size) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS factor
      FROM n WINDOW o AS (PARTITION BY source ORDER BY size DESC)),
f2 AS (SELECT source, arg_max(factor, size) AS factor FROM g WHERE factor * size <= 1 GROUP BY source),
q AS (SELECT d.doc_id, d.size, i.source, i.source_size, i.target, i.whole, i.rest, d.u, least(1.0::DOUBLE, factor * d.size) AS chance
      FROM d JOIN i ON d.source IS NOT DISTINCT FROM i.source LEFT JOIN f2 ON d.source IS NOT DISTINCT FROM f2.source),
h AS (SELECT *, CASE WHEN chance >= 1 THEN 0.0::DOUBLE
                     WHEN chance > 0 THEN ((u / (1 - u)) / (chance / (1 - chance))) / (1 + (u / (1 - u)) / (chance / (1 - chance)))
                END AS rank FROM q),
c AS (SELECT *, sum(CASE WHEN chance > 0 THEN size END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS words FROM h)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN chance > 0 AND words - size / 2.0 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM c
"""
