"""Operator 13: hard-negative mining with Kronecker-packed products.

Candidates' integer components are biased to be non-negative, and each
dimension of a page of candidates is one wide integer: a field for each
candidate, wide enough for a whole inner product. One multiplication a
dimension and anchor then multiplies that component of every candidate of the
page, and the sum over dimensions holds all inner products side by side:

    sum_d (a_d + b) (c_d + b) = a.c + b sum(a) + b sum(c) + dim b^2

Fields are whole bytes, so they are unpacked by one view of the number's bytes;
the terms with b are taken off modulo 2^64, which leaves the signed score.

Candidates go to shards of bounded size, anchors to blocks; each block meets
each shard once (a stated query set against all rows). The first pass finds an
anchor's positives among the pages that hold its label, the second the
negatives under every positive's score; within a task only the best few of each
are kept, and a window with its limit pushed below the shuffle merges shards.
"""

from __future__ import annotations

import operator
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packflow.llm.common import buckets_for, prepare, written

PAGE = 2048
SHARD = 16384
BLOCK = 2048  # anchors; small tables use smaller blocks, so that tasks are many
LIMIT = 1 << 27  # scaled components beyond it could not give scores of 64 bits

_U = np.uint64


class Page:
    """Candidates packed by dimension into wide integers."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, bias: int, width: int):
        self.ids, self.labels, self.bias, self.width = ids, labels, bias, width
        self.n, self.dims = x.shape
        raw = (x + bias).astype("<u8")
        fields = np.zeros((self.dims, self.n, width), np.uint8)
        low = min(8, width)
        fields[:, :, :low] = raw.T.copy().view(np.uint8).reshape(self.dims, self.n, 8)[:, :, :low]
        self.packed = [int.from_bytes(f.tobytes(), "little") for f in fields]
        self.own = x.sum(1).astype(_U) * _U(bias)

    def scores(self, anchor: list[int], total: int) -> np.ndarray:
        """Inner products with an anchor given as biased components and their
        unbiased sum."""
        product = sum(map(operator.mul, anchor, self.packed))
        raw = np.frombuffer(product.to_bytes(self.n * self.width, "little"), np.uint8).reshape(self.n, self.width)
        if self.width in (4, 8):
            fields = raw.view(f"<u{self.width}").reshape(-1).astype(_U)
        else:  # the low eight bytes decide the score
            low = np.zeros((self.n, 8), np.uint8)
            low[:, : min(8, self.width)] = raw[:, :8]
            fields = low.view("<u8").reshape(-1)
        common = (self.bias * total + self.dims * self.bias * self.bias) % (1 << 64)
        return (fields - self.own - _U(common)).view(np.int64)


def field_bytes(dims: int, most: int) -> int:
    """Bytes that hold an inner product of biased components up to ``most``."""
    need = max(1, -(-(dims * most * most).bit_length() // 8))
    return 4 if need <= 4 else 8 if need <= 8 else need


def first_best(score: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k first (score, id): higher scores first, ties by smaller id."""
    if len(score) > 8 * k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        keep = score >= floor
        score, ids = score[keep], ids[keep]
    order = np.lexsort((ids, -score))[:k]
    return list(zip(score[order].tolist(), ids[order].tolist()))


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    return sorted(a + b, key=lambda r: (-r[0], r[1]))[:k] if b else a


def labelled_vectors(table: DataFrame, scale: int, id_col: str, vec_col: str, label_col: Column) -> DataFrame:
    """Distinct (vec_id, label, v): v is floor(scale * x). Rows without an id,
    label or vector, or with a null, non-finite or too large component
    (2^27 after scaling) take no part."""
    e = F.col(f"`{vec_col}`")
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(scaled(x)) >= float(LIMIT)))
    rows = (table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), label_col.cast("long").alias("label"),
                         F.when(~bad, e).alias("e"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull()))
    return rows.select("vec_id", "label",
                       F.transform("e", lambda x: F.floor(scaled(x)).cast("int")).alias("v")).distinct()


def _stack(rows: list, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def mine(table: DataFrame, positives: int = 5, negatives: int = 5, every: int = 100, scale: int = 256,
         low: int = 80, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``, their positives
    the ``positives`` best other rows of the same label, the negatives of a
    positive the first ``negatives`` rows of another label that score between
    ``low`` percent of the positive's score and that score. Rows with an
    anchor's own id are no others. Repeated rows (id, label and vector) count
    once; an id with several labels or vectors is several rows and anchors,
    told apart by the extra column ``anchor_key``. Shorter vectors count as
    padded with zeros. An anchor without positives or negatives, and an empty
    table, give no rows. Extra columns are ignored."""
    spark = table.sparkSession
    prepare(spark)
    vectors = written(labelled_vectors(table, scale, id_col, vec_col, F.col("label") if label is None else label), "vectors")
    stats = vectors.agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("asked"),
                        F.max(F.size("v")).alias("dims"), F.min(F.array_min("v")).alias("low"),
                        F.max(F.array_max("v")).alias("high")).first()
    dims = max(1, stats["dims"] or 0)
    least, highest = min(0, stats["low"] or 0), max(0, stats["high"] or 0)
    bias, width = -least, field_bytes(dims, highest - least)
    shards = buckets_for(stats["n"], SHARD, 1)
    blocks = buckets_for(stats["asked"], min(BLOCK, max(32, stats["asked"] // 16)), 1)

    # of equal vectors with one label only the first few ids can be returned (one may be the anchor's own)
    copies = Window.partitionBy("label", "v").orderBy("vec_id")
    candidates = (vectors.withColumn("rn", F.row_number().over(copies))
                  .where(F.col("rn") <= max(positives, negatives) + 1)
                  .select("vec_id", "label", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard")))

    def pack(key, pdf):
        import pandas as pd
        pdf = pdf.sort_values(["label", "vec_id"])
        x = _stack(list(pdf["v"]), dims)
        ids, labels = pdf["vec_id"].to_numpy(np.int64), pdf["label"].to_numpy(np.int64)
        pages = [Page(ids[a: a + PAGE], labels[a: a + PAGE], x[a: a + PAGE], bias, width) for a in range(0, len(x), PAGE)]
        return pd.DataFrame({"shard": [key[0]], "pages": [pickle.dumps(pages)]})

    packed = written(candidates.groupBy("shard").applyInPandas(pack, "shard int, pages binary"), "pages", "none")

    def against(asked: DataFrame, schema: str, search) -> DataFrame:
        """Blocks of anchors (key, id, label, v, and more) meet every shard once."""
        def block(key, pdf):
            import pandas as pd
            return pd.DataFrame({"block": [key[0]], "anchors": [pickle.dumps(pdf.drop(columns="block"))]})

        def run(batches):
            for b in batches:
                for r in range(b.num_rows):
                    pages, anchors = pickle.loads(b.column(0)[r].as_py()), pickle.loads(b.column(1)[r].as_py())
                    x = _stack(list(anchors["v"]), dims)
                    out = []
                    for anchor, biased, total in zip(anchors.itertuples(index=False), (x + bias).tolist(),
                                                     x.sum(1).tolist()):
                        out += search(anchor, biased, total, pages)
                    yield pa.RecordBatch.from_pylist(out, pa.schema([(n, pa.int64()) for n in schema.split(",")]))

        blocked = (asked.withColumn("block", F.pmod(F.xxhash64("key", "vec_id"), F.lit(blocks)).cast("int"))
                   .groupBy("block").applyInPandas(block, "block int, anchors binary")
                   .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
        pairs = blocked.repartition(blocks * shards, "block", "shard").join(packed, "shard")
        return pairs.select("pages", "anchors").mapInArrow(run, ", ".join(f"{n} long" for n in schema.split(",")))

    def positive(anchor, biased, total, pages):
        best: list[tuple[int, int]] = []
        for p in pages:
            mine_ = (p.labels == anchor.label) & (p.ids != anchor.vec_id)
            if mine_.any():
                best = merged(best, first_best(p.scores(biased, total)[mine_], p.ids[mine_], positives), positives)
        return [{"key": anchor.key, "positive_id": i, "positive_score": s} for s, i in best]

    def negative(anchor, biased, total, pages):
        goals = sorted({int(s) for s in anchor.scores})
        best: dict[int, list[tuple[int, int]]] = {s: [] for s in goals}
        for p in pages:
            other = (p.labels != anchor.label) & (p.ids != anchor.vec_id)
            if not other.any():
                continue
            score, ids = p.scores(biased, total)[other], p.ids[other]
            for goal in goals:
                floor = -((-low * goal) // 100)
                if len(best[goal]) == negatives:
                    floor = max(floor, best[goal][-1][0])
                near = np.flatnonzero((score >= floor) & (score <= goal))
                if len(near):
                    best[goal] = merged(best[goal], first_best(score[near], ids[near], negatives), negatives)
        return [{"key": anchor.key, "positive_score": g, "negative_id": i, "negative_score": s}
                for g, hits in best.items() for s, i in hits]

    anchors = vectors.where(F.col("vec_id") % every == 0).withColumn("key", F.xxhash64("vec_id", "label", "v"))
    first = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    pos = written(against(anchors, "key,positive_id,positive_score", positive)
                  .withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives), "positives")
    goals = pos.groupBy("key").agg(F.collect_set("positive_score").alias("scores"))  # at most ``positives`` a key
    hits = against(anchors.join(goals, "key"), "key,positive_score,negative_id,negative_score", negative)
    ranked = Window.partitionBy("key", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hits = hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    return (anchors.select("key", F.col("vec_id").alias("anchor_id")).join(pos.drop("place"), "key")
            .join(hits, ["key", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
                    F.col("key").alias("anchor_key")))


def op13(embeddings: DataFrame) -> DataFrame:
    """Mining after the contract's change of labels (ids divisible by 7)."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    return mine(embeddings, label=moved).drop("anchor_key")


OP13_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
 AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
QUALIFY rank <= 5
"""
