"""Velocity clustering (M11-M13): z-scores from one aggregate, k-means with
all restarts moved together, clusters ranked by their centre's mean demand.

A pass over the rows sums, for every restart at once, the rows nearest to each
of its centres; the centres of all restarts (restarts x k points) travel with
the tasks, each task returns restarts x k sums. So ten restarts cost one scan
an iteration, not ten jobs of their own."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packflow.config import VELOCITY_CLASSES, ClusterConfig

VELOCITY_FEATURES = ["hist_mean", "hist_std", "hist_cv", "fcast_mean"]


def scale_features(profile: DataFrame, cols=VELOCITY_FEATURES) -> DataFrame:
    """Z-score each feature (sample std; 0 when a feature is constant)."""
    stats = profile.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                        *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    j = profile.crossJoin(F.broadcast(stats))
    z = {f"z_{c}": F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
         .otherwise(F.lit(0.0)) for c in cols}
    return j.withColumns(z).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


#: rows of the sample that the first centres are drawn from (the iterations use all rows)
SEED_ROWS = 10_000
TOLERANCE = 1e-4


@dataclass
class Centres:
    """The best restart: its centres (k x features), its cost over all rows,
    and the cost of every restart."""

    points: np.ndarray
    cost: float
    costs: list[float]


def _squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of rows to points (..., points)."""
    out = np.zeros((len(x), *points.shape[:-1]))
    for j in range(x.shape[1]):
        out += (x[:, j].reshape(-1, *[1] * (points.ndim - 1)) - points[..., j]) ** 2
    return out


def seed_centres(sample: np.ndarray, k: int, rng: np.random.RandomState) -> np.ndarray:
    """k-means++ over the sample: each next point is drawn by its squared
    distance to the points so far (equal points give equal centres)."""
    points = [sample[rng.randint(len(sample))]]
    near = _squared(sample, points[0])
    while len(points) < k:
        total = near.sum()
        points.append(sample[rng.choice(len(sample), p=near / total) if total > 0 else rng.randint(len(sample))])
        near = np.minimum(near, _squared(sample, points[-1]))
    return np.array(points)


def joint_step(data: DataFrame, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over the rows: counts (restarts x k), sums (restarts x k x
    features) and costs (restarts) of the rows nearest to each centre."""
    restarts, k, width = points.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, cost = np.zeros((restarts, k)), np.zeros((restarts, k, width)), np.zeros(restarts)
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            d = _squared(x, points)
            owner = d.argmin(2)
            cost += np.take_along_axis(d, owner[..., None], 2).sum((0, 2))
            for r in range(restarts):
                count[r] += np.bincount(owner[:, r], minlength=k)
                for j in range(width):
                    total[r, :, j] += np.bincount(owner[:, r], x[:, j], k)
        flat = np.concatenate([count.ravel(), total.ravel(), cost])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["s"])

    # one row of restarts x k x (features + 1) + restarts numbers a task
    rows = data.mapInArrow(assign, "s array<double>").select(F.posexplode("s").alias("i", "v"))
    sums = rows.groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(restarts * k * (width + 1) + restarts)
    for r in sums:
        flat[r["i"]] = r["v"]
    a, b = restarts * k, restarts * k * (width + 1)
    return flat[:a].reshape(restarts, k), flat[a:b].reshape(restarts, k, width), flat[b:]


def fit_kmeans(scaled: DataFrame, cfg: ClusterConfig = ClusterConfig(), cols=VELOCITY_FEATURES) -> Centres:
    """``restarts`` seedings moved together until no centre of any moves,
    or ``max_iter``; the restart with the lowest cost wins (ties: the first).
    An empty cluster keeps its centre. An empty table gives centres at 0."""
    data = scaled.select(*[F.col(f"z_{c}").cast("double").alias(c) for c in cols]).checkpoint(eager=True)
    # a bounded sample in a fixed order, however the rows are partitioned
    sample = np.array([[r[c] for c in cols] for r in data.orderBy(F.xxhash64(*cols), *cols).limit(SEED_ROWS).collect()])
    if not len(sample):
        return Centres(np.zeros((cfg.k, len(cols))), 0.0, [0.0] * cfg.restarts)
    points = np.array([seed_centres(sample, cfg.k, np.random.RandomState(cfg.seed + r)) for r in range(cfg.restarts)])
    for _ in range(cfg.max_iter):
        count, total, _ = joint_step(data, points)
        moved = np.where(count[..., None] > 0, total / np.maximum(count, 1)[..., None], points)
        done = ((moved - points) ** 2).sum(2).max() <= TOLERANCE ** 2
        points = moved
        if done:
            break
    costs = joint_step(data, points)[2]
    best = int(np.argmin(costs))
    return Centres(points[best], float(costs[best]), costs.tolist())


def nearest_centre(centres: Centres, cols=VELOCITY_FEATURES) -> F.Column:
    """Number of the nearest centre of a row of z-scores (ties: the first)."""
    dist = [sum(((F.col(f"z_{c}") - float(x)) * (F.col(f"z_{c}") - float(x)) for c, x in zip(cols, p)), F.lit(0.0))
            for p in centres.points]
    least = F.least(*dist) if len(dist) > 1 else dist[0]
    out = F.lit(len(dist) - 1)
    for k in range(len(dist) - 2, -1, -1):
        out = F.when(dist[k] == least, k).otherwise(out)
    return out.cast("int")


def rank_clusters(centres: Centres, spark: SparkSession) -> DataFrame:
    """Clusters by centre hist_mean (first feature), descending ->
    fast / medium / slow (k-row lookup table)."""
    means = [float(c[0]) for c in centres.points]
    order = sorted(range(len(means)), key=lambda k: (-means[k], k))
    rows = [(k, VELOCITY_CLASSES[min(r, len(VELOCITY_CLASSES) - 1)], means[k]) for r, k in enumerate(order)]
    return spark.createDataFrame(rows, "cluster int, velocity_class string, centre_hist_mean double")


def cluster_velocity(profile: DataFrame, cfg: ClusterConfig | None = None) -> DataFrame:
    """Profile + ``cluster`` + ``velocity_class``."""
    cfg = cfg or ClusterConfig()
    scaled = scale_features(profile)
    centres = fit_kmeans(scaled, cfg)
    lookup = rank_clusters(centres, profile.sparkSession)
    return (scaled.withColumn("cluster", nearest_centre(centres))
            .join(F.broadcast(lookup.select("cluster", "velocity_class")), "cluster", "left")
            .drop(*[f"z_{c}" for c in VELOCITY_FEATURES]))
