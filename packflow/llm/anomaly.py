"""Operator 4: quality rules and an isolation forest on their statistics.

Base rules give per-document statistics. An isolation forest (random splits on
bounded subsamples) turns their ratios into an anomaly score from path lengths;
the cut is the score that best separates labelled good and bad rows while
keeping almost every good one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.llm.common import prepare, texts, written
from packflow.llm.words import IS_WORD, SPACE_TEXT, Words, slices, windows

SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
#: code points are counted at their first byte
IS_POINT = np.ones(256, bool)
IS_POINT[0x80:0xC0] = False

STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
FEATURES = ("symbol_share", "dup_line_share", "repeat_share", "mean_word_chars")


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return c[offsets[1:]] - c[offsets[:-1]]


def repeated_words(w: Words, size: int = 8) -> np.ndarray:
    """Words per text that lie in a window of ``size`` words found twice or
    more in that text."""
    total = int(w.docs[-1])
    h, first = windows(w.hashes(lower=False), w.docs, size)
    doc = np.repeat(np.arange(len(w.counts)), w.counts)
    if not len(h):
        return np.zeros(len(w.counts), np.int64)
    order = np.lexsort((h, doc[first]))
    hs, ds = h[order], doc[first][order]
    same = (hs[1:] == hs[:-1]) & (ds[1:] == ds[:-1])
    twice = np.zeros(len(h), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    hit = first[twice]
    edge = np.zeros(total + size + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return per_text(np.cumsum(edge)[:total] > 0, w.docs)


def repeated_lines(text: str) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, lines with a word)."""
    lines = [x for x in text.split("\n") if x.strip(SPACE_TEXT)]
    return len(lines) - len(set(lines)), len(lines)


def statistics(docs: DataFrame) -> DataFrame:
    """Rule statistics of every whole text (null: none): row by row, so ties,
    repeated rows, extra columns and empty tables need no care."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            ids, col = b.column(0), b.column(1)
            for lo, hi, data, off in slices(col):
                w = Words(data, off)
                lines = [repeated_lines(t) for t in col.slice(lo, hi - lo).to_pylist()]
                cols = [w.counts, per_text(IS_WORD[data] & IS_POINT[data], off), per_text(IS_SYMBOL[data], off),
                        [x[0] for x in lines], repeated_words(w), [x[1] for x in lines]]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in cols)],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"])

    return texts(docs).mapInArrow(run, STATS)


def with_features(stats: DataFrame) -> DataFrame:
    n = F.greatest("n_words", F.lit(1))
    return stats.withColumns({
        "symbol_share": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / n,
        "mean_word_chars": F.col("word_chars") / n,
        "repeats": (F.col("n_dup_lines") > 0) | (F.col("n_repeat_words") > 0),
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    })


class IsolationForest:
    """Random split trees over bounded subsamples, as flat arrays."""

    def __init__(self, sample: np.ndarray, trees: int = 100, subsample: int = 256, seed: int = 17):
        rng = np.random.RandomState(seed)
        self.size = min(subsample, max(1, len(sample)))
        depth = max(1, int(np.ceil(np.log2(max(2, self.size)))))
        self.trees = []
        for _ in range(trees if len(sample) else 0):
            rows = sample[rng.permutation(len(sample))[: self.size]]
            self.trees.append(self._grow(rows, depth, rng))

    @staticmethod
    def _expected(n: int) -> float:
        """Mean path length of an unsuccessful search among n rows."""
        return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0

    def _grow(self, rows: np.ndarray, depth: int, rng) -> tuple:
        feature, cut, kids, leaf = [], [], [], []

        def node(x: np.ndarray, level: int) -> int:
            me = len(feature)
            feature.append(0), cut.append(0.0), kids.append((me, me)), leaf.append(level + self._expected(len(x)))
            varied = np.flatnonzero(x.min(0) < x.max(0)) if len(x) > 1 else ()
            if level < depth and len(varied):
                f = int(varied[rng.randint(len(varied))])
                at = rng.uniform(x[:, f].min(), x[:, f].max())
                left = x[:, f] <= at
                feature[me], cut[me] = f, at
                kids[me] = (node(x[left], level + 1), node(x[~left], level + 1))
            return me

        node(rows, 0)
        return np.array(feature), np.array(cut), np.array(kids), np.array(leaf), depth

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ^ (-mean path length / expected): near 1 anomalous, 0.5 usual."""
        if not self.trees or not len(x):
            return np.full(len(x), 0.5)
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, cut, kids, leaf, depth in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = kids[at, (x[every, feature[at]] > cut[at]).astype(np.int64)]
            total += leaf[at]
        return 2.0 ** (-total / len(self.trees) / max(self._expected(self.size), 1e-9))


def fit_forest(features: DataFrame, sample_rows: int = 8192, **params) -> IsolationForest:
    """Forest on at most ``sample_rows`` rows, the smallest by a hash of the id
    (each tree then draws its own subsample)."""
    rows = (features.where(~F.col("base_failed"))
            .select(F.xxhash64(F.lit(17), "doc_id").alias("_h"), *FEATURES)
            .orderBy("_h", *FEATURES).limit(sample_rows).collect())
    return IsolationForest(np.array([[r[f] for f in FEATURES] for r in rows], float).reshape(-1, len(FEATURES)), **params)


def anomaly_scores(features: DataFrame, forest: IsolationForest) -> DataFrame:
    """Features with a column ``anomaly``."""
    spark = features.sparkSession
    shared = spark.sparkContext.broadcast(forest)  # trees x 2 x subsample nodes
    names = features.columns

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(names.index(f)).to_numpy(zero_copy_only=False) for f in FEATURES])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.score(x))], names=[*names, "anomaly"])

    return features.mapInArrow(run, features.withColumn("anomaly", F.lit(0.0)).schema)


def calibrate(scored: DataFrame, labels: DataFrame, keep_good: float = 0.995, bins: int = 2000) -> dict[bool, float]:
    """Largest score still kept, for rows without and with repetition (a
    repeated line or window sets a row apart without making it bad, so each
    class has its own cut). Of all cuts that keep at least ``keep_good`` of the
    labelled good rows, the one with the best recall of bad rows minus loss of
    good ones (ties: the higher cut). Two histograms of ``bins`` go to the
    driver. A class without good and bad labels is not cut (1.0)."""
    lab = (labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.min("quality").alias("quality")))
    hist = (scored.where(~F.col("base_failed")).select("doc_id", "anomaly", "repeats").join(lab, "doc_id")
            .groupBy("repeats", F.ceil(F.col("anomaly") * bins).alias("bin"))
            .agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"),
                 F.sum((F.col("quality") <= 0).cast("long")).alias("bad")).collect())
    cuts = {}
    for repeats in (False, True):
        good, bad = np.zeros(bins + 2), np.zeros(bins + 2)
        for r in hist:
            if r["repeats"] == repeats:
                good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
        cuts[repeats] = 1.0
        if good.sum() and bad.sum():
            kept_good, kept_bad = np.cumsum(good) / good.sum(), np.cumsum(bad) / bad.sum()
            gain = np.where(kept_good >= keep_good, kept_good - kept_bad, -np.inf)
            cuts[repeats] = min(1.0, (len(gain) - 1 - int(np.argmax(gain[::-1]))) / bins)
    return cuts


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, anomaly score, threshold of the row's class and verdict:
    ``kept`` is false for rows the base rules fail and for scores above the
    threshold."""
    feats = written(with_features(statistics(docs)), "anomaly")
    scored = anomaly_scores(feats, fit_forest(feats))
    cuts = calibrate(scored, labels)
    return scored.withColumn("threshold", F.when(F.col("repeats"), F.lit(cuts[True])).otherwise(F.lit(cuts[False]))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") <= F.col("threshold")))


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept", "anomaly", "threshold")
