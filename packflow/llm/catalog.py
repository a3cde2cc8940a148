"""The dealt queries over the given tables: name -> function, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from packflow.llm import (anomaly, bpe, fingerprint, jaccard, language, lm, mixing, negatives, packing, repair,
                          repeats, secrets, topk)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(_table(spark, sf_dir, "documents"))
    run.__doc__ = op.__doc__
    return run


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.op4(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op5(_table(spark, sf_dir, "embeddings"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.op11(_table(spark, sf_dir, "conversations"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.op13(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packed_ids": _documents(packing.op1),
    "op2_context_mixing": _documents(lm.op2),
    "op3_super_kmers": _documents(repeats.op3),
    "op4_isolation_forest": op4,
    "op5_mtree_topk": op5,
    "op6_cross_parsing": _documents(language.op6),
    "op7_backtracking_bpe": _documents(bpe.op7),
    "op8_pareto_mix": _documents(mixing.op8),
    "op9_signature_trees": _documents(jaccard.op9),
    "op10_secret_links": _documents(secrets.op10),
    "op11_path_ranks": op11,
    "op12_weighted_samples": _documents(fingerprint.op12),
    "op13_packed_negatives": op13,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {
    "op5_mtree_topk": topk.OP5_SQL,
    "op8_pareto_mix": mixing.OP8_SQL,
    "op11_path_ranks": repair.op11_sql(),
    "op12_weighted_samples": fingerprint.op12_sql(),
    "op13_packed_negatives": negatives.OP13_SQL,
}
