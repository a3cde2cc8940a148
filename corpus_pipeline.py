"""Corpus pipeline: language ID, n-gram Jaccard join, secret scans, source mixing, BPE ids.

Each stage reads its predecessor's written rows; all but the last return the
columns of ``documents``. The mix repeats documents, so ids may repeat there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packflow.llm import bpe, jaccard, language, mixing, secrets
from packflow.llm.common import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _only(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognisable language (not ``und``), with it as lang."""
    samples = language.fit_sample(docs)
    found = language.identify(docs, samples, keep=COLUMNS)
    return _only(found.where(F.col("lang_pred") != "und").withColumn("lang", F.col("lang_pred")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the smallest id (a null
    id after all others), then by a hash of the text. Ids may repeat: a row is told by
    its id and text, so unlike texts with one id stay apart; rows equal in both
    are one document, which keeps its least other columns."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    group = jaccard.components(keyed.select(F.col("_key").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_key"), F.col("component_id").alias("_group")).distinct()
    ids = keyed.select("doc_id", "_key", F.xxhash64("text").alias("text")).join(group, "_key")
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text", "_key")
    kept = ids.groupBy("_group").agg(F.min(order).alias("first")).select(F.col("first._key").alias("_key"))
    rows = keyed.join(kept, "_key", "left_semi")
    rest = F.struct(*[c for c in COLUMNS if c not in ("doc_id", "text")])
    return (rows.groupBy("_key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.min(rest).alias("rest"))
            .select("doc_id", "text", "rest.*").select(*COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, found secrets masked."""
    return _only(secrets.redact(docs)).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    mixed = mixing.mix(docs).where(F.col("copies") > 0)
    return _only(mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded digests of the final corpus."""
    return bpe.op7(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan),
          ("source_mix", source_mix), ("bpe_ids", bpe_ids)]

#: the learned and tokenizer stages have no SQL; tests/llm holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
