"""Forest forecast with a per-tree interval.

The fit (``forest_fit``) gives an MLlib random forest; the interval walks all
trees in one Arrow pass over flattened node arrays (``forest``) and takes the
mean and the 10th / 90th percentile of a row's tree predictions there.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.config import ForecastConfig
from packflow.operators import features as FE
from packflow.operators.forest import tree_predictions
from packflow.operators.forest_fit import fit_forest
from packflow.session import stored
from packflow.sources import manifest

TARGET = "SalesOrderQty"


def assemble_vector(df: DataFrame, cols=FE.FEATURES) -> VectorAssembler:
    """Ordered feature list; columns absent from ``df`` are skipped."""
    present = [c for c in cols if c in df.columns]
    return VectorAssembler(inputCols=present, outputCol="features", handleInvalid="error")


def few_partitions(train: DataFrame) -> DataFrame:
    """Rows in at most two partitions a core. In every round of the fit each
    partition sends the counts of all open nodes of all trees (40 MB at depth
    8), so that part of its time, and of what it shuffles, grows with the
    number of partitions and not with the rows."""
    return train.coalesce(2 * train.sparkSession.sparkContext.defaultParallelism)


def train_forest(train: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> PipelineModel:
    """Random forest, all features per split, fixed seed."""
    train = few_partitions(train)
    assembler = assemble_vector(train)
    forest = fit_forest(train, assembler.getInputCols(), TARGET, cfg.num_trees, cfg.max_depth, cfg.seed, max_bins=32)
    return PipelineModel([assembler, forest])


def evaluate_holdout(model: PipelineModel, test: DataFrame) -> DataFrame:
    """RMSE and MAPE on the held-out rows (A39 on model output)."""
    return FE.forecast_errors(model.transform(test), TARGET, "prediction")


def interval(trees: np.ndarray) -> dict[str, np.ndarray]:
    """Mean, 10th and 90th percentile of rows x trees, floored at 0."""
    n = trees.shape[1]
    total = np.zeros(len(trees))
    for k in range(n):  # added up in tree order, as the forest's own prediction
        total += trees[:, k]
    ordered = np.sort(trees, axis=1)

    def share(p: float) -> np.ndarray:
        h = (n - 1) * p
        lo = int(h)
        a, b = ordered[:, lo], ordered[:, min(lo + 1, n - 1)]
        return a + (b - a) * (h - lo)

    return {"ForecastQty": np.maximum(total / n, 0.0), "CI_Lower": np.maximum(share(0.1), 0.0),
            "CI_Upper": np.maximum(share(0.9), 0.0)}


def forecast_interval(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Mean, 10th and 90th percentile across trees, floored at 0."""
    return tree_predictions(model, frame, "_trees", interval, ["ForecastQty", "CI_Lower", "CI_Upper"])


def split(features: DataFrame, cfg: ForecastConfig) -> tuple[DataFrame, DataFrame]:
    rows = FE.ordered_split(FE.filter_training_rows(features), cfg.train_fraction, cfg.split_mode)
    return rows.where("is_train").drop("is_train"), rows.where(~F.col("is_train")).drop("is_train")


def fingerprint(df: DataFrame, cfg: ForecastConfig) -> str:
    """Model key from schema, config and an order-free digest of all rows (one
    aggregate of row hashes), so a changed panel never reuses a stale model."""
    row = df.select(F.xxhash64(*df.columns).alias("h")).agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    h = hashlib.sha256(f"{df.schema.json()}|{cfg}|{row['n']}|{row['x']}|{row['s']}".encode()).hexdigest()
    return h[:16]


def save_load_model(train: DataFrame, cfg: ForecastConfig, model_dir: str | None) -> PipelineModel:
    """Reuse the published model of the same data fingerprint, else fit,
    save it aside and publish it (any Hadoop filesystem). A fit that died while
    it was saved is not published and is not read."""
    if model_dir is None:
        return train_forest(train, cfg)
    spark = train.sparkSession
    store = f"{model_dir.rstrip('/')}/forest-{fingerprint(train, cfg)}"
    saved = manifest.current(spark, store).get("model")
    if saved is not None:
        return PipelineModel.load(saved)
    model = train_forest(train, cfg)
    run, folder = manifest.new_run(store)
    model.write().save(f"{folder}/model")
    manifest.publish(spark, store, run, [("model", f"{folder}/model", 1)])
    return model


def feature_importance(model: PipelineModel) -> DataFrame:
    """Importance per feature (a 12-row model attribute)."""
    names = model.stages[0].getInputCols()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "Feature string, Importance double")


def rank_importance(imp: DataFrame) -> DataFrame:
    """Features by importance, descending."""
    return imp.orderBy(F.desc("Importance"), F.asc("Feature"))


def forecast(master: DataFrame, cfg: ForecastConfig = ForecastConfig(), sku_filter=None,
             model_dir: str | None = None) -> dict:
    """Forecast per SKU x day with interval, plus metrics and actuals."""
    # the SKU x day series and its features feed the split bounds, the fit,
    # the hold-out and the horizon: materialise each once
    daily = stored(FE.daily_series(master), "daily")
    codes = FE.encode_categories(daily)
    if cfg.method == "naive":
        fc = FE.naive_forecast(daily, cfg.horizon_days)
        if sku_filter:
            fc = fc.where(F.col("SkuId").isin(list(sku_filter)))
        return {"forecast": fc, "actuals": FE.actuals(master, fc), "metrics": None, "model": None}
    feats = stored(FE.build_features(daily, codes), "features")
    train, test = split(feats, cfg)
    model = save_load_model(train, cfg, model_dir)
    metrics = evaluate_holdout(model, test)
    end = daily.agg(F.max("Date").alias("_end"))
    if sku_filter:
        daily = daily.where(F.col("SkuId").isin(list(sku_filter)))
    frame = FE.horizon_frame(daily, cfg.horizon_days, codes, end)
    fc = forecast_interval(model, frame).select(
        "SkuId", "Date", "ForecastQty", "CI_Lower", "CI_Upper", "ProductGroup", "SubGroup", "PlantId")
    return {"forecast": fc, "actuals": FE.actuals(master, fc), "metrics": metrics, "model": model,
            "importance": feature_importance(model)}
