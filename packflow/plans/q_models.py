"""Queries: MLlib forecast and clustering
and the KPI / pipeline tables (U01, E03-E05). Model outputs are checked
rows-only plus unit-test invariants; the z-scores (M11) and the benchmark
table over the deterministic chain (E04) have exact oracles."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from packflow.config import ForecastConfig
from packflow.operators import clustering as CL
from packflow.operators import features as FE
from packflow.operators import forecast as FC
from packflow.operators import kpi as K
from packflow.plans.q_features import FEAT
from packflow.plans.q_network import NET, _plan
from packflow.plans.q_packs_finance import PF, _chain, _ledger
from packflow.plans.registry import query
from packflow.plans.sqlfrag import emean, rhe
from packflow.sources import binding as B

_FITS: dict = {}
CFG = ForecastConfig()


def _fit(spark, d):
    """Features, split and fitted forest, once per session and data set."""
    k = (spark.sparkContext.applicationId, d)
    if k not in _FITS:
        m = B.master_table(spark, d)
        # read by the codes, the features and the horizon; by the bounds, the fit and the hold-out
        daily = B.materialise(spark, "daily", d, lambda: FE.daily_series(m))
        codes = FE.encode_categories(daily)
        feats = B.materialise(spark, "features", d, lambda: FE.build_features(daily, codes))
        tr, te = FC.split(feats, CFG)
        _FITS[k] = (daily, codes, tr, te, FC.train_forest(tr, CFG))
    return _FITS[k]


@query("assemble_vector", "SkuId:s, Date:t, n_features:i, feature_sum:d",
       f"""SELECT "SkuId", "Date", {len(FE.FEATURES)} AS n_features,
          {' + '.join(f'CAST("{c}" AS DOUBLE)' for c in FE.FEATURES)} AS feature_sum
          FROM (SELECT *, MIN("Date") OVER () AS lo, MAX("Date") OVER () AS hi FROM train_rows) t
          WHERE "Date" < lo + CAST(FLOOR((hi - lo) * {CFG.train_fraction}e0) AS INTEGER)""", FEAT)
def q_assemble_vector(spark, d):
    """M02 assemble_vector: the ordered 12-feature vector per row."""
    daily, codes, tr, te, model = _fit(spark, d)
    v = FC.assemble_vector(tr).transform(tr)
    a = vector_to_array("features")
    return v.select("SkuId", "Date", F.size(a).alias("n_features"),
                    F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x).alias("feature_sum"))


@query("train_forest", "num_trees:i, total_nodes:i, train_rows:i")
def q_train_forest(spark, d):
    """M03 train_forest: forest size facts."""
    daily, codes, tr, te, model = _fit(spark, d)
    rf = model.stages[-1]
    n = tr.agg(F.count("*").alias("train_rows"))
    return n.select(F.lit(len(rf.trees)).alias("num_trees"),
                    F.lit(rf.totalNumNodes).alias("total_nodes"), "train_rows")


@query("evaluate_holdout", "RMSE:d, MAPE:d, n_rows:i")
def q_evaluate_holdout(spark, d):
    """M04 evaluate_holdout."""
    daily, codes, tr, te, model = _fit(spark, d)
    return FC.evaluate_holdout(model, te)


FOREST_OUT = """SkuId:s, Date:t, ForecastQty:d, CI_Lower:d, CI_Upper:d, ProductGroup:s, SubGroup:s,
PlantId:s"""


def _forest_forecast(spark, d):
    daily, codes, tr, te, model = _fit(spark, d)
    fr = FE.horizon_frame(daily, CFG.horizon_days, codes)
    return FC.forecast_interval(model, fr).select(*[c.split(":")[0].strip() for c in
                                                    FOREST_OUT.replace("\n", " ").split(",")])


@query("forecast_interval", FOREST_OUT)
def q_forecast_interval(spark, d):
    """M06 forecast_interval: per-tree 10 / 90 % and mean."""
    return _forest_forecast(spark, d)


@query("forecast", FOREST_OUT)
def q_forecast(spark, d):
    """M07 forecast: SKU x 30 days with interval."""
    return _forest_forecast(spark, d)


@query("feature_importance", "Feature:s, Importance:d")
def q_feature_importance(spark, d):
    """M09 feature_importance."""
    return FC.feature_importance(_fit(spark, d)[4])


@query("rank_importance", "Feature:s, Importance:d")
def q_rank_importance(spark, d):
    """T11 rank_importance."""
    return FC.rank_importance(FC.feature_importance(_fit(spark, d)[4]))


@query("save_load_model", "Feature:s, Importance:d, reused:b")
def q_save_load_model(spark, d):
    """M10 save_load_model on an empty store: the first call fits and
    publishes, the second loads that model; the loaded model's importances and
    whether they are the fitted one's."""
    from packflow.session import shared_path
    daily, codes, tr, te, model = _fit(spark, d)
    root = shared_path(spark, "models")
    fitted = FC.feature_importance(FC.save_load_model(tr, CFG, root)).withColumnRenamed("Importance", "fitted")
    again = FC.feature_importance(FC.save_load_model(tr, CFG, root))
    return again.join(fitted, "Feature").withColumn("reused", F.col("Importance") == F.col("fitted"))


@query("scale_features", "SkuId:s, z_hist_mean:x, z_hist_std:x, z_hist_cv:x, z_fcast_mean:x",
       """SELECT "SkuId", """ + ", ".join(
           rhe(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0e0 END", 8) + f" AS z_{c}"
           for c in CL.VELOCITY_FEATURES)
       + " FROM profile CROSS JOIN (SELECT " + ", ".join(
           f"AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in CL.VELOCITY_FEATURES) + " FROM profile) st",
       PF)
def q_scale_features(spark, d):
    """M11 scale_features: z-scores of the 4 velocity features."""
    from packflow.operators.packs import velocity_profile
    m, fc = _chain(spark, d)
    from packflow.functions.exprs import round_half_even
    z = CL.scale_features(velocity_profile(m, fc))
    # z-scores are O(1): compared at 8 decimals (absolute), not relative
    return z.select("SkuId", *[round_half_even(f"z_{c}", 8).alias(f"z_{c}") for c in CL.VELOCITY_FEATURES])


_KM: dict = {}


def _kmeans(spark, d):
    k = (spark.sparkContext.applicationId, d)
    if k not in _KM:
        from packflow.operators.packs import velocity_profile
        m, fc = _chain(spark, d)
        _KM[k] = CL.cluster_velocity(velocity_profile(m, fc)).checkpoint(eager=True)
    return _KM[k]


@query("cluster_velocity", "SkuId:s, cluster:i, velocity_class:s, hist_mean:d")
def q_cluster_velocity(spark, d):
    """M12 cluster_velocity: KMeans k=3, 10 seeded restarts."""
    return _kmeans(spark, d).select("SkuId", "cluster", "velocity_class", "hist_mean")


@query("rank_clusters", "cluster:i, velocity_class:s, n_skus:i, mean_hist_mean:d")
def q_rank_clusters(spark, d):
    """M13 rank_clusters: fast > medium > slow by centre."""
    return _kmeans(spark, d).groupBy("cluster", "velocity_class").agg(
        F.count("*").alias("n_skus"), F.avg("hist_mean").alias("mean_hist_mean"))


# ---- KPIs -----------------------------------------------------------------------------

@query("stack_metric_rows", "Metric:s, Value:d",
       """SELECT * FROM (SELECT CAST(SUM("Before_AnnualRevenue") AS DOUBLE) AS "Before_TotalRevenue",
          CAST(SUM("After_AnnualRevenue") AS DOUBLE) AS "After_TotalRevenue",
          CAST(COUNT(*) AS DOUBLE) AS "Total_SKUs" FROM ledger) t
          UNPIVOT ("Value" FOR "Metric" IN ("Before_TotalRevenue", "After_TotalRevenue", "Total_SKUs"))""", PF)
def q_stack_metric_rows(spark, d):
    """U01 stack_metric_rows."""
    t = _ledger(spark, d).agg(F.sum("Before_AnnualRevenue").alias("Before_TotalRevenue"),
                              F.sum("After_AnnualRevenue").alias("After_TotalRevenue"),
                              F.count("*").alias("Total_SKUs"))
    return K.stack_metric_rows(t)


def _stored(df, name):
    """``df`` written to the shared folder and read back: several steps read it."""
    from packflow.session import shared_path
    path = shared_path(df.sparkSession, "kpi", name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _summaries(spark, d, reco=None):
    """Portfolio and dispatch summary; ``reco`` may hold stored recommendations."""
    from packflow.operators import finance as FI
    from packflow.operators import network as N
    from packflow.operators import dispatch as DP
    plan, nodes, w = _plan(spark, d)
    # read by the counts and by the means
    plan = _stored(plan.select("SkuId", "StorageLocationId", "CurrentLeadTimeDays", "OptimisedLeadTimeDays",
                               "LeadTimeReduction_Pct", "DispatchPriority"), "plan")
    table = (_ledger(spark, d) if reco is None
             else FI.financial_table(B.master_table(spark, d), reco, B.sell_prices(spark, d)))
    return FI.portfolio_summary(table), DP.dispatch_summary(plan, N.network_size(nodes, w))


def _bench_sql():
    rows = []
    spec = [("PBT Uplift %", "pbt", 10.0, 18.0), ("Revenue Uplift %", "rev", 8.0, 15.0),
            ("Inventory Reduction %", "inv", 20.0, 30.0), ("Lead Time Reduction %", "lt", 20.0, 30.0),
            ("Debtor Improvement %", "debt", 25.0, 35.0)]
    for name, k, lo, hi in spec:
        st = lambda v: (f"CASE WHEN {v} >= {lo}e0 AND {v} <= {hi}e0 THEN 'On Target' WHEN {v} > {hi}e0 "  # noqa: E731
                        f"THEN 'Above Target' ELSE 'Below Target' END")
        rows.append(f"SELECT '{name}' AS \"Metric\", {k}_c AS \"Achieved\", {lo}e0 AS \"Target_Min\", "
                    f"{hi}e0 AS \"Target_Max\", {st(k + '_c')} AS \"Status\", {k}_r AS \"Achieved_Raw\", "
                    f"{st(k + '_r')} AS \"Status_Raw\" FROM kp")
    return " UNION ALL ".join(rows)


_KP = {**PF, **NET}
_KP["totals"] = f"""SELECT SUM("Before_AnnualRevenue") AS tb_rev, SUM("After_AnnualRevenue") AS ta_rev,
    SUM("Before_PBT") AS tb_pbt, SUM("After_PBT") AS ta_pbt, SUM("Before_InventoryValue") AS tb_inv,
    SUM("After_InventoryValue") AS ta_inv, {emean("Before_DebtorDays", 6)} AS db,
    {emean("After_DebtorDays", 6)} AS da FROM ledger"""
_KP["kp"] = f"""SELECT pbt_r, {rhe('LEAST(GREATEST(pbt_r, 10.0e0), 18.0e0)', 2)} AS pbt_c,
    rev_r, {rhe('LEAST(GREATEST(rev_r, 8.0e0), 15.0e0)', 2)} AS rev_c,
    inv_r, {rhe('LEAST(GREATEST(inv_r, 20.0e0), 30.0e0)', 2)} AS inv_c,
    debt_r, {rhe('LEAST(GREATEST(debt_r, 25.0e0), 35.0e0)', 2)} AS debt_c,
    (SELECT {rhe(emean('LeadTimeReduction_Pct', 6), 1)} FROM dplan) AS lt_r,
    (SELECT {rhe(emean('LeadTimeReduction_Pct', 6), 1)} FROM dplan) AS lt_c
    FROM (SELECT CASE WHEN tb_pbt <> 0 THEN (ta_pbt - tb_pbt) / ABS(tb_pbt) * 100 ELSE 0.0e0 END AS pbt_r,
          CASE WHEN tb_rev <> 0 THEN (ta_rev - tb_rev) / ABS(tb_rev) * 100 ELSE 0.0e0 END AS rev_r,
          CASE WHEN tb_inv <> 0 THEN (tb_inv - ta_inv) / tb_inv * 100 ELSE 0.0e0 END AS inv_r,
          CASE WHEN db <> 0 THEN (db - da) / db * 100 ELSE 0.0e0 END AS debt_r FROM totals) t"""


@query("benchmark_comparison", """Metric:s, Achieved:x, Target_Min:x, Target_Max:x, Status:s,
Achieved_Raw:d, Status_Raw:s""", _bench_sql(), _KP)
def q_benchmark_comparison(spark, d):
    """E04 benchmark_comparison: reported (clamped) and raw status."""
    fin, disp = _summaries(spark, d)
    return K.benchmark_comparison(fin, disp)


def _pipeline_summary_sql():
    from packflow.plans.q_features import FEAT
    from packflow.plans.q_production import PLANT_STATS_SQL_FULL, UTIL_SQL, schedule_sql
    ctes = {**_KP, **FEAT}
    ctes["errs"] = f"""SELECT {rhe('SQRT(AVG(e * e))', 2)} AS demand_rmse,
        {rhe('AVG(ABS(e / (y + 1e-9))) * 100', 2)} AS demand_mape_pct
        FROM (SELECT "SalesOrderQty" - lag_1 AS e, "SalesOrderQty" AS y FROM split WHERE NOT is_train) t"""
    ctes["kpi_row"] = f"""SELECT e.demand_mape_pct, e.demand_rmse,
        (SELECT COUNT(DISTINCT "SkuId") FROM fcast) AS skus_forecasted,
        (SELECT COUNT(*) FILTER (WHERE "VelocityClass" = 'fast_mover') FROM reco_cap) AS fast_movers,
        (SELECT COUNT(*) FILTER (WHERE "VelocityClass" = 'medium_mover') FROM reco_cap) AS medium_movers,
        (SELECT COUNT(*) FILTER (WHERE "VelocityClass" = 'slow_mover') FROM reco_cap) AS slow_movers,
        (SELECT {rhe(emean('EstInventoryReductionPct', 6), 1)} FROM reco_cap) AS avg_inventory_reduction_pct,
        k.pbt_c AS pbt_uplift_pct, k.rev_c AS revenue_uplift_pct, k.inv_c AS inventory_reduction_pct,
        k.debt_c AS debtor_cycle_improvement_pct,
        (SELECT COUNT(*) FROM ({PLANT_STATS_SQL_FULL}) ps) AS plants_analysed,
        (SELECT {rhe('AVG("TargetUtilisation") * 100', 1)} FROM ({UTIL_SQL}) u) AS avg_plant_utilisation_pct,
        (SELECT {rhe('AVG("EstLeadTimeDays")', 1)} FROM ({schedule_sql(None)}) sc) AS avg_lead_time_days,
        k.lt_c AS avg_lead_time_reduction_pct,
        (SELECT COUNT(DISTINCT "StorageLocationId") FROM dplan) AS storage_locations
        FROM errs e CROSS JOIN kp k"""
    names = ["demand_mape_pct", "demand_rmse", "skus_forecasted", "fast_movers", "medium_movers",
             "slow_movers", "avg_inventory_reduction_pct", "pbt_uplift_pct", "revenue_uplift_pct",
             "inventory_reduction_pct", "debtor_cycle_improvement_pct", "plants_analysed",
             "avg_plant_utilisation_pct", "avg_lead_time_days", "avg_lead_time_reduction_pct",
             "storage_locations"]
    cast = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)
    sql = (f"SELECT * FROM (SELECT {cast} FROM kpi_row) t UNPIVOT (\"Value\" FOR \"Metric\" IN "
           f"({', '.join(names)}))")
    return sql, ctes


_PS_SQL, _PS_CTES = _pipeline_summary_sql()


@query("pipeline_summary", "Metric:s, Value:d", _PS_SQL, _PS_CTES)
def q_pipeline_summary(spark, d):
    """E03 pipeline_summary: the 16 KPIs of a run (naive forecast and rule
    classes, so the table is deterministic)."""
    from packflow.operators import production as P
    from packflow.operators.packs import optimize_packs, pack_summary
    m, fc = _chain(spark, d)
    # every table that several steps read is written once, narrow
    fc = _stored(fc.select("SkuId", "ForecastQty"), "forecast")
    reco = _stored(optimize_packs(m, fc, "rule")["recommendations"], "reco")
    fin, disp = _summaries(spark, d, reco)
    ps = _stored(P.plant_statistics(m), "plants")
    sch = _stored(P.production_schedule(m, ps, reco), "schedule")
    prod = P.production_summary(ps, sch, P.plant_utilisation(ps, sch))
    n = fc.agg(F.countDistinct("SkuId").alias("n"))
    daily = B.materialise(spark, "daily", d, lambda: FE.daily_series(m))
    rows = _stored(FE.filter_training_rows(FE.build_features(daily)).select("SkuId", "Date", "SalesOrderQty", "lag_1"), "rows")
    errs = FE.forecast_errors(FE.ordered_split(rows).where(~F.col("is_train")).withColumn("prediction", F.col("lag_1")))
    return K.pipeline_summary(errs, n, pack_summary(reco), fin, prod, disp)


@query("run_pipeline", "Metric:s, Value:d")
def q_run_pipeline(spark, d):
    """E05 run_pipeline: the full run (forest forecast, KMeans classes,
    revision loop); returns its KPI table."""
    from packflow.plans.pipeline import run_pipeline
    return run_pipeline(spark, d)["pipeline_summary"]
