"""End-to-end run (E05): load -> forecast -> packs -> finance (+ revision)
-> production -> dispatch -> KPIs, all as DataFrames.

The master panel is written once to the shared checkpoint folder and read
back by every step; SKU-grain tables of the revision loop are checkpointed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from packflow.config import ClusterConfig, ForecastConfig
from packflow.operators import dispatch as DP
from packflow.operators import finance as FI
from packflow.operators import forecast as FC
from packflow.operators import kpi as K
from packflow.operators import network as N
from packflow.operators import production as P
from packflow.operators import routes as R
from packflow.operators.explore import filter_panel
from packflow.sources import binding as B
from packflow.sources.sinks import write_results


def run_pipeline(spark: SparkSession, sf_dir: str | None = None, filters: dict | None = None,
                 forecast_cfg: ForecastConfig = ForecastConfig(),
                 classes: str = "kmeans", cluster_cfg: ClusterConfig | None = None,
                 max_revision_rounds: int = 2, master=None, prices=None, edges=None,
                 out_dir: str | None = None, timings: dict | None = None) -> dict:
    """Run every step; ``filters`` may carry ``sku_filter``,
    ``horizon_days``, ``group`` and ``plant``. A given ``master`` (see
    ``files.load_panel``) brings its own ``prices`` and storage ``edges``, or
    none; otherwise all three come from the tables under ``sf_dir``. With
    ``out_dir`` the eleven result tables are written there."""
    import time
    filters = filters or {}
    t = timings if timings is not None else {}

    def mark(name, t0, df=None):
        if df is not None:
            df.write.format("noop").mode("overwrite").save()  # every column of the step is computed
        t[name] = round(time.time() - t0, 3)

    t0 = time.time()
    if master is None:
        master = B.master_table(spark, sf_dir)
        if prices is None:
            prices = B.materialise(spark, "sell_prices", sf_dir, lambda: B.sell_prices(spark, sf_dir))
        if edges is None:
            edges = B.materialise(spark, "edges", sf_dir, lambda: B.storage_edges(spark, sf_dir))
    m = master
    m = filter_panel(m, filters.get("group"), filters.get("plant"))
    mark("load", t0)

    t0 = time.time()
    if "horizon_days" in filters:
        forecast_cfg = ForecastConfig(**{**forecast_cfg.__dict__, "horizon_days": filters["horizon_days"]})
    fc = FC.forecast(m, forecast_cfg, filters.get("sku_filter"))
    forecast = fc["forecast"].checkpoint(eager=True)
    mark("forecast", t0)

    t0 = time.time()
    rev = FI.revision_loop(m, forecast, prices, max_revision_rounds, classes, cluster_cfg)
    packs, finance = rev["packs"], rev["finance"]
    mark("packs_finance", t0)

    t0 = time.time()
    ps = P.plant_statistics(m).checkpoint(eager=True)
    schedule = P.production_schedule(m, ps, packs["recommendations"]).checkpoint(eager=True)
    util = P.plant_utilisation(ps, schedule).checkpoint(eager=True)
    prod_summary = P.production_summary(ps, schedule, util)
    mark("production", t0)

    t0 = time.time()
    nodes, w = N.graph(m, edges)
    locs = nodes.where(F.col("node_type") == "storage_location").select("node")
    # the plan needs one destination a location; the report of all pairs is a result of its own
    plan = DP.dispatch_plan(m, R.best_destinations(w, locs)).checkpoint(eager=True)
    routes = N.routing_paths(N.ordered_location_pairs(locs), N.shortest_paths(w)).checkpoint(eager=True)
    disp_summary = DP.dispatch_summary(plan, N.network_size(nodes, w))
    mark("dispatch", t0)

    t0 = time.time()
    n_skus = forecast.agg(F.countDistinct("SkuId").alias("n"))
    # each summary is one row, computed once for the two KPI tables and the export
    one = lambda df: df.checkpoint(eager=True) if df is not None else None
    metrics, rev["summary"], disp_summary, prod_summary = map(one, (fc["metrics"], rev["summary"], disp_summary, prod_summary))
    fc["metrics"] = metrics
    kpis = K.pipeline_summary(metrics, n_skus, packs["summary"], rev["summary"], prod_summary, disp_summary)
    kpis = kpis.checkpoint(eager=True)
    bench = K.benchmark_comparison(rev["summary"], disp_summary)
    mark("kpis", t0)

    res = {
        "master": m, "forecast": forecast, "actuals": fc["actuals"], "metrics": fc["metrics"],
        "recommendations": packs["recommendations"], "velocity_profile": packs["profile"],
        "financial_table": finance, "financial_summary": rev["summary"], "revision_rounds": rev["rounds"],
        "production_schedule": schedule, "plant_statistics": ps, "plant_utilisation": util,
        "production_summary": prod_summary, "high_risk_plants": P.high_risk_plants(ps), "dispatch_plan": plan, "routing_paths": routes,
        "dispatch_summary": disp_summary, "pipeline_summary": kpis, "benchmark_comparison": bench,
        "timings": t,
    }
    if out_dir is not None:
        t0 = time.time()
        res["exported"] = write_results(spark, out_dir, {n: res[k] for n, k in RESULT_TABLES.items()})
        mark("export", t0)
    return res


RESULT_TABLES = {
    "01_demand_forecast": "forecast", "02_pack_recommendations": "recommendations",
    "03_sku_velocity_profiles": "velocity_profile", "04_financial_impact": "financial_table",
    "05_production_schedule": "production_schedule", "06_plant_statistics": "plant_statistics",
    "07_plant_utilisation": "plant_utilisation", "08_dispatch_plan": "dispatch_plan",
    "09_routing_paths": "routing_paths", "10_pipeline_summary_kpis": "pipeline_summary",
    "11_benchmark_comparison": "benchmark_comparison",
}
