"""Spark result == DuckDB oracle on the driver tables (sf0.001) for a
cross-section of the catalogue; the full catalogue runs at sf0.01 with
``python tools/oracle_check.py``."""

import pytest

from conftest import SF0001

SAMPLE = ["plant_statistics", "production_schedule", "build_master", "join_signals", "unpivot_panel",
          "pack_recommendations", "financial_table", "portfolio_summary", "shortest_paths",
          "unreachable_pairs", "dispatch_plan", "build_features", "ordered_split", "horizon_frame",
          "demand_cv", "describe_panel", "correlation_matrix", "volatility_group_month",
          "top_dispatch", "benchmark_comparison", "read_calendar", "read_results", "revision_loop",
          "pipeline_summary", "schema_report", "read_signals", "top_lead_time"]


@pytest.fixture(scope="module")
def duck():
    from tools.oracle_check import duck as mk
    return mk(SF0001)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, duck, name):
    from packflow.plans.catalog import REGISTRY
    from tools.oracle_check import compare
    st, n, *_ , msg = compare(spark, duck, name, REGISTRY[name], SF0001)
    assert st == "ok", msg
    assert n >= 0


def test_entry_contract(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 177
