"""Bounded best routes, components and two-hop labels against the all-pairs job."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from packflow.operators import dispatch as DP
from packflow.operators import network as N
from packflow.operators import routes as R


def graph(spark, seed, n, m, places=None):
    """A random graph; some vertices are no locations."""
    rng = np.random.RandomState(seed)
    edges = {}
    for _ in range(m):
        a, b = sorted(rng.choice(n, 2, replace=False))
        w = rng.rand() + 0.01
        edges[(f"N{a:02d}", f"N{b:02d}")] = float(round(w, places) if places else w)
    w = spark.createDataFrame([(*k, v) for k, v in edges.items()], "a string, b string, weight double")
    locs = spark.createDataFrame([(f"N{i:02d}",) for i in range(n) if i % 3], "node string")
    return w.checkpoint(), locs


def all_pairs(w, locs):
    return N.routing_paths(N.ordered_location_pairs(locs), N.shortest_paths(w))


@pytest.mark.parametrize("seed, places", [(1, None), (2, 1)])
def test_best_destinations(spark, seed, places):
    """Equal to the choice among all pairs, with ties (weights of one digit) and
    paths through vertices that are no locations."""
    w, locs = graph(spark, seed, 24, 30, places)
    want = {tuple(r) for r in N.best_route(all_pairs(w, locs)).collect()}
    assert {tuple(r) for r in R.best_destinations(w, locs).collect()} == want and want


def test_rounding_ties_go_to_direct_edges(spark):
    """A - B - C is within the rounding of A - C and B: hops, then names decide."""
    w = spark.createDataFrame([("A", "C", 0.00004), ("B", "C", 0.000005), ("A", "B", 0.000045)],
                              "a string, b string, weight double")
    locs = spark.createDataFrame([(x,) for x in "ABC"], "node string")
    got = {tuple(r) for r in R.best_destinations(w, locs).collect()}
    assert got == {tuple(r) for r in N.best_route(all_pairs(w, locs)).collect()}


def test_components_and_unreachable(spark):
    chain = [(f"C{i:02d}", f"C{i + 1:02d}", 1.0) for i in range(20)]
    w = spark.createDataFrame(chain + [("X", "Y", 1.0)], "a string, b string, weight double")
    comp = {r["node"]: r["component"] for r in R.components(w).collect()}
    assert {comp[f"C{i:02d}"] for i in range(21)} == {"C00"} and comp["Y"] == "X"
    locs = spark.createDataFrame([("C00",), ("C20",), ("X",), ("lone",)], "node string")
    got = {tuple(r) for r in R.unreachable(N.ordered_location_pairs(locs), w).collect()}
    want = {(r["Source"], r["Destination"]) for r in all_pairs(w, locs).where(~F.col("Reachable")).collect()}
    assert got == want and len(got) == 10


def test_labels_answer_pairs(spark):
    w, locs = graph(spark, 5, 20, 26)
    labels = R.landmark_labels(w).checkpoint()
    pairs = N.ordered_location_pairs(locs)
    got = {(r["Source"], r["Destination"]): r for r in R.routes_between(pairs, labels).collect()}
    want = {(r["Source"], r["Destination"]): r for r in N.shortest_paths(w).join(pairs, ["Source", "Destination"]).collect()}
    assert set(got) == set(want) and want
    for k, r in want.items():
        assert (got[k]["Path"], got[k]["Hops"]) == (r["Path"], r["Hops"])
        assert got[k]["weight"] == pytest.approx(r["weight"], abs=1e-12)
    # labels are fewer than all pairs of a vertex with the vertices it reaches
    assert labels.count() < N.shortest_paths(w).count()


def test_no_edges(spark):
    w = spark.createDataFrame([], "a string, b string, weight double")
    locs = spark.createDataFrame([("A",), ("B",)], "node string")
    assert R.best_destinations(w, locs).count() == 0
    assert R.routes_between(N.ordered_location_pairs(locs), R.landmark_labels(w)).count() == 0
    assert R.unreachable(N.ordered_location_pairs(locs), w).count() == 2


def test_dispatch_plan_has_no_pair_table(spark):
    from conftest import SF0001
    from packflow.plans.q_network import _plan
    plan = _plan(spark, SF0001)[0]._jdf.queryExecution().optimizedPlan().toString()
    # the only unconditioned joins are with one-row aggregates
    assert plan.count("Join Cross") <= 1 and "BroadcastNestedLoop" not in plan
    assert DP.PLAN_COLS[0] in plan
