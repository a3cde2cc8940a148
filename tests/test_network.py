"""Routes on hand-made graphs: empty edges (ring), two components, a
duplicate reversed edge, a self loop, equal-cost ties."""

from pyspark.sql import functions as F

from packflow.operators import network as N


def edges(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, weight double")


def test_two_components_and_ties(spark):
    w = edges(spark, [("A", "B", 1.0), ("B", "C", 1.0), ("A", "C", 2.0), ("D", "E", 1.0)])
    paths = {(r.Source, r.Destination): r for r in N.shortest_paths(w).collect()}
    # A->C: direct (2.0, 1 hop) beats A->B->C (2.0, 2 hops) on hops
    assert paths[("A", "C")].Path == "A -> C" and paths[("A", "C")].Hops == 1
    assert ("A", "D") not in paths and paths[("D", "E")].weight == 1.0
    locs = spark.createDataFrame([(x,) for x in "ABCDE"], "node string")
    routes = N.routing_paths(N.ordered_location_pairs(locs), N.shortest_paths(w))
    nopath = routes.where(~F.col("Reachable")).collect()
    assert len(nopath) == 12 and all(r.Hops == -1 and r.Path == "NO PATH" and r.PathWeight is None for r in nopath)


def test_relaxation_finds_cheaper_long_path(spark):
    w = edges(spark, [("A", "D", 10.0), ("A", "B", 1.0), ("B", "C", 1.0), ("C", "D", 1.0)])
    p = {(r.Source, r.Destination): r for r in N.shortest_paths(w).collect()}
    assert p[("A", "D")].Path == "A -> B -> C -> D" and p[("A", "D")].weight == 3.0


def test_edges_dedup_self_loop_and_ring(spark):
    m = spark.createDataFrame([("L1", "S", 10.0), ("L2", "S", 30.0), ("L3", "S", 0.0)],
                              "StorageLocationId string, SkuId string, DeliveryQty double")
    raw = spark.createDataFrame([("L1", "L2"), ("L2", "L1"), ("L1", "L1"), ("L3", "")], "node1 string, node2 string")
    w = N.network_edges(m, raw).collect()
    assert len(w) == 1 and w[0].a == "L1" and abs(w[0].weight - 1 / 21) < 1e-12
    empty = spark.createDataFrame([], "node1 string, node2 string")
    nodes, ring = N.graph(m, empty)
    assert sorted((r.a, r.b) for r in ring.collect()) == [("L1", "L2"), ("L1", "L3"), ("L2", "L3")]
