"""Location network and routes.

Shortest paths are a distributed Bellman-Ford: only pairs whose best route
improved in the last round (the frontier) are extended by one edge; the
candidates are reduced with ``min(struct(weight, hops, path))`` per
(source, destination), a partial aggregate. Rounds stop when nothing
improves (at most V - 1 rounds); each round's tables are checkpointed to the
shared folder so the lineage stays one round deep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.functions.exprs import round_half_even
from packflow.operators.common import mean
from packflow.operators.ranking import global_index


def mean_delivery_by_key(master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean delivery per storage location and per SKU."""
    per_loc = master.groupBy(F.col("StorageLocationId").alias("node")).agg(
        mean("DeliveryQty").alias("avg_delivery"))
    per_sku = master.groupBy(F.col("SkuId").alias("node")).agg(mean("DeliveryQty").alias("avg_delivery"))
    return per_loc, per_sku


def network_nodes(master: DataFrame, edges: DataFrame) -> DataFrame:
    """Locations with their mean delivery; other edge endpoints are
    typed ``sku``."""
    per_loc, _ = mean_delivery_by_key(master)
    locs = (master.select(F.col("StorageLocationId").alias("node")).where(F.col("node").isNotNull())
            .distinct().join(per_loc, "node", "left")
            .withColumn("node_type", F.lit("storage_location")))
    ends = (edges.select(F.col("node1").alias("node")).union(edges.select(F.col("node2").alias("node")))
            .distinct().join(locs.select("node"), "node", "left_anti")
            .select("node", F.lit(None).cast("double").alias("avg_delivery"),
                    F.lit("sku").alias("node_type")))
    return locs.unionByName(ends)


def join_edge_endpoints(edges: DataFrame, volumes: DataFrame) -> DataFrame:
    """Both endpoints' mean volume, absent -> 0."""
    v1 = volumes.select(F.col("node").alias("node1"), F.col("avg_delivery").alias("v1"))
    v2 = volumes.select(F.col("node").alias("node2"), F.col("avg_delivery").alias("v2"))
    return (edges.join(v1, "node1", "left").join(v2, "node2", "left")
            .na.fill(0.0, subset=["v1", "v2"]))


def network_edges(master: DataFrame, edges: DataFrame) -> DataFrame:
    """Undirected weighted edges, weight 1 / (v + 1) with v the mean of
    the endpoint volumes (1.0 when v <= 0); self loops and blanks dropped;
    one row per unordered pair (a < b), the smallest weight kept."""
    e = edges.where(F.col("node1").isNotNull() & F.col("node2").isNotNull()
                    & (F.col("node1") != "") & (F.col("node2") != "")
                    & (F.col("node1") != F.col("node2")))
    # means of the endpoints alone: where edges join locations, no SKU is summed up
    ends = e.select(F.col("node1").alias("node")).union(e.select(F.col("node2").alias("node"))).distinct()
    own = lambda key: master.join(ends, F.col(key) == F.col("node"), "left_semi").groupBy(
        F.col(key).alias("node")).agg(mean("DeliveryQty").alias("avg_delivery"))
    volumes = own("StorageLocationId").unionByName(own("SkuId"))
    j = join_edge_endpoints(e.select("node1", "node2"), volumes)
    v = (F.col("v1") + F.col("v2")) / 2
    w = F.when(v > 0, 1 / (v + 1)).otherwise(F.lit(1.0))
    return (j.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b"),
                     w.alias("weight"))
            .groupBy("a", "b").agg(F.min("weight").alias("weight")))


def ring_fallback(locations: DataFrame) -> DataFrame:
    """Connect the locations in a ring (sorted order), weight 1."""
    r = global_index(locations.select("node").distinct(), ["node"], "rn")
    n = r.agg(F.count("*").alias("n"))
    nxt = r.crossJoin(F.broadcast(n)).withColumn("nrn", F.pmod(F.col("rn") + 1, F.col("n")))
    pairs = nxt.alias("x").join(r.alias("y"), F.col("x.nrn") == F.col("y.rn")).select(
        F.col("x.node").alias("n1"), F.col("y.node").alias("n2")).where(F.col("n1") != F.col("n2"))
    return (pairs.select(F.least("n1", "n2").alias("a"), F.greatest("n1", "n2").alias("b"))
            .distinct().withColumn("weight", F.lit(1.0)))


def graph(master: DataFrame, edges: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(nodes, weighted undirected edges); the ring when no edge exists."""
    e = edges if edges is not None else master.sparkSession.createDataFrame(
        [], "node1 string, node2 string")
    nodes = network_nodes(master, e)
    w = network_edges(master, e).checkpoint(eager=True)  # tested, then read by routes and size
    if w.isEmpty():
        w = ring_fallback(nodes.where(F.col("node_type") == "storage_location"))
    return nodes, w


def network_size(nodes: DataFrame, wedges: DataFrame) -> DataFrame:
    """Node and edge counts."""
    return nodes.agg(F.count("*").alias("network_nodes")).crossJoin(
        wedges.agg(F.count("*").alias("network_edges")))


def shortest_paths(wedges: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Best route for every reachable ordered pair: (Source,
    Destination, Path text, Hops, weight). Ties: weight, hops, path."""
    d = (wedges.select(F.col("a").alias("x"), F.col("b").alias("y"), "weight")
         .unionByName(wedges.select(F.col("b").alias("x"), F.col("a").alias("y"), "weight")))
    d = d.checkpoint(eager=True)
    best = d.select(F.col("x").alias("Source"), F.col("y").alias("Destination"),
                    F.struct(F.col("weight").alias("w"), F.lit(1).alias("h"),
                             F.concat_ws(" -> ", "x", "y").alias("p")).alias("s"))
    best = best.groupBy("Source", "Destination").agg(F.min("s").alias("s")).checkpoint(eager=True)
    frontier = best
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        cand = (frontier.join(d, frontier.Destination == d.x)
                .where(F.col("Source") != F.col("y"))
                .select("Source", F.col("y").alias("Destination"),
                        F.struct((F.col("s.w") + F.col("weight")).alias("w"),
                                 (F.col("s.h") + 1).alias("h"),
                                 F.concat_ws(" -> ", F.col("s.p"), F.col("y")).alias("p")).alias("s"))
                .groupBy("Source", "Destination").agg(F.min("s").alias("c")))
        improved = (cand.join(best, ["Source", "Destination"], "left")
                    .where(F.col("s").isNull() | (F.col("c") < F.col("s")))
                    .select("Source", "Destination", F.col("c").alias("s"))).checkpoint(eager=True)
        if improved.isEmpty():
            break
        best = (best.join(improved.select("Source", "Destination"), ["Source", "Destination"], "left_anti")
                .unionByName(improved)).checkpoint(eager=True)
        frontier = improved
        rounds += 1
    return best.select("Source", "Destination", F.col("s.p").alias("Path"),
                       F.col("s.h").cast("bigint").alias("Hops"), F.col("s.w").alias("weight"))


def ordered_location_pairs(locations: DataFrame) -> DataFrame:
    """All ordered pairs of distinct locations (dimension x dimension)."""
    l1 = locations.select(F.col("node").alias("Source"))
    l2 = locations.select(F.col("node").alias("Destination"))
    return l1.crossJoin(l2).where(F.col("Source") != F.col("Destination"))


def routing_paths(pairs: DataFrame, paths: DataFrame) -> DataFrame:
    """G05 + G06: every ordered location pair; unreachable -> 'NO PATH',
    hops -1, null weight, reachable false. Weight rounded to 4 places."""
    j = pairs.join(paths, ["Source", "Destination"], "left")
    ok = F.col("Path").isNotNull()
    return j.select("Source", "Destination",
                    F.when(ok, F.col("Path")).otherwise(F.lit("NO PATH")).alias("Path"),
                    F.when(ok, F.col("Hops")).otherwise(F.lit(-1).cast("bigint")).alias("Hops"),
                    round_half_even("weight", 4).alias("PathWeight"),
                    ok.alias("Reachable"))


def best_route(routes: DataFrame) -> DataFrame:
    """Cheapest reachable destination per source (ties: weight,
    hops, destination, path)."""
    r = routes.where("Reachable")
    s = F.struct("PathWeight", "Hops", "Destination", "Path")
    return (r.groupBy("Source").agg(F.min(s).alias("b"))
            .select(F.col("Source").alias("StorageLocationId"), F.col("b.Destination").alias("Destination"),
                    F.col("b.Path").alias("Path"), F.col("b.Hops").alias("Hops"),
                    F.col("b.PathWeight").alias("PathWeight")))
