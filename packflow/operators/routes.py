"""Routes without the table of all pairs.

* ``best_destinations``: the cheapest destination of every location by a
  bounded search. With positive weights nothing behind a location can be
  cheaper than the cheapest location found so far, so a source stops growing
  once its frontier passes that weight. Where every edge joins two locations
  this is the lightest incident edge and one short round.
* ``components``: component ids by least-label propagation with pointer jumps.
* ``landmark_labels``: two-hop labels by pruned landmark search. Vertices are
  ranked by degree; batches of landmarks (1, 4, 16, ...) grow their shortest
  path trees at once and drop a vertex that the labels of earlier batches
  already reach as cheaply. ``routes_between`` answers the pairs it is given
  from one join of their labels.

Weights must be positive; edges are undirected (a, b, weight), one row a pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.functions.exprs import round_half_even
from packflow.operators.ranking import global_index

ROUTE = ["Source", "Destination", "Path", "Hops", "weight"]


def directed(wedges: DataFrame) -> DataFrame:
    """Both directions of every edge: x, y, weight."""
    return (wedges.select(F.col("a").alias("x"), F.col("b").alias("y"), "weight")
            .unionByName(wedges.select(F.col("b").alias("x"), F.col("a").alias("y"), "weight")))


def _step(w: F.Column, h: F.Column, p: F.Column) -> F.Column:
    return F.struct(w.alias("w"), h.alias("h"), p.alias("p"))


def best_destinations(wedges: DataFrame, locations: DataFrame, digits: int = 4) -> DataFrame:
    """StorageLocationId, Destination, Path, Hops, PathWeight of the
    cheapest other location of each location: by weight rounded to ``digits``
    places, then hops, destination and path. Locations that reach no other have
    no row. ``locations`` has one column, ``node``."""
    d = directed(wedges).checkpoint(eager=True)
    locs = locations.select("node").where(F.col("node").isNotNull()).distinct().withColumn("is_loc", F.lit(True))
    text = lambda *c: F.concat_ws(" -> ", *c)
    first = d.join(locs.select(F.col("node").alias("x")), "x", "left_semi").select(
        F.col("x").alias("Source"), F.col("y").alias("node"), _step(F.col("weight"), F.lit(1), text("x", "y")).alias("s"))
    half = 0.5 * 10.0 ** -digits
    # weights that round to the same value as the cheapest location are still needed for the ties
    bound = (round_half_even(F.col("least"), digits) + half).alias("bound")

    def kept(state: DataFrame) -> DataFrame:
        """State with its source's bound, entries beyond the bound dropped."""
        own = state.join(locs, "node", "left")
        least = own.where("is_loc").groupBy("Source").agg(F.min("s.w").alias("least")).select("Source", bound)
        out = own.join(least, "Source", "left")
        return out.where(F.col("bound").isNull() | (F.col("s.w") <= F.col("bound")))

    state = kept(first.groupBy("Source", "node").agg(F.min("s").alias("s"))).checkpoint(eager=True)
    frontier = state
    while True:
        grown = (frontier.where(F.col("bound").isNull() | (F.col("s.w") < F.col("bound")))
                 .join(d, F.col("node") == F.col("x")).where(F.col("y") != F.col("Source"))
                 .select("Source", F.col("y").alias("node"),
                         _step(F.col("s.w") + F.col("weight"), F.col("s.h") + 1, text(F.col("s.p"), F.col("y"))).alias("c"),
                         "bound")
                 .where(F.col("bound").isNull() | (F.col("c.w") <= F.col("bound")))
                 .groupBy("Source", "node").agg(F.min("c").alias("c")))
        better = (grown.join(state.select("Source", "node", "s"), ["Source", "node"], "left")
                  .where(F.col("s").isNull() | (F.col("c") < F.col("s")))
                  .select("Source", "node", F.col("c").alias("s"))).checkpoint(eager=True)
        if better.isEmpty():
            break
        state = kept(state.select("Source", "node", "s").join(better.select("Source", "node"), ["Source", "node"], "left_anti")
                     .unionByName(better)).checkpoint(eager=True)
        frontier = state.join(better.select("Source", "node"), ["Source", "node"], "left_semi")
    best = F.struct(round_half_even(F.col("s.w"), digits).alias("PathWeight"), F.col("s.h").cast("bigint").alias("Hops"),
                    F.col("node").alias("Destination"), F.col("s.p").alias("Path"))
    return (state.where("is_loc").groupBy("Source").agg(F.min(best).alias("b"))
            .select(F.col("Source").alias("StorageLocationId"), "b.Destination", "b.Path", "b.Hops", "b.PathWeight"))


def components(wedges: DataFrame) -> DataFrame:
    """node, component (its least node) of every endpoint. Labels move along
    edges and then jump to their label's label, so rounds are few even on long
    chains."""
    d = directed(wedges).select("x", "y").checkpoint(eager=True)
    label = d.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("component")).withColumnRenamed("x", "node")
    label = label.checkpoint(eager=True)
    while True:
        near = (d.join(label, d["y"] == label["node"]).groupBy("x").agg(F.min("component").alias("near"))
                .select(F.col("x").alias("node"), "near"))
        low = label.join(near, "node").select("node", F.least("component", "near").alias("low"), "component")
        jump = low.select(F.col("node").alias("low"), F.col("low").alias("far"))
        new = (low.join(jump, "low", "left")
               .select("node", F.least("low", F.coalesce("far", "low")).alias("next"), "component")).checkpoint(eager=True)
        label = new.select("node", F.col("next").alias("component"))
        if new.where(F.col("next") != F.col("component")).isEmpty():
            return label


def unreachable(pairs: DataFrame, wedges: DataFrame) -> DataFrame:
    """The given (Source, Destination) pairs that no path joins, by
    component ids; a location without an edge is a component of its own."""
    comp = components(wedges)
    side = lambda c, name: comp.select(F.col("node").alias(c), F.col("component").alias(name))
    j = pairs.join(side("Source", "cs"), "Source", "left").join(side("Destination", "cd"), "Destination", "left")
    return j.where((F.col("Source") != F.col("Destination"))
                   & ~F.coalesce(F.col("cs") == F.col("cd"), F.lit(False))).select("Source", "Destination")


def landmark_labels(wedges: DataFrame, growth: int = 4) -> DataFrame:
    """Two-hop labels: node, hub, s = struct(weight, hops, nodes from the hub
    to the node). For any two connected vertices some hub on a shortest path of
    theirs is in both their labels."""
    d = directed(wedges).checkpoint(eager=True)
    degree = d.groupBy(F.col("x").alias("node")).agg(F.count("*").alias("degree"))
    ranked = global_index(degree, [F.desc("degree"), F.asc("node")], "rank").select("node", "rank")
    total = ranked.count()
    labels = None
    lo, size = 0, 1
    while lo < total:
        batch = ranked.where((F.col("rank") >= lo) & (F.col("rank") < lo + size)).select(F.col("node").alias("hub"))
        tree = batch.select("hub", F.col("hub").alias("node"), _step(F.lit(0.0), F.lit(0), F.array("hub")).alias("s"))
        tree = tree.checkpoint(eager=True)
        frontier = tree
        while True:
            grown = (frontier.join(d, F.col("node") == F.col("x"))
                     .select("hub", F.col("y").alias("node"),
                             _step(F.col("s.w") + F.col("weight"), F.col("s.h") + 1,
                                   F.array_append("s.p", F.col("y"))).alias("c"))
                     .groupBy("hub", "node").agg(F.min("c").alias("c")))
            better = (grown.join(tree, ["hub", "node"], "left")
                      .where(F.col("s").isNull() | (F.col("c") < F.col("s")))
                      .select("hub", "node", F.col("c").alias("s")))
            if labels is not None:
                better = _pruned(better, labels)
            better = better.checkpoint(eager=True)
            if better.isEmpty():
                break
            tree = (tree.join(better.select("hub", "node"), ["hub", "node"], "left_anti").unionByName(better)
                    .checkpoint(eager=True))
            frontier = better
        labels = tree if labels is None else labels.unionByName(tree).checkpoint(eager=True)
        lo, size = lo + size, size * growth
    if labels is None:
        return wedges.select(F.col("a").alias("hub"), F.col("b").alias("node"),
                             _step(F.col("weight"), F.lit(1), F.array("a", "b")).alias("s")).limit(0)
    return labels


def _pruned(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (hub, node, s) that the labels do not already answer as cheaply."""
    from_hub = labels.select(F.col("node").alias("hub"), F.col("hub").alias("via"), F.col("s.w").alias("w1"))
    to_node = labels.select("node", F.col("hub").alias("via"), F.col("s.w").alias("w2"))
    known = (found.select("hub", "node").join(from_hub, "hub").join(to_node, ["node", "via"])
             .groupBy("hub", "node").agg(F.min(F.col("w1") + F.col("w2")).alias("known")))
    return (found.join(known, ["hub", "node"], "left")
            .where(F.col("known").isNull() | (F.col("s.w") < F.col("known"))).select("hub", "node", "s"))


def routes_between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The cheapest route of each given (Source, Destination) pair: Path, Hops,
    weight; pairs that no path joins have no row. Equal weights go to fewer
    hops, then to the first path by its nodes."""
    up = labels.select(F.col("node").alias("Source"), F.col("hub"), F.col("s").alias("u"))
    down = labels.select(F.col("node").alias("Destination"), F.col("hub"), F.col("s").alias("v"))
    path = F.concat(F.reverse("u.p"), F.slice("v.p", F.lit(2), F.size("v.p")))
    asked = pairs.select("Source", "Destination").where(F.col("Source") != F.col("Destination")).distinct()
    met = (asked.join(up, "Source").join(down, ["Destination", "hub"])
           .groupBy("Source", "Destination")
           .agg(F.min(_step(F.col("u.w") + F.col("v.w"), F.col("u.h") + F.col("v.h"), path)).alias("s")))
    return met.select("Source", "Destination", F.array_join("s.p", " -> ").alias("Path"),
                      F.col("s.h").cast("bigint").alias("Hops"), F.col("s.w").alias("weight"))
