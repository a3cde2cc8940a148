"""Queries: network, routes, dispatch (A07, A11, J11, J14-J15, G01-G13, W09,
W11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from packflow.operators import dispatch as DP
from packflow.operators import network as N
from packflow.operators import routes as R
from packflow.plans.oracle_base import recursive_cte
from packflow.plans.registry import query
from packflow.plans.sqlfrag import bins, clip, emean, first_by, rhe
from packflow.sources import binding as B

_PN, _PB = recursive_cte("paths", "src, dst, w, hops, path, nodes", """
    SELECT x, y, w, 1, x || ' -> ' || y, [x, y] FROM dir
    UNION ALL
    SELECT p.src, d.y, p.w + d.w, p.hops + 1, p.path || ' -> ' || d.y, list_append(p.nodes, d.y)
    FROM paths p JOIN dir d ON p.dst = d.x
    WHERE NOT list_contains(p.nodes, d.y)""")

NET = {
    "loc": """SELECT DISTINCT "StorageLocationId" AS node FROM master WHERE "StorageLocationId" IS NOT NULL""",
    "vol": """SELECT "StorageLocationId" AS node, SUM("DeliveryQty") / COUNT("DeliveryQty") AS avg_delivery
        FROM master GROUP BY 1""",
    "vol_sku": """SELECT "SkuId" AS node, SUM("DeliveryQty") / COUNT("DeliveryQty") AS avg_delivery
        FROM master GROUP BY 1""",
    "endpoints": """SELECT e.node1, e.node2, COALESCE(v1.avg_delivery, 0.0e0) AS v1,
        COALESCE(v2.avg_delivery, 0.0e0) AS v2 FROM edges e
        LEFT JOIN vol v1 ON e.node1 = v1.node LEFT JOIN vol v2 ON e.node2 = v2.node
        WHERE e.node1 IS NOT NULL AND e.node2 IS NOT NULL AND e.node1 <> '' AND e.node2 <> ''
          AND e.node1 <> e.node2""",
    "wedges": """SELECT LEAST(node1, node2) AS a, GREATEST(node1, node2) AS b,
        MIN(CASE WHEN (v1 + v2) / 2 > 0 THEN 1 / ((v1 + v2) / 2 + 1) ELSE 1.0e0 END) AS weight
        FROM endpoints GROUP BY 1, 2""",
    "dir": """SELECT a AS x, b AS y, weight AS w FROM wedges UNION ALL SELECT b, a, weight FROM wedges""",
    _PN: _PB,
    "best_paths": """SELECT src AS "Source", dst AS "Destination", path AS "Path", hops AS "Hops", w
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY src, dst ORDER BY w, hops, path) AS rn FROM paths) t
        WHERE rn = 1""",
    "pairs": """SELECT l1.node AS "Source", l2.node AS "Destination" FROM loc l1 CROSS JOIN loc l2
        WHERE l1.node <> l2.node""",
    "routes": f"""SELECT p."Source", p."Destination", COALESCE(b."Path", 'NO PATH') AS "Path",
        COALESCE(b."Hops", -1) AS "Hops", {rhe('b.w', 4)} AS "PathWeight", b."Path" IS NOT NULL AS "Reachable"
        FROM pairs p LEFT JOIN best_paths b ON p."Source" = b."Source" AND p."Destination" = b."Destination\"""",
    "best_route": """SELECT "Source" AS "StorageLocationId", "Destination", "Path", "Hops", "PathWeight"
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "Source" ORDER BY "PathWeight", "Hops",
              "Destination", "Path") AS rn FROM routes WHERE "Reachable") t WHERE rn = 1""",
    "dbase": f"""SELECT "SkuId", "StorageLocationId", SUM("DeliveryQty") / COUNT("DeliveryQty") AS "AvgDeliveryQty",
        SUM("DeliveryQty") AS "TotalDeliveryQty", SUM("SalesOrderQty") / COUNT("SalesOrderQty") AS "AvgSalesOrderQty",
        {first_by("ProductGroup")} AS "ProductGroup", {first_by("PlantId")} AS "PlantId"
        FROM master GROUP BY 1, 2""",
    "dscaled": f"""SELECT d.*, {rhe('15 - (CASE WHEN mm.hi > mm.lo THEN (GREATEST(d."AvgDeliveryQty", 1.0e0) - mm.lo) / (mm.hi - mm.lo) ELSE 0.5e0 END) * 10', 1)} AS "CurrentLeadTimeDays"
        FROM dbase d CROSS JOIN (SELECT MIN(GREATEST("AvgDeliveryQty", 1.0e0)) AS lo,
        MAX(GREATEST("AvgDeliveryQty", 1.0e0)) AS hi FROM dbase) mm""",
    "dplan0": """SELECT s.*, b."Destination", COALESCE(b."Path", 'DIRECT') AS "Path",
        COALESCE(b."Hops", 1) AS "Hops", COALESCE(b."PathWeight", 1.0e0) AS "PathWeight"
        FROM dscaled s LEFT JOIN best_route b ON s."StorageLocationId" = b."StorageLocationId\"""",
    "dplan": f"""SELECT "SkuId", "StorageLocationId", "AvgDeliveryQty", "TotalDeliveryQty", "AvgSalesOrderQty",
        "ProductGroup", "PlantId", "CurrentLeadTimeDays", "Destination", "Path", "Hops", "PathWeight",
        {rhe('GREATEST("CurrentLeadTimeDays" * (1.0e0 - (29.0e0 - ' + clip('("CurrentLeadTimeDays" - 5.0e0) / 10.0e0', '0.0e0', '1.0e0') + ' * 8.0e0) / 100.0e0), 1.0e0)', 1)} AS "OptimisedLeadTimeDays",
        {rhe('("CurrentLeadTimeDays" - "OptimisedLeadTimeDays") / "CurrentLeadTimeDays" * 100.0e0', 1)} AS "LeadTimeReduction_Pct",
        {bins('"AvgDeliveryQty"', ("Standard", "Priority", "Express"))} AS "DispatchPriority"
        FROM dplan0""",
}


def _edges(spark, d):
    return B.materialise(spark, "edges", d, lambda: B.storage_edges(spark, d))


def _graph(spark, d, m=None):
    """The deliveries (or the panel ``m`` that a query needs besides), nodes and edges."""
    m = m if m is not None else B.deliveries_table(spark, d)
    nodes, w = N.graph(m, _edges(spark, d))
    return m, nodes, w


def _locations(nodes):
    return nodes.where(F.col("node_type") == "storage_location").select("node")


def _routes(spark, d):
    """The report of all pairs."""
    m, nodes, w = _graph(spark, d)
    return m, nodes, w, N.routing_paths(N.ordered_location_pairs(_locations(nodes)), N.shortest_paths(w))


def _plan(spark, d):
    m, nodes, w = _graph(spark, d, B.master_table(spark, d))
    return DP.dispatch_plan(m, R.best_destinations(w, _locations(nodes))), nodes, w


@query("mean_delivery_by_key", "kind:s, node:s, avg_delivery:d",
       """SELECT 'storage' AS kind, * FROM vol UNION ALL SELECT 'sku' AS kind, * FROM vol_sku""", NET)
def q_mean_delivery_by_key(spark, d):
    """A11 mean_delivery_by_key."""
    loc, sku = N.mean_delivery_by_key(B.master_table(spark, d))
    return (loc.select(F.lit("storage").alias("kind"), "*")
            .unionByName(sku.select(F.lit("sku").alias("kind"), "*")))


@query("join_edge_endpoints", "node1:s, node2:s, v1:d, v2:d", "SELECT * FROM endpoints", NET)
def q_join_edge_endpoints(spark, d):
    """J14 join_edge_endpoints."""
    loc, _ = N.mean_delivery_by_key(B.master_table(spark, d))
    return N.join_edge_endpoints(_edges(spark, d), loc).select("node1", "node2", "v1", "v2")


@query("network_edges", "a:s, b:s, weight:d", "SELECT * FROM wedges", NET)
def q_network_edges(spark, d):
    """G01 network_edges."""
    return _graph(spark, d)[2]


@query("network_nodes", "node:s, avg_delivery:d, node_type:s",
       """SELECT l.node, v.avg_delivery, 'storage_location' AS node_type FROM loc l LEFT JOIN vol v ON l.node = v.node
          UNION ALL SELECT e.node, NULL, 'sku' FROM (SELECT node1 AS node FROM edges UNION SELECT node2 FROM edges) e
          WHERE e.node NOT IN (SELECT node FROM loc)""", NET)
def q_network_nodes(spark, d):
    """G02 network_nodes."""
    return _graph(spark, d)[1]


@query("ring_fallback", "a:s, b:s, weight:x",
       """SELECT DISTINCT LEAST(n1, n2) AS a, GREATEST(n1, n2) AS b, 1.0e0 AS weight FROM (
            SELECT x.node AS n1, y.node AS n2 FROM
            (SELECT node, ROW_NUMBER() OVER (ORDER BY node) - 1 AS rn FROM loc) x
            CROSS JOIN (SELECT COUNT(*) AS n FROM loc) c
            JOIN (SELECT node, ROW_NUMBER() OVER (ORDER BY node) - 1 AS rn FROM loc) y
              ON y.rn = (x.rn + 1) % c.n) t WHERE n1 <> n2""", NET)
def q_ring_fallback(spark, d):
    """G03 ring_fallback over the location dimension."""
    m = B.master_table(spark, d)
    locs = m.select(F.col("StorageLocationId").alias("node")).distinct()
    return N.ring_fallback(locs)


@query("network_size", "network_nodes:i, network_edges:i",
       """SELECT (SELECT COUNT(*) FROM loc) + (SELECT COUNT(*) FROM (SELECT node1 AS node FROM edges UNION
          SELECT node2 FROM edges) e WHERE e.node NOT IN (SELECT node FROM loc)) AS network_nodes,
          (SELECT COUNT(*) FROM wedges) AS network_edges""", NET)
def q_network_size(spark, d):
    """G04 network_size."""
    _, nodes, w = _graph(spark, d)
    return N.network_size(nodes, w)


ROUTES_OUT = "Source:s, Destination:s, Path:s, Hops:i, PathWeight:x, Reachable:b"


@query("shortest_paths", ROUTES_OUT, """SELECT * FROM routes WHERE "Reachable\"""", NET)
def q_shortest_paths(spark, d):
    """G05 shortest_paths (distributed Bellman-Ford over the frontier)."""
    return _routes(spark, d)[3].where("Reachable")


@query("unreachable_pairs", ROUTES_OUT, """SELECT * FROM routes WHERE NOT "Reachable\"""", NET)
def q_unreachable_pairs(spark, d):
    """G06 unreachable_pairs: NO PATH, hops -1, by component ids alone."""
    m, nodes, w = _graph(spark, d)
    return R.unreachable(N.ordered_location_pairs(_locations(nodes)), w).select(
        "Source", "Destination", F.lit("NO PATH").alias("Path"), F.lit(-1).cast("bigint").alias("Hops"),
        F.lit(None).cast("double").alias("PathWeight"), F.lit(False).alias("Reachable"))


@query("routes_between", ROUTES_OUT, """SELECT r.* FROM routes r JOIN (SELECT node FROM vol WHERE node IS NOT NULL
       ORDER BY avg_delivery DESC, node LIMIT 1) h ON r."Destination" = h.node WHERE r."Reachable\"""", NET)
def q_routes_between(spark, d):
    """G05 for the pairs asked for: the routes from every location to the one
    with the largest mean delivery, answered from two-hop labels."""
    m, nodes, w = _graph(spark, d)
    locs = nodes.where(F.col("node_type") == "storage_location")
    hub = locs.orderBy(F.desc("avg_delivery"), "node").limit(1).select(F.col("node").alias("Destination"))
    pairs = locs.select(F.col("node").alias("Source")).join(F.broadcast(hub), F.col("Source") != F.col("Destination"))
    return N.routing_paths(pairs, R.routes_between(pairs, R.landmark_labels(w))).where("Reachable")


@query("ordered_location_pairs", "Source:s, Destination:s", "SELECT * FROM pairs", NET)
def q_ordered_location_pairs(spark, d):
    """J15 ordered_location_pairs."""
    m = B.master_table(spark, d)
    return N.ordered_location_pairs(m.select(F.col("StorageLocationId").alias("node")).distinct())


BEST_OUT = "StorageLocationId:s, Destination:s, Path:s, Hops:i, PathWeight:x"


@query("best_route", BEST_OUT, "SELECT * FROM best_route", NET)
def q_best_route(spark, d):
    """G07 best_route: a bounded search from each location."""
    _, nodes, w = _graph(spark, d)
    return R.best_destinations(w, _locations(nodes))


@query("best_per_group", BEST_OUT, "SELECT * FROM best_route", NET)
def q_best_per_group(spark, d):
    """W09 best_per_group: the first of all routes of a source by the tie-break."""
    return N.best_route(_routes(spark, d)[3])


DBASE_OUT = """SkuId:s, StorageLocationId:s, AvgDeliveryQty:d, TotalDeliveryQty:x, AvgSalesOrderQty:d,
ProductGroup:s, PlantId:s"""


@query("sku_storage_delivery", DBASE_OUT, "SELECT * FROM dbase", NET)
def q_sku_storage_delivery(spark, d):
    """A07 sku_storage_delivery."""
    return DP.sku_storage_delivery(B.master_table(spark, d))


@query("min_max_scale", "SkuId:s, StorageLocationId:s, AvgDeliveryQty:d, norm:d",
       """SELECT "SkuId", "StorageLocationId", "AvgDeliveryQty", CASE WHEN mm.hi > mm.lo THEN
          (GREATEST("AvgDeliveryQty", 1.0e0) - mm.lo) / (mm.hi - mm.lo) ELSE 0.5e0 END AS norm
          FROM dbase CROSS JOIN (SELECT MIN(GREATEST("AvgDeliveryQty", 1.0e0)) AS lo,
          MAX(GREATEST("AvgDeliveryQty", 1.0e0)) AS hi FROM dbase) mm""", NET)
def q_min_max_scale(spark, d):
    """W11 min_max_scale (delivery floored at 1)."""
    b = DP.sku_storage_delivery(B.master_table(spark, d))
    return DP.min_max_scale(b, "AvgDeliveryQty", "norm", floor=1.0).select(
        "SkuId", "StorageLocationId", "AvgDeliveryQty", "norm")


PLAN_OUT = DBASE_OUT + """, CurrentLeadTimeDays:x, Destination:s, Path:s, Hops:i, PathWeight:x,
OptimisedLeadTimeDays:x, LeadTimeReduction_Pct:x, DispatchPriority:s"""


@query("dispatch_plan", PLAN_OUT, "SELECT * FROM dplan", NET)
def q_dispatch_plan(spark, d):
    """G12 dispatch_plan."""
    return _plan(spark, d)[0]


def _plan_part(name, cols, doc):
    kinds = dict(c.strip().split(":") for c in PLAN_OUT.replace("\n", " ").split(","))
    out = "SkuId:s, StorageLocationId:s, " + ", ".join(f"{c}:{kinds[c]}" for c in cols)
    sql = 'SELECT "SkuId", "StorageLocationId", ' + ", ".join(f'"{c}"' for c in cols) + " FROM dplan"

    @query(name, out, sql, NET)
    def fn(spark, d):
        return _plan(spark, d)[0].select("SkuId", "StorageLocationId", *cols)
    fn.__doc__ = doc
    return fn


_plan_part("current_lead_time", ["AvgDeliveryQty", "CurrentLeadTimeDays"], "G08 current_lead_time.")
_plan_part("optimised_lead_time", ["CurrentLeadTimeDays", "OptimisedLeadTimeDays"], "G09 optimised_lead_time.")
_plan_part("lead_time_reduction", ["LeadTimeReduction_Pct"], "G10 lead_time_reduction.")
_plan_part("dispatch_priority", ["AvgDeliveryQty", "DispatchPriority"], "G11 dispatch_priority.")
_plan_part("join_best_route", ["Destination", "Path", "Hops", "PathWeight"], "J11 join_best_route.")


@query("dispatch_summary", """storage_locations:i, skus_dispatched:i, avg_lead_time_reduction_pct:x,
avg_current_lead_time_days:x, avg_optimised_lead_time_days:x, express_priority_skus:i,
network_nodes:i, network_edges:i""",
       f"""SELECT COUNT(DISTINCT "StorageLocationId") AS storage_locations, COUNT(DISTINCT "SkuId") AS skus_dispatched,
          {rhe(emean('LeadTimeReduction_Pct', 6), 1)} AS avg_lead_time_reduction_pct,
          {rhe(emean('CurrentLeadTimeDays', 6), 1)} AS avg_current_lead_time_days,
          {rhe(emean('OptimisedLeadTimeDays', 6), 1)} AS avg_optimised_lead_time_days,
          COUNT(*) FILTER (WHERE "DispatchPriority" = 'Express') AS express_priority_skus,
          (SELECT COUNT(*) FROM loc) + (SELECT COUNT(*) FROM (SELECT node1 AS node FROM edges UNION
             SELECT node2 FROM edges) e WHERE e.node NOT IN (SELECT node FROM loc)) AS network_nodes,
          (SELECT COUNT(*) FROM wedges) AS network_edges
          FROM dplan""", NET)
def q_dispatch_summary(spark, d):
    """G13 dispatch_summary."""
    plan, nodes, w = _plan(spark, d)
    return DP.dispatch_summary(plan, N.network_size(nodes, w))
