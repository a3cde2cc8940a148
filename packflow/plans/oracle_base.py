"""SQL building blocks for the DuckDB oracle.

The driver registers only the raw tables, so each oracle query gets the
binding views it mentions prepended as CTEs (same definitions as the Spark
binding in ``packflow.sources.binding``).
"""

from __future__ import annotations

import re

# name -> SQL body. Dependencies are found by name, so order here is the
# emission order (a CTE only refers to names defined above it).
BASE_CTES: dict[str, str] = {}

BASE_CTES["fact"] = """
SELECT CAST(l.l_shipdate AS DATE) AS "Date", 'P' || l.l_partkey AS "SkuId",
       p.p_type AS "ProductGroup", p.p_brand AS "SubGroup",
       'PL' || (l.l_partkey - l.l_partkey % 10) AS "PlantId",
       'SL' || c.c_nationkey AS "StorageLocationId",
       s.s_nationkey AS src_nation, c.c_nationkey AS dst_nation,
       l.l_quantity * p.p_size AS units,
       l.l_extendedprice AS revenue, p.p_retailprice AS cost,
       l.l_linestatus AS ls, l.l_discount AS disc, l.l_tax AS tax
FROM lineitem l
JOIN orders o   ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p     ON l.l_partkey = p.p_partkey"""

BASE_CTES["master"] = """
SELECT "Date","SkuId","ProductGroup","SubGroup","PlantId","StorageLocationId",
       CAST(0 AS DOUBLE) AS "OnHandQty", AVG(cost) AS "UnitCost", 7 AS "LeadTimeDays",
       SUM(units) AS "SalesOrderQty",
       ROUND(SUM(units * (1 + tax)), 2) AS "ProductionQty",
       SUM(CASE WHEN ls = 'F' THEN units ELSE 0 END) AS "DeliveryQty",
       ROUND(SUM(units * (1 - disc)), 2) AS "FactoryIssueQty",
       CASE WHEN EXTRACT(day FROM "Date") <= 10 THEN 1 ELSE 0 END AS "Promotional_Flag",
       CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) / SUM(units) AS "Price"
FROM fact GROUP BY 1,2,3,4,5,6"""

BASE_CTES["calendar"] = """
SELECT d AS "date",
  CASE WHEN EXTRACT(day FROM d) <= 10 THEN 1 ELSE 0 END AS "snap_CA",
  CASE WHEN EXTRACT(day FROM d) <= 15 AND EXTRACT(day FROM d) % 2 = 1 THEN 1 ELSE 0 END AS "snap_TX",
  CASE WHEN EXTRACT(day FROM d) BETWEEN 2 AND 15 AND EXTRACT(day FROM d) % 3 <> 1 THEN 1 ELSE 0 END AS "snap_WI",
  CASE WHEN EXTRACT(month FROM d) = 12 AND EXTRACT(day FROM d) = 25 THEN 'WinterHoliday'
       WHEN EXTRACT(month FROM d) = 7 AND EXTRACT(day FROM d) = 4 THEN 'SummerHoliday'
       WHEN EXTRACT(month FROM d) = 2 AND EXTRACT(day FROM d) = 1 THEN 'SportFinal' END AS "event_name_1",
  CASE WHEN EXTRACT(month FROM d) IN (12) AND EXTRACT(day FROM d) = 25 THEN 'National'
       WHEN EXTRACT(month FROM d) = 7 AND EXTRACT(day FROM d) = 4 THEN 'National'
       WHEN EXTRACT(month FROM d) = 2 AND EXTRACT(day FROM d) = 1 THEN 'Sporting' END AS "event_type_1",
  EXTRACT(month FROM d) AS "month", EXTRACT(year FROM d) AS "year"
FROM (SELECT DISTINCT "Date" AS d FROM fact) t"""

BASE_CTES["sell_prices"] = """
SELECT l_suppkey AS store_id, 'P' || l_partkey AS item_id,
       l_extendedprice / (l_quantity * p_size) AS sell_price
FROM lineitem JOIN part ON l_partkey = p_partkey"""

BASE_CTES["sku_locations"] = """
SELECT DISTINCT "SkuId","PlantId","StorageLocationId" FROM fact"""

BASE_CTES["edges"] = """
SELECT DISTINCT 'SL' || LEAST(src_nation, dst_nation) AS node1, 'SL' || GREATEST(src_nation, dst_nation) AS node2
FROM (SELECT DISTINCT src_nation, dst_nation FROM fact WHERE src_nation <> dst_nation) f
JOIN nation a ON a.n_nationkey = src_nation JOIN nation b ON b.n_nationkey = dst_nation
WHERE a.n_regionkey = b.n_regionkey"""

BASE_CTES["daily"] = """
SELECT "SkuId", "Date", SUM("SalesOrderQty") AS qty, MIN("ProductGroup") AS pg,
       MIN("SubGroup") AS sg
FROM master GROUP BY 1, 2"""

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _needed(sql: str, extra: dict[str, str]) -> list[str]:
    lib = {**BASE_CTES, **extra}
    names = list(lib)
    seen: set[str] = set()

    def visit(text: str) -> None:
        for w in set(_WORD.findall(text)):
            if w in lib and w not in seen:
                seen.add(w)
                visit(lib[w])

    visit(sql)
    return [n for n in names if n in seen]


def compose(sql: str, ctes: dict[str, str] | None = None) -> str:
    """Prepend the binding CTEs (and query-local ``ctes``) that ``sql`` uses.
    A local CTE whose name ends in ``(cols)`` is emitted as written, and any
    ``RECURSIVE`` marker in a body switches the clause to ``WITH RECURSIVE``."""
    extra = dict(ctes or {})
    lib = {**BASE_CTES, **extra}
    names = _needed(sql, extra)
    if not names:
        return sql.strip()
    rec = any(lib[n].lstrip().startswith("-- recursive") for n in names)
    body = ",\n".join(f"{_HEADS.get(n, n)} AS ({lib[n].strip()})" for n in names)
    return f"WITH {'RECURSIVE ' if rec else ''}{body}\n{sql.strip()}"


_HEADS: dict[str, str] = {}


def recursive_cte(name: str, cols: str, body: str) -> tuple[str, str]:
    """Register the column list of a recursive CTE; returns (name, body)."""
    _HEADS[name] = f"{name}({cols})"
    return name, "-- recursive\n" + body
