"""Small SQL text helpers for oracle queries (DuckDB dialect)."""

from __future__ import annotations


def q(c: str) -> str:
    return c if c.startswith('"') else f'"{c}"'


def esum(c: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({q(c)} AS DECIMAL(38,{scale}))) AS DOUBLE)"


def emean(c: str, scale: int = 2) -> str:
    return f"({esum(c, scale)} / COUNT({q(c)}))"


def mean(c: str) -> str:
    return f"(SUM({q(c)}) / COUNT({q(c)}))"


def clip(e: str, lo=None, hi=None) -> str:
    out = e
    if lo is not None:
        out = f"GREATEST({out}, {lo})"
    if hi is not None:
        out = f"LEAST({out}, {hi})"
    return f"(CASE WHEN ({e}) IS NULL THEN NULL ELSE {out} END)"


def rhe(e: str, n: int = 0) -> str:
    """ties-to-even rounding, the same float steps as the Spark side."""
    if n == 0:
        return f"ROUND_EVEN(({e}), 0)"
    s = float(10 ** n)
    return f"(ROUND_EVEN(({e}) * {s}, 0) / {s})"


def bins(e: str, labels: tuple[str, str, str]) -> str:
    a, b, c = labels
    return (f"(CASE WHEN ({e}) > 0 AND ({e}) <= 100 THEN '{a}' "
            f"WHEN ({e}) > 100 AND ({e}) <= 500 THEN '{b}' WHEN ({e}) > 500 THEN '{c}' END)")


def first_by(c: str, order: str = '"Date"') -> str:
    return f"(MIN(CASE WHEN {q(c)} IS NOT NULL THEN {{'o': {order}, 'v': {q(c)}}} END)).v"


def quantiles_sql(src: str, value: str, probs, group: str | None = None) -> str:
    """(group, p, q) with the same interpolation as ``exact_quantiles``."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    on = f"r1.{group} IS NOT DISTINCT FROM t.{group} AND " if group else ""
    on2 = f"r2.{group} IS NOT DISTINCT FROM t.{group} AND " if group else ""
    tg = ", ".join(f"({float(p)!r}e0)" if "e" not in repr(float(p)) else f"({float(p)!r})" for p in probs)
    return f"""(WITH qsrc AS (SELECT {g}CAST({value} AS DOUBLE) AS v FROM ({src}) s WHERE {value} IS NOT NULL),
  qr AS (SELECT {g}v, ROW_NUMBER() OVER ({part} ORDER BY v) - 1 AS pos, COUNT(*) OVER ({part}) AS n FROM qsrc),
  qt AS (SELECT DISTINCT {g}n, pp.p, (n - 1) * pp.p AS h FROM qr CROSS JOIN (VALUES {tg}) pp(p))
  SELECT {('t.' + group + ', ') if group else ''}t.p, r1.v + (r2.v - r1.v) * (t.h - FLOOR(t.h)) AS q
  FROM qt t JOIN qr r1 ON {on}r1.pos = FLOOR(t.h) JOIN qr r2 ON {on2}r2.pos = CEIL(t.h))"""
