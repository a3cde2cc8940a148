"""Scalar column expressions shared by the operators.

Everything returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from packflow import config as C

__all__ = [
    "col_", "round_half_even", "clip", "clip_lower", "safe_ratio", "eps_div",
    "bin_right_closed", "class_factor", "class_lookup", "parse_date", "parse_qty",
    "fill_unknown", "calendar_parts", "month_abbr", "day_name", "money_label",
    "percent_label", "norm6", "any_flag",
]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """pandas/NumPy ``round``: ``rint(x * 10^n) / 10^n`` (ties to even)."""
    c = col_(c)
    if digits == 0:
        return F.rint(c)
    s = float(10 ** digits)
    return F.rint(c * F.lit(s)) / F.lit(s)


def norm6(c: str | Column) -> Column:
    """Comparison form of a non-integer measure: ties-to-even at 6 digits."""
    return round_half_even(col_(c).cast("double"), 6)


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound to [lo, hi]; null stays null (``least``/``greatest`` skip nulls)."""
    c = col_(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def clip_lower(c: str | Column, lo: float) -> Column:
    return clip(c, lo, None)


def eps_div(num: str | Column, den: str | Column, eps: float = C.EPS) -> Column:
    """``num / (den + eps)`` as the reference writes it (no zero check)."""
    return F.try_divide(col_(num), col_(den) + F.lit(eps))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``, null when ``den`` is 0 (ANSI-safe)."""
    return F.try_divide(col_(num), col_(den))


def bin_right_closed(c: str | Column, labels: Sequence[str],
                     edges: Sequence[float] = C.BIN_EDGES) -> Column:
    """Right-closed bins ``(e0,e1], (e1,e2], (e2,inf)``; outside -> null."""
    c = col_(c)
    e0, e1, e2 = edges
    return (F.when((c > e0) & (c <= e1), F.lit(labels[0]))
            .when((c > e1) & (c <= e2), F.lit(labels[1]))
            .when(c > e2, F.lit(labels[2])))


def class_factor(cls: str | Column, mapping: dict, otherwise: float) -> Column:
    """Nested conditional on the velocity class; null class -> ``otherwise``."""
    cls = col_(cls)
    out = None
    for k, v in mapping.items():
        out = (F.when(cls == k, F.lit(v)) if out is None else out.when(cls == k, F.lit(v)))
    return out.otherwise(F.lit(otherwise))


def class_lookup(cls: str | Column, mapping: dict, default: float) -> Column:
    """Map class -> value; unmapped or null -> ``default``."""
    return class_factor(cls, mapping, default)


def parse_date(c: str | Column) -> Column:
    """Text/timestamp -> date; unparseable -> null."""
    c = col_(c)
    return F.to_date(F.try_to_timestamp(c.cast("string")))


def parse_qty(c: str | Column) -> Column:
    """Text -> double; unparseable or null -> 0."""
    return F.coalesce(F.expr("try_cast({} as double)".format(_sql_name(c))), F.lit(0.0))


def _sql_name(c: str | Column) -> str:
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError("parse_qty needs a column name")


def fill_unknown(c: str | Column, default: str = "UNKNOWN") -> Column:
    return F.coalesce(col_(c).cast("string"), F.lit(default))


def calendar_parts(d: str | Column) -> dict[str, Column]:
    """Day of week (Mon=0), month, day of year, ISO week; all bigint."""
    d = col_(d)
    return {
        "day_of_week": F.weekday(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "day_of_year": F.dayofyear(d).cast("bigint"),
        "week_of_year": F.weekofyear(d).cast("bigint"),
    }


def month_abbr(d: str | Column) -> Column:
    return F.date_format(col_(d), "MMM")


def day_name(d: str | Column) -> Column:
    return F.date_format(col_(d), "EEEE")


def money_label(c: str | Column) -> Column:
    """'£12.3M' from a million up, else '£1,234'."""
    c = col_(c)
    return (F.when(F.abs(c) >= 1e6,
                   F.concat(F.lit("£"), F.format_string("%.1f", c / 1e6), F.lit("M")))
            .otherwise(F.concat(F.lit("£"), F.format_number(F.rint(c), 0))))


def percent_label(c: str | Column) -> Column:
    return F.concat(F.format_string("%.1f", col_(c)), F.lit("%"))


def any_flag(cols: Iterable[str]) -> Column:
    """Row-wise max over flag columns (0 if none are given)."""
    cols = list(cols)
    if not cols:
        return F.lit(0)
    if len(cols) == 1:
        return F.coalesce(F.col(cols[0]), F.lit(0))
    return F.coalesce(F.greatest(*[F.col(c) for c in cols]), F.lit(0))
