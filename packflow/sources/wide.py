"""Wide daily files of any width.

A wide file has one column for each SKU (or day). Reading it as a DataFrame
would put one attribute for each of them into the plan, and CSV parsers stop at
a column limit. Here a line is one row with one array column: the header is
read once, its names are one constant array of the plan, and the long form
explodes those names and takes each value by its place in the line. Scan,
split and explode are one stage; the plan has the same size at ten columns and
at fifty thousand.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: one field: quoted (a doubled quote stands for one) or bare
FIELD = r'(?:^|,)("(?:[^"]++|"")*+"|[^,]*+)'


@dataclass
class WideLines:
    """Lines of a wide file: ``rows`` has the id columns and ``parts``, the
    fields of the line; ``names`` are the value columns, ``places`` their
    places in ``parts``."""

    rows: DataFrame
    ids: list[str]
    names: list[str]
    places: list[int]
    value: str = "value"

    def long(self, value_name: str, var_name: str = "SkuId") -> DataFrame:
        """(ids..., ``var_name``, ``value_name``): a row for every line and
        value column; empty and missing fields are null."""
        if not self.names:
            return self.rows.select(*self.ids, F.lit("").alias(var_name), F.lit("").alias(value_name)).limit(0)
        first = self.places[0]
        straight = self.places == list(range(first, first + len(self.places)))
        header = F.split(F.lit("\n".join(self.names)), "\n")
        at = F.col("_at") + first if straight else F.element_at(
            F.split(F.lit("\n".join(map(str, self.places))), "\n"), F.col("_at") + 1).cast("int")
        met = self.rows.select(*self.ids, "parts", F.posexplode(header).alias("_at", var_name))
        return met.select(*self.ids, var_name, F.nullif(F.get("parts", at), F.lit("")).alias(value_name))

    def long_with(self, others: dict[str, "WideLines"], var_name: str = "SkuId") -> DataFrame:
        """The long form of these lines left-joined with other files' cells on
        the ids and the column name: (ids..., ``var_name``, own value, the
        others'). Lines are joined before they are exploded, so no cell is
        shuffled or sorted. Names must not repeat in a header."""
        for w in (self, *others.values()):
            if len(set(w.names)) < len(w.names) or w.ids != self.ids:
                raise ValueError("lines join on equal id columns and headers without repeated names")
        rows = self.rows.select(*self.ids, self._values("_own"))
        for k, w in enumerate(others.values()):
            rows = rows.join(w.rows.select(*w.ids, w._values(f"_p{k}")), self.ids, "left")
        header = F.split(F.lit("\n".join(self.names)), "\n")
        met = rows.select("*", F.posexplode(header).alias("_at", var_name)) if self.names else rows.select(
            "*", F.lit(0).alias("_at"), F.lit("").alias(var_name)).limit(0)
        cell = lambda c, at: F.nullif(F.get(c, at), F.lit(""))
        out = [cell("_own", self._at(self.names)).alias(self.value)]
        out += [cell(f"_p{k}", w._at(self.names)).alias(name) for k, (name, w) in enumerate(others.items())]
        return met.select(*self.ids, var_name, *out)

    def _straight(self) -> bool:
        return bool(self.places) and self.places == list(range(self.places[0], self.places[0] + len(self.places)))

    def _values(self, name: str) -> Column:
        """The value fields of the line, all fields when others are among them."""
        return (F.slice("parts", self.places[0] + 1, len(self.places)) if self._straight() else F.col("parts")).alias(name)

    def _at(self, names: list[str]) -> Column:
        """Place in ``_values`` of the ``_at``-th of ``names``; null for names that are not here."""
        if self._straight() and names == self.names:
            return F.col("_at")
        first = self.places[0] if self._straight() else 0
        where = {n: str(p - first) for n, p in zip(self.names, self.places)}
        return F.element_at(F.split(F.lit("\n".join(where.get(n, "") for n in names)), "\n"), F.col("_at") + 1).try_cast("int")

    def columns(self, names: Sequence[str]) -> DataFrame:
        """The ids and some value columns, one attribute each."""
        where = dict(zip(self.names, self.places))
        return self.rows.select(*self.ids, *[F.nullif(F.get("parts", F.lit(where[n])), F.lit("")).alias(n) for n in names])


def _fields(line: Column) -> Column:
    """The fields of a line; lines without a quote are split at commas."""
    quoted = F.transform(F.regexp_extract_all(line, F.lit(FIELD), 1), lambda f: F.when(
        f.startswith('"'), F.replace(F.substring(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def header_of(spark: SparkSession, path: str) -> str | None:
    """The first line of the first file under ``path``; null without a file or line."""
    try:
        files = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    for f in sorted(files):
        at = urlparse(f)  # file names come escaped as in a URL; the reader takes a glob
        name = "".join("\\" + c if c in "[]{}*?" else c for c in unquote(at.path))
        row = spark.read.text(f"{at.scheme}://{at.netloc}{name}").first()
        if row is not None:
            return row["value"]
    return None


def read_wide_lines(spark: SparkSession, path: str, ids: Sequence[str] | Callable[[str], bool],
                    rename_first: str | None = None, together: Sequence[str] = ()) -> WideLines | None:
    """Wide file or folder whose files share one header. ``ids`` are names, or
    a test of names, of the id columns; the other columns are values. Names are
    trimmed; ``rename_first`` renames the first column. Blank lines are left
    out; a field does not span lines. Lines that agree in the id columns
    ``together`` are brought into one task (as text, before they are split), so
    that sums by them and the column name need no shuffle of cells, and a task
    holds few names. ``None`` when there is no file."""
    line = header_of(spark, path)
    if line is None:
        return None
    names = [n.strip() for n in next(csv.reader([line.lstrip("﻿")]))]
    if rename_first:
        names[0] = rename_first
    is_id = ids if callable(ids) else set(ids).__contains__
    value = F.col("value")
    text = (spark.read.option("recursiveFileLookup", True).text(path)
            .where((value != F.lit(line)) & (F.trim(value) != "")))
    if together:
        text = text.select("value", *[F.nullif(F.get(_fields(value), F.lit(names.index(n))), F.lit("")).alias(n) for n in together])
        rows = text.repartition(*together).select(*together, _fields(value).alias("parts"))
    else:
        rows = text.select(_fields(value).alias("parts"))
    own = [(k, n) for k, n in enumerate(names) if is_id(n)]
    lines = rows.select(*[F.col(n) if n in together else F.nullif(F.get("parts", F.lit(k)), F.lit("")).alias(n)
                          for k, n in own], "parts")
    places = [k for k, n in enumerate(names) if not is_id(n)]
    return WideLines(lines, [n for _, n in own], [names[k] for k in places], places)
