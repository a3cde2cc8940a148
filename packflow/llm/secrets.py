"""Operator 10: secret scans with multipart credential linking (DataFrame functions only).

Base kinds (assignments, access identifiers, hex runs) are always reported.
Weak parts (short assigned secrets, user names, endpoints) are reported only
when a complementary part lies in the same scope: parts are intervals in code
points, scopes are cells of ``SCOPE`` code points, and two parts meet when one
touches the other's cell or a neighbouring one. The interval join runs on cells
inside each document, so no pairs are made and rows stay independent.

Positions come from the text split at marked matches: the parts' lengths add up
to offsets, block by block, so a very long text costs time in proportion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packflow.llm.common import prepare

SCOPE = 200
BLOCK = 256

# Fixed patterns of the base kinds.
ASSIGN_HEAD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Weak parts.
USER_HEAD = r"""(?i:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?"""
USER = r"[A-Za-z0-9._@+-]{3,}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>,;]{4,}"""

OPEN, MIDDLE, CLOSE = "\x01", "\x02", "\x03"
KINDS = ["assign", "access", "hex", "weak_secret", "weak_id", "endpoint"]

SPAN = "array<struct<start:int,end:int,size:int>>"


def _offsets(parts: Column) -> Column:
    """Spans of marked matches: part 0 precedes the first match, every later
    part is head MIDDLE value CLOSE rest."""
    def add(acc: Column, p: Column) -> Column:
        head = F.instr(p, MIDDLE) - 1
        value = F.instr(p, CLOSE) - 2 - head
        return F.struct(
            (acc["at"] + F.length(p) - 2).alias("at"),
            F.array_append(acc["spans"], F.struct(acc["at"].alias("start"), (acc["at"] + head + value).alias("end"),
                                                  value.alias("size"))).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPAN})").alias("spans"))
    blocks = F.transform(F.sequence(F.lit(2), F.size(parts), F.lit(BLOCK)),
                         lambda k: F.aggregate(F.slice(parts, k, BLOCK), empty, add))
    shifted = F.aggregate(
        blocks, F.struct(F.length(parts[0]).alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("all")),
        lambda acc, b: F.struct(
            (acc["at"] + b["at"]).alias("at"),
            F.array_append(acc["all"], F.transform(b["spans"], lambda s: F.struct(
                (s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"),
                s["size"].alias("size")))).alias("all")),
        lambda acc: F.flatten(acc["all"]))
    return F.when(F.size(parts) > 1, shifted).otherwise(F.expr(f"cast(array() as {SPAN})"))


def _marked(text: Column, head: str, value: str) -> Column:
    return F.split(F.regexp_replace(text, f"({head})({value})", f"{OPEN}$1{MIDDLE}$2{CLOSE}"), OPEN, -1)


def _cells(spans: Column) -> Column:
    """Cells that the spans touch, and their neighbours."""
    return F.array_distinct(F.flatten(F.transform(
        spans, lambda s: F.sequence(F.floor(s["start"] / SCOPE) - 1, F.floor(s["end"] / SCOPE) + 1))))


def _near(spans: Column, cells: Column) -> Column:
    return F.filter(spans, lambda s: F.exists(
        F.sequence(F.floor(s["start"] / SCOPE), F.floor(s["end"] / SCOPE)),
        lambda c: F.array_contains(cells, c)))


def _named(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, text_col: str = "text", found: str = "found") -> DataFrame:
    """``docs`` with ``found`` (which replaces a column of that name): struct
    of base and all spans (start, kind, end), sorted; both empty for null and
    empty texts. Rows are independent: ties, repeated rows, extra columns and
    empty tables change nothing."""
    prepare(docs.sparkSession)
    own = [F.col(f"`{c}`") for c in docs.columns if c != found]
    # the marks must not occur in a text; none of the patterns matches them
    text = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), OPEN + MIDDLE + CLOSE, "\x04\x04\x04")
    any_part = "|".join([f"{ASSIGN_HEAD}[A-Za-z0-9+/_.=-]", ACCESS, HEX])
    df = docs.select(*own, F.when(F.col(f"`{text_col}`").rlike(any_part), text).alias("_t"))
    some = lambda c: F.when(F.col("_t").isNotNull(), c)
    df = df.select("*", some(_marked(F.col("_t"), ASSIGN_HEAD, VALUE)).alias("_a"),
                   some(_marked(F.col("_t"), "", ACCESS)).alias("_k"),
                   some(_marked(F.col("_t"), "", HEX)).alias("_h"),
                   some(_marked(F.col("_t"), USER_HEAD, USER)).alias("_u"),
                   some(_marked(F.col("_t"), "", ENDPOINT)).alias("_e")).drop("_t")
    df = df.select(*own, *[some_null(_offsets(F.col(c)), c).alias(c) for c in ("_a", "_k", "_h", "_u", "_e")])
    df = df.select(*own, F.filter("_a", lambda s: s["size"] >= 12).alias("_a"),
                   F.filter("_a", lambda s: s["size"].between(6, 11)).alias("_w"), "_k", "_h", "_u", "_e")
    df = df.select("*", _cells(F.concat("_a", "_h", "_w")).alias("_secrets"),
                   _cells(F.concat("_k", "_u", "_e")).alias("_others"))
    base = F.concat(_named(F.col("_a"), 0), _named(F.col("_k"), 1), _named(F.col("_h"), 2))
    weak = F.concat(_named(_near(F.col("_w"), F.col("_others")), 3),
                    _named(_near(F.col("_u"), F.col("_secrets")), 4),
                    _named(_near(F.col("_e"), F.col("_secrets")), 5))
    nothing = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    df = df.select(*own, F.coalesce(F.array_sort(base), nothing).alias("_base"), F.coalesce(weak, nothing).alias("_weak"))
    return df.select(*own, F.struct(F.col("_base").alias("base"),
                                    F.array_sort(F.concat("_base", "_weak")).alias("spans")).alias(found))


def some_null(value: Column, col: str) -> Column:
    """Null parts stay null: rows without any part skip all span work."""
    return F.when(F.col(col).isNotNull(), value)


def redact(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span (overlaps merged) of the column text replaced
    by ``mask``; null texts stay null, all other columns stay as they are."""
    cols = docs.columns
    at = "found"
    while at in cols:
        at += "_"
    found = scan(docs, found=at)

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return (F.when(s["end"] <= acc["at"], acc)
                .when(s["start"] < acc["at"], F.struct(s["end"].alias("at"), acc["out"].alias("out")))
                .otherwise(F.struct(s["end"].alias("at"), F.array_append(
                    acc["out"], F.concat(before, F.lit(mask))).alias("out"))))

    init = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    clean = F.aggregate(F.col(f"{at}.spans"), init, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    text = F.when(F.size(f"{at}.spans") > 0, clean).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*[F.col(f"`{c}`") for c in cols])


def op10(docs: DataFrame) -> DataFrame:
    df = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "found.base", "found.spans")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                     F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                     _joined(F.col("spans")).alias("spans"))
