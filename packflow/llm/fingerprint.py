"""Operator 12: document fingerprints by consistent weighted sampling (DataFrame functions only).

A text is a bag of words; a word's weight S is its count. For every word and
sample two gamma(2, 1) values r and c and a uniform b follow from the word's
hash alone. With t = floor(ln S / r + b) the sample takes the word with the
least a = c exp(-r (t - b + 1)) and records (word, t): two texts record the
same pair with probability sum min(S, S') / sum max(S, S'), their generalised
Jaccard similarity, so the share of equal samples estimates it.

All of it stays in generated code: words are exploded and counted once for the
text and its edited version together (the random values serve both), each word
meets the samples by an exploded constant array, and the least a is a ``min``
over one long that holds ln a in its upper and the pair's hash in its lower
half. A document's rows never leave the partition its text was joined in.

The least a of a text of W words is exponential with rate W, so it lies below
``REACH`` / W but for e^-REACH of the cases, and a >= (1 - u3 u4) u1 u2 / S
without a logarithm. Words above that bound are passed over; a text with a
sample that no word reached is done again without the bound, so the result is
the least over all words in every case.

The next document is found on ids and hashes alone: a range partitioning, a
window inside each part, and one row a part for the borders.
"""

from __future__ import annotations

import functools
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packflow.llm.common import buckets_for, prepare, written
from packflow.llm.oracle import CRC_TABLE, crc_sql

SAMPLES = 32
PRIME = 4294967291  # the largest prime below 2^32: word hashes are crc32
IDENTITY = (1640531527, 40503)
SPACES = r"[\x20\x09-\x0D]+"
IDS = 1 << 20  # rows of ids a part of the order
REACH = 10.0
WORD_CHARS = 6  # guessed length of a word: only tells how early the bound cuts
PART_CHARS = 4 << 20  # characters of a partition of texts: sampling is CPU work


@functools.cache
def constants(samples: int) -> list[list[int]]:
    """Five (factor, shift) pairs for each sample, factors below 2^31."""
    rng = random.Random(20240607)
    return [[x for _ in range(5) for x in (rng.randrange(1 << 20, (1 << 31) - 2), rng.randrange(PRIME))]
            for _ in range(samples)]


def _uniform(x: Column, factor: Column, shift: Column) -> Column:
    return ((x * factor + shift) % PRIME + 0.5) / float(PRIME)


def _least(log_count: Column, r: Column, log_c: Column, b: Column, x: Column) -> Column:
    """ln a, rounded, over the hash of (word, t); null without a count."""
    t = F.floor(log_count / r + b)
    log_a = log_c - r * (t - b + 1)
    pair = (x * IDENTITY[0] + t * IDENTITY[1]) % (1 << 32)
    return F.floor((log_a + 128) * float(1 << 23)) * F.lit(1 << 32) + pair


def samples_of(rows: DataFrame, keys: list[str], sides: list[str], samples: int = SAMPLES,
               bounded: bool = True) -> DataFrame:
    """``keys`` and one array<long> of samples for each text column in
    ``sides``, rows with a word on some side only. A sample is null where a
    text has no word or, if ``bounded``, no word came below the bound. ``keys``
    identify a row and should be what rows are partitioned by."""
    n = range(len(sides))
    sizes = [(F.length(s) / WORD_CHARS + 1).alias(f"w{k}") for k, s in enumerate(sides)]
    sided = F.array(*[F.struct(F.lit(k).alias("side"), F.col(s).alias("text")) for k, s in enumerate(sides)])
    keyed = [*keys, *[f"w{k}" for k in n]]
    words = (rows.select(*keys, *sizes, F.explode(sided).alias("s"))
             .select(*keyed, "s.side", F.explode(F.split("s.text", SPACES)).alias("word")))
    counts = words.where(F.col("word") != "").groupBy(
        *keyed, F.crc32(F.col("word").cast("binary")).alias("x")).agg(*[
            F.sum(F.when(F.col("side") == k, 1).otherwise(0)).alias(f"n{k}") for k in n])
    shares = [F.col(f"n{k}") / F.col(f"w{k}") for k in n]
    reach = (F.greatest(*shares) if len(sides) > 1 else shares[0]) * REACH
    counts = counts.select(*keys, "x", *[F.when(F.col(f"n{k}") > 0, F.ln(f"n{k}")).alias(f"l{k}") for k in n],
                           reach.alias("reach"))
    table = F.array(*[F.struct(F.lit(j).alias("j"), *[F.lit(v).cast("long").alias(f"k{i}") for i, v in enumerate(row)])
                      for j, row in enumerate(constants(samples))])
    met = counts.select("*", F.explode(table).alias("c"))
    u = [_uniform(F.col("x"), F.col(f"c.k{2 * i}"), F.col(f"c.k{2 * i + 1}")) for i in range(5)]
    if bounded:
        met = met.where((1 - u[2] * u[3]) * u[0] * u[1] <= F.col("reach"))
    met = met.select(*keys, "x", *[f"l{k}" for k in n], F.col("c.j").alias("j"),
                     (-F.ln(u[0] * u[1])).alias("r"), F.ln(-F.ln(u[2] * u[3])).alias("log_c"), u[4].alias("b"))
    least = met.groupBy(*keys, "j").agg(*[
        F.min(_least(F.col(f"l{k}"), F.col("r"), F.col("log_c"), F.col("b"), F.col("x"))).alias(f"m{k}") for k in n])
    found = least.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("j"), F.struct(*[(F.col(f"m{k}") % (1 << 32)).alias(f"m{k}") for k in n])))).alias("all"))
    places = F.sequence(F.lit(0), F.lit(samples - 1))
    found = found.select(*keys, F.transform(places, lambda j: F.col("all")[j]).alias("all"))
    return found.select(*keys, *[F.col(f"all.m{k}").alias(name) for k, name in enumerate(sides)])


def whole_samples(rows: DataFrame, keys: list[str], sides: list[str], samples: int = SAMPLES,
                  about: list[Column] | None = None) -> DataFrame:
    """``keys``, the columns ``about`` and exact samples of every row, written:
    arrays of nulls where a text has no word."""
    wordy = [F.col(s).rlike(r"[^\x20\x09-\x0D]").alias(f"_{s}") for s in sides]

    def prints(rows: DataFrame, bounded: bool) -> DataFrame:
        told = rows.select(*keys, *(about or []), *wordy)
        out = told.join(samples_of(rows, keys, sides, samples, bounded), keys, "left")
        none = F.array_repeat(F.lit(None).cast("long"), samples)
        return out.withColumns({s: F.coalesce(s, none) for s in sides})

    got = written(prints(rows, True), "prints")
    short = F.lit(False)
    for s in sides:
        short = short | (F.col(f"_{s}") & F.exists(s, lambda x: x.isNull()))
    missed = got.where(short).select(*keys)
    if not missed.isEmpty():
        again = written(prints(rows.join(missed, keys, "left_semi"), False), "prints")
        got = got.where(~short).unionByName(again)
    return got.drop(*[f"_{s}" for s in sides])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two texts without words are alike, one is not."""
    empty = lambda c: c[0].isNull()
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, e: s + e)
    return (F.when(empty(a) & empty(b), F.lit(1.0)).when(empty(a) | empty(b), F.lit(0.0))
            .otherwise(same / F.size(a)))


def text_of(samples: Column) -> Column:
    """A fingerprint as text: eight hex digits a sample, empty without words."""
    return F.when(samples[0].isNull(), F.lit("")).otherwise(
        F.lower(F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x), 8, "0")), "")))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, samples of every row's whole text (null: empty); rows with the
    same id are apart. Extra columns are ignored."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.select("doc_id", F.xxhash64("text", F.col("doc_id").isNull()).alias("h"),
                         F.coalesce("doc_id", F.lit(0)).alias("kid"), "text")
    copies = keyed.groupBy("kid", "h", "doc_id").agg(F.count("*").alias("n"), F.first("text").alias("text"))
    prints = whole_samples(copies, ["kid", "h"], ["text"], samples, [F.col("doc_id"), F.col("n")])
    return (prints.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("doc_id", F.col("text").alias("samples")))


def followers(ids: DataFrame) -> DataFrame:
    """kid, h, half, next_kid, next_h of distinct rows (kid, h, id, half), by
    descending id (null last), then h; the first follows the last."""
    order = [F.col("id").desc_nulls_last(), F.col("h").asc()]
    parts = buckets_for(ids.count(), IDS, 4)
    ranged = written(ids.repartitionByRange(parts, *order).select("*", F.spark_partition_id().alias("part")), "order")
    here = F.struct(F.col("kid").alias("kid"), F.col("h").alias("h"))
    within = Window.partitionBy("part").orderBy(*order)
    linked = ranged.withColumn("next", F.lead(here).over(within)).withColumn("place", F.row_number().over(within))
    # one row a part: its first row follows the last row of the part before
    heads = ranged.groupBy("part").agg(F.min(F.struct(
        F.col("id").isNull().alias("null"), (-F.col("id").cast("decimal(20,0)")).alias("down"), "h", "kid")).alias("head"))
    heads = heads.select("part", F.struct(F.col("head.kid").alias("kid"), F.col("head.h").alias("h")).alias("head"))
    every = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(every), F.first("head").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("head"))
    return (linked.join(F.broadcast(heads), "part")
            .select("kid", "h", "id", "n", "half", F.coalesce("next", "head").alias("next"))
            .select("kid", "h", "id", "n", "half", F.col("next.kid").alias("next_kid"), F.col("next.h").alias("next_h")))


def compare_edited(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, samples, edited_samples, near_edited,
    near_next for every row of ``docs``.

    The edited text is the text whose last floor(n_chars / 2) code points give
    way to as many first ones of the next document (by descending id, null last;
    rows with one id by a hash of their text; the first follows the last). The
    next row of a row that occurs twice is its copy. Null texts are empty; texts
    without words have null samples; extra columns are ignored; an empty table
    gives no rows."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce("text", F.lit(""))
    # (kid, h) is a key without nulls: h tells a null id from 0
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"))
    texts = texts.select(F.coalesce("id", F.lit(0)).alias("kid"),
                         F.when(F.col("id").isNull(), F.xxhash64("text", F.lit(1))).otherwise(F.xxhash64("text")).alias("h"),
                         "id", "text")
    ids = texts.groupBy("kid", "h", "id").agg(F.count("*").alias("n"), F.floor(F.max(F.length("text")) / 2).alias("half"))
    links = written(followers(ids), "links")
    size = links.agg(F.max("n").alias("most"), F.sum(F.col("half") * 2).alias("chars")).first()
    many = (size["most"] or 0) > 1
    texts = texts.select("kid", "h", "text")
    if many:  # repeated rows: one each
        texts = texts.groupBy("kid", "h").agg(F.first("text").alias("text"))
    texts = texts.repartition(buckets_for(size["chars"] or 0, PART_CHARS), "kid", "h")
    before = links.select(F.col("next_kid").alias("kid"), F.col("next_h").alias("h"), F.col("kid").alias("to_kid"),
                          F.col("h").alias("to_h"), F.col("half").alias("to_half"))
    given = texts.join(before, ["kid", "h"]).select(
        F.col("to_kid").alias("kid"), F.col("to_h").alias("h"), F.substring("text", F.lit(1), F.col("to_half").cast("int")).alias("given"))
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.length("text") - half)
    rows = texts.join(given, ["kid", "h"]).select("kid", "h", "text", F.concat(kept, "given").alias("edited"))

    def prints(rows: DataFrame) -> DataFrame:
        return whole_samples(rows, ["kid", "h"], ["text", "edited"], samples, [
            F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")])

    prints_ = prints(rows)
    out = prints_.join(links, ["kid", "h"])
    near = prints_.select(F.col("kid").alias("next_kid"), F.col("h").alias("next_h"), F.col("text").alias("next"))
    out = out.join(near, ["next_kid", "next_h"])
    if many:  # all but the last of equal rows are followed by themselves
        again = texts.join(links.where(F.col("n") > 1).select("kid", "h", "n", "id"), ["kid", "h"])
        again = again.withColumn("edited", F.concat(kept, F.substring("text", F.lit(1), half)))
        copies = prints(again).join(links.select("kid", "h", "n", "id"), ["kid", "h"]).withColumn("next", F.col("text"))
        copies = copies.withColumn("_copy", F.explode(F.sequence(F.lit(2), F.col("n")))).drop("_copy")
        out = out.unionByName(copies, allowMissingColumns=True)
    return out.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.col("text").alias("samples"),
                      F.col("edited").alias("edited_samples"),
                      likeness(F.col("text"), F.col("edited")).alias("near_edited"),
                      likeness(F.col("text"), F.col("next")).alias("near_next"))


def op12(docs: DataFrame) -> DataFrame:
    return compare_edited(docs).select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("samples")).alias("fingerprint"),
        text_of(F.col("edited_samples")).alias("edited_fingerprint"), "near_edited", "near_next")


def op12_sql() -> str:
    """The same samples in DuckDB: crc32 from its table, then the same integers."""
    table = ", ".join("(" + ", ".join(map(str, [j, *row])) + ")" for j, row in enumerate(constants(SAMPLES)))
    u = [f"((x * k{2 * i} + k{2 * i + 1}) % {PRIME} + 0.5) / {PRIME}.0::DOUBLE" for i in range(5)]
    least = [f"min((CAST(floor((log_c - r * (t{k} - b + 1) + 128) * 8388608.0::DOUBLE) AS BIGINT) << 32)"
             f" + (x * {IDENTITY[0]} + t{k} * {IDENTITY[1]}) % 4294967296)" for k in (0, 1)]
    alike = lambda a, b: (f"CASE WHEN {a} = '' AND {b} = '' THEN 1.0::DOUBLE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE"  # noqa: E731
                          f" ELSE len(list_filter(range({SAMPLES}), lambda i: substr({a}, CAST(8 * i + 1 AS BIGINT), 8)"
                          f" = substr({b}, CAST(8 * i + 1 AS BIGINT), 8))) / {SAMPLES}.0::DOUBLE END")
    return rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM documents),
o AS (SELECT *, lead(doc_id) OVER w AS next_id, lead(text) OVER w AS next_text,
             first_value(doc_id) OVER w AS first_id, first_value(text) OVER w AS first_text,
             row_number() OVER w AS rn, count(*) OVER () AS docs
      FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT doc_id, n_chars, text, CASE WHEN rn = docs THEN first_id ELSE next_id END AS next_id,
             substr(text, 1, n_chars - n_chars // 2)
               || substr(CASE WHEN rn = docs THEN first_text ELSE next_text END, 1, n_chars // 2) AS edited FROM o),
w AS (SELECT doc_id, 0 AS side, unnest(regexp_extract_all(text, '[^ 	-
]+')) AS word FROM e
      UNION ALL SELECT doc_id, 1, unnest(regexp_extract_all(edited, '[^ 	-
]+')) FROM e),
h AS (SELECT word, {crc_sql('word')} AS x FROM (SELECT DISTINCT word FROM w), crc_table),
c AS (SELECT doc_id, x, CASE WHEN sum(1 - side) > 0 THEN ln(sum(1 - side)::DOUBLE) END AS l0,
             CASE WHEN sum(side) > 0 THEN ln(sum(side)::DOUBLE) END AS l1 FROM w JOIN h USING (word) GROUP BY doc_id, x),
k(j, {', '.join(f'k{i}' for i in range(10))}) AS (VALUES {table}),
m AS (SELECT doc_id, x, j, l0, l1, -ln(({u[0]}) * ({u[1]})) AS r, ln(-ln(({u[2]}) * ({u[3]}))) AS log_c, {u[4]} AS b
      FROM c, k),
t AS (SELECT *, CAST(floor(l0 / r + b) AS BIGINT) AS t0, CAST(floor(l1 / r + b) AS BIGINT) AS t1 FROM m),
s AS (SELECT doc_id, j, {least[0]} AS m0, {least[1]} AS m1 FROM t GROUP BY doc_id, j),
f AS (SELECT doc_id, coalesce(string_agg(lpad(lower(hex(m0 % 4294967296)), 8, '0'), '' ORDER BY j), '') AS fingerprint,
             coalesce(string_agg(lpad(lower(hex(m1 % 4294967296)), 8, '0'), '' ORDER BY j), '') AS edited_fingerprint
      FROM s GROUP BY doc_id),
a AS (SELECT e.doc_id, e.n_chars, e.next_id, sha256(e.edited) AS edited_sha256,
             coalesce(fingerprint, '') AS fingerprint, coalesce(edited_fingerprint, '') AS edited_fingerprint
      FROM e LEFT JOIN f USING (doc_id))
SELECT a.doc_id, a.n_chars, a.edited_sha256, a.fingerprint, a.edited_fingerprint,
       {alike('a.fingerprint', 'a.edited_fingerprint')} AS near_edited,
       {alike('a.fingerprint', 'n.fingerprint')} AS near_next
FROM a JOIN a n ON a.next_id = n.doc_id
"""
