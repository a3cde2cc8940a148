"""Operator 8: inclusion probabilities, targets and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from packflow.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_mix(rows: list[tuple], seed: str = "mix", most: int = 3) -> list[int]:
    """Words taken of each (doc_id, source, text), in the order of the rows."""
    size = [len(WORD.findall(t or "")) for _, _, t in rows]
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows) if r[1] == s) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, open_ = {}, sum(total.values()), set(names)
    while open_:
        w = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] > most * total[s] * w]
        if not over:
            target |= {s: left * weight[s] / w for s in open_}
            break
        for s in over:
            target[s] = most * total[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    taken = [0] * len(rows)
    for s in names:
        mine = [k for k, r in enumerate(rows) if r[1] == s and size[k]]
        if not mine:
            continue
        whole = int(target[s] // total[s])
        rest = target[s] - whole * total[s]
        sizes, factor = sorted((size[k] for k in mine), reverse=True), 0.0
        for t in sorted(set(sizes), reverse=True):
            factor = (rest - sum(x for x in sizes if x > t)) / sum(x * x for x in sizes if x <= t)
            if factor * t <= 1:
                break
        order = []
        for k in mine:
            chance = min(1.0, factor * size[k])
            digest = hashlib.md5(f"{rows[k][0]}:{seed}".encode()).hexdigest()
            u = (int(digest[:13], 16) + 0.5) / 2 ** 52
            if chance > 0:
                q = 0.0 if chance >= 1 else (u / (1 - u)) / (chance / (1 - chance))
                order.append((q / (1 + q), rows[k][0], size[k], k))
        words, chosen = 0, set()
        for _, _, n, k in sorted(order):
            words += n
            if words - n / 2 <= rest:
                chosen.add(k)
        for k in mine:
            taken[k] = (whole + (k in chosen)) * size[k]
    return taken


def test_against_plain(spark):
    rows = [(i, ["a", "b", None, "c c"][i * i % 4], " ".join(["w"] * (i * 7 % 23))) for i in range(400)]
    rows += [(1000, "huge", "w " * 5000), (1001, "none", None), (1002, "none", " ")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)
    got = {r["doc_id"]: r["taken"] for r in mixing.mix(df).collect()}
    assert got == {r[0]: t for r, t in zip(rows, plain_mix(rows))}


def test_inclusion_frequencies(spark):
    """Over many independent sources of the same shape a document is taken as
    often as its inclusion probability says: in proportion to its words, long
    ones always."""
    sizes = [1, 2, 4, 8, 16, 32, 300]
    draws = 900
    rows = [(s * 100 + k * 10 + c, f"s{s:04d}", " ".join(["w"] * n)) for s in range(draws)
            for k, n in enumerate(sizes) for c in range(6 if n < 300 else 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(df).where(F.col("target") < F.col("source_size"))  # of weight 1: half of the words
    by = {(r["size"]): (r["n"], r["k"]) for r in out.groupBy("size").agg(
        F.count("*").alias("n"), F.sum("copies").alias("k")).collect()}
    one = out.select("target", "source_size").first()
    every = [n for n in sizes for _ in range(6 if n < 300 else 1)]
    assert one["source_size"] == sum(every) and one["target"] == pytest.approx(sum(every) / 2)
    factor = (one["target"] - 300) / sum(n * n for n in every if n < 300)
    assert factor * 32 <= 1  # only the document of 300 words is certain
    assert by[300][0] == by[300][1]
    for n in sizes[:-1]:
        want = factor * n
        assert by[n][1] / by[n][0] == pytest.approx(want, abs=0.035 + 0.08 * want)
    assert by[32][1] / by[32][0] > 10 * by[2][1] / by[2][0]


def test_clashing_columns(spark):
    names = ["weight", "rest", "chance", "whole", "size", "_size", "m_size", "p_rest", "rank", "n", "_d0"]
    rows = [(i, f"s{i % 2}", "a b c", *[f"x{k}" for k in range(len(names))]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, " + ", ".join(f"{n} string" for n in names))
    out = mixing.mix(df)
    kept = collections.Counter(n for n in names if n != "size")
    assert kept <= collections.Counter(out.columns) and len(out.columns) == len(set(out.columns))
    assert {r["weight"] for r in out.collect()} == {"x0"} and {r["size"] for r in out.collect()} == {3}
