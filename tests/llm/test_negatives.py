"""Operator 13 against plain products."""

from __future__ import annotations

import math

import numpy as np
import pytest

from packflow.llm import negatives as N

VECTORS = "vec_id long, embedding array<double>, label int, score string, key int, rank int"


def plain(rows: list[tuple]) -> set[tuple]:
    kept = set()
    for i, e, y in rows:
        if i is None or e is None or y is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * x) for x in e)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, la, va in kept:
        if a % 100:
            continue
        scored = sorted(((-dot(va, v), i, y) for i, y, v in kept if i != a))
        for sp, p, _ in [r for r in scored if r[2] == la][:5]:
            near = [r for r in scored if r[2] != la and 80 * -sp <= 100 * -r[0] <= 100 * -sp]
            out |= {(a, p, k, n, -sp, -sn) for k, (sn, n, _) in enumerate(near[:5], 1)}
    return out


def found(df) -> set[tuple]:
    rows = [(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"])
            for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, y, "s", 1, 2) for i, e, y in rows], VECTORS)


@pytest.mark.parametrize("bias, width", [(0, 4), (300, 4), (300, 8), (1 << 26, 12)])
def test_packed_scores_are_exact(bias, width):
    rng = np.random.RandomState(width)
    top = 200 if bias < 1000 else bias
    x, a = rng.randint(-min(bias, top), top, (333, 9)), rng.randint(-min(bias, top), top, 9)
    page = N.Page(np.arange(333), np.zeros(333, int), x, bias, width)
    assert (page.scores((a + bias).tolist(), int(a.sum())) == x @ a).all()


def test_field_width():
    assert N.field_bytes(64, 512) == 4 and N.field_bytes(64, 1 << 20) == 8 and N.field_bytes(512, 1 << 28) == 9


def test_mining(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 100)
    monkeypatch.setattr(N, "PAGE", 16)
    rng = np.random.RandomState(1)
    rows = [(i, rng.normal(size=5).round(2).tolist(), int(rng.randint(4))) for i in range(420)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)]          # copies: ties by smaller id
    rows += [rows[5], rows[100], (None, [1.0], 1), (700, None, 1), (800, [1.0], None), (900, [float("nan")], 1),
             (901, [None, 1.0], 2), (902, [float("inf")], 2), (1200, [], 2), (1300, [2.0], 3), (-100, [1.0, -2.0], 0)]
    got = found(N.op13(frame(spark, rows)))
    assert got and got == plain(rows)


def test_large_components(spark):
    rng = np.random.RandomState(2)
    rows = [(i * 10, (rng.normal(size=6) * 3000).tolist(), i % 3) for i in range(60)]
    assert found(N.op13(frame(spark, rows))) == plain(rows)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert found(N.op13(table)) == plain(rows)


def test_few_rows(spark):
    assert found(N.op13(frame(spark, []))) == set()
    assert found(N.op13(frame(spark, [(100, [1.0], 1)]))) == set()


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(100, [1.0, 0.0], 1), (100, [0.0, 1.0], 2), (1, [1.0, 0.0], 1), (2, [0.9, 0.1], 3), (3, [0.0, 1.0], 2)]
    got = {(r["anchor_key"], r["anchor_id"], r["positive_id"], r["negative_id"])
           for r in N.mine(frame(spark, rows)).collect()}
    assert len({k for k, *_ in got}) == 1 and {g[1:] for g in got} == {(100, 1, 2)}
