"""Operator 12 against plain weighted samples and exact likeness."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np

from packflow.llm import fingerprint as P

DOCS = "doc_id long, text string, h string, n int, samples string, kid string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"word{i % 37}" for i in range(90))


def bag(text: str) -> dict:
    return collections.Counter(WORD.findall(text))


def plain_print(text: str, samples: int) -> str:
    out = []
    for k in P.constants(samples):
        best = None
        for word, n in bag(text).items():
            x = zlib.crc32(word.encode())
            u = [((x * k[2 * i] + k[2 * i + 1]) % P.PRIME + 0.5) / P.PRIME for i in range(5)]
            r, log_c = -math.log(u[0] * u[1]), math.log(-math.log(u[2] * u[3]))
            t = math.floor(math.log(n) / r + u[4])
            pair = (x * P.IDENTITY[0] + t * P.IDENTITY[1]) % (1 << 32)
            item = (math.floor((log_c - r * (t - u[4] + 1) + 128) * (1 << 23)), pair)
            best = item if best is None else min(best, item)
        out.append("" if best is None else f"{best[1]:08x}")
    return "".join(out)


def alike(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    cut = lambda s: [s[i: i + 8] for i in range(0, len(s), 8)]
    return sum(x == y for x, y in zip(cut(a), cut(b))) / (len(a) // 8)


def plain(rows: list[tuple]) -> list[tuple]:
    """Rows of distinct ids in the order of the contract."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new = plain_print(text, P.SAMPLES), plain_print(edited, P.SAMPLES)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, new, alike(own, new),
                    alike(own, plain_print(after, P.SAMPLES))))
    return sorted(out, key=str)


def found(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "h", 1, "s", "k") for i, t in rows], DOCS)


def test_against_plain_samples(spark, monkeypatch):
    monkeypatch.setattr(P, "IDS", 3)  # several parts: the borders matter
    texts = [None, "", " \n\t ", BASE, BASE, BASE.replace("word7 ", "other "), "a", "été 東京 naïve 😀 x", "x " * 50,
             " ".join(f"Long{i % 700}" for i in range(9000)), BASE.upper()]
    rows = [(i * 3 - 4, t) for i, t in enumerate(texts)] + [(None, "no id, " + BASE)]
    assert found(P.op12(frame(spark, rows))) == plain(rows)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert found(P.op12(table)) == plain(rows)


def test_repeated_rows_and_ids(spark):
    rows = [(5, BASE)] * 3 + [(5, "other words here"), (2, "two")]
    got = found(P.op12(frame(spark, rows)))
    assert len(got) == 5
    copies = [r for r in got if r[0] == 5 and r[1] == len(BASE)]
    half = len(BASE) // 2
    own = hashlib.sha256((BASE[: len(BASE) - half] + BASE[:half]).encode()).hexdigest()
    assert [r[2] == own for r in copies].count(True) == 2 and sum(r[6] == 1.0 for r in copies) == 2
    assert len({r[3] for r in copies}) == 1


def test_few_rows(spark):
    assert found(P.op12(frame(spark, []))) == []
    (row,) = found(P.op12(frame(spark, [(1, "alone it stands")])))
    assert row[6] == 1.0 and row[2] == hashlib.sha256(b"alone italone i").hexdigest()
    assert found(P.op12(frame(spark, [(1, None)])))[0][3:] == ("", "", 1.0, 1.0)


def test_fingerprints_keep_every_row(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (None, None)]
    got = P.fingerprints(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "1", "None"]


def test_texts_that_miss_the_bound_are_done_again(spark, monkeypatch):
    """With next to no reach hardly a sample is met at first; the result stays the same."""
    rows = [(i, BASE[i * 7:] + f" own{i}") for i in range(6)] + [(9, " ")]
    monkeypatch.setattr(P, "REACH", 0.3)
    assert found(P.op12(frame(spark, rows))) == plain(rows)


def test_collision_rate_is_weighted_jaccard(spark):
    """Over many samples the share of equal ones meets sum min / sum max."""
    rng = np.random.RandomState(4)
    texts = [" ".join(f"w{rng.zipf(1.5) % 200}" for _ in range(300)) for _ in range(6)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    got = {r["k"]: r["text"] for r in P.samples_of(rows, ["k"], ["text"], 400, bounded=False).collect()}
    for i in range(6):
        for j in range(i):
            a, b = bag(texts[i]), bag(texts[j])
            words = set(a) | set(b)
            exact = sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words)
            share = np.mean([x == y for x, y in zip(got[i], got[j])])
            assert abs(share - exact) < 4 * math.sqrt(exact * (1 - exact) / 400) + 0.01
