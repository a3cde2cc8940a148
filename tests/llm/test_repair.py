"""Operator 11 against a search over all edits, and on hand-made rows."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import numpy as np
import pytest

from packflow.llm import repair as R

CONV = "conv_id long, turn long, role string, text string, conv string, n int, fault int"


def damaged(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if k == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def cheapest(rows: list[tuple]) -> tuple[int, str, str, list[int]]:
    """Best-first search by (cost, audit) over every edit of every row."""
    seen, fault = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        if not words:
            fault.append("blank")
        elif (role, text) in seen:
            fault.append("duplicate")
        else:
            fault.append("" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, last, out = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            counts = [fault.count(x) for x in ("blank", "duplicate", "truncated")]
            return cost, audit, "\n".join(out), counts
        push = lambda c, e, j, x, o: heapq.heappush(queue, (cost + c, audit + e, j, x, out + o))
        for x in legal[last]:
            if x != "s":
                push(5, "I", i, x, ({"u": "user:", "a": "assistant:"}[x],))
        if i < len(rows):
            push(2, "D", i + 1, last, ())
            if fault[i] not in ("blank", "duplicate"):
                more = 5 if fault[i] else 0
                _, role, text = rows[i]
                if role[:1] and role[0] in legal[last]:
                    push(more, "K", i + 1, role[0], (f"{role}:{text}",))
                for x in legal[last]:
                    if x != "s":
                        push(1 + more, "R", i + 1, x, ({"u": "user", "a": "assistant"}[x] + ":" + text,))


def plain(table: list[tuple]) -> dict:
    out = {}
    for conv in {r[0] for r in table}:
        rows = damaged([r for r in table if r[0] == conv])
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, text, counts = cheapest(rows)
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def as_dict(df) -> dict:
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in rows}


def random_rows(seed: int, convs: int, most: int) -> list[tuple]:
    rng = np.random.RandomState(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "assistant"]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "A long one. With two", "été!  ", "x"]
    out = []
    for c in range(convs):
        for t in range(rng.randint(1, most)):
            turn = None if rng.rand() < 0.1 else int(rng.randint(0, most)) - 2
            out.append((c if c else None, turn, roles[rng.randint(len(roles))], texts[rng.randint(len(texts))]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = random_rows(seed, 150, 12)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CONV)
    assert as_dict(R.op11(df)) == plain(rows)


def test_one_conversation_over_many_partitions(spark, monkeypatch):
    """A conversation with nearly all rows is cut into segments; the result stays that of one search."""
    monkeypatch.setattr(R, "PART_BYTES", 1500)
    rows = [(7, int(t), r, x) for (_, _, r, x), t in zip(random_rows(5, 80, 12), range(10_000))]
    rows += [(7, 3, "user", "Yes.")] * 50 + random_rows(6, 30, 6)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CONV)
    found = R.op11(df)
    assert as_dict(found) == plain(rows)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(R.op11(table)) == plain(rows)


def test_empty_table_and_dropped_conversation(spark):
    assert R.op11(spark.createDataFrame([], CONV)).count() == 0
    drop = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = as_dict(R.op11(spark.createDataFrame([(drop, 0, "user", "a", "", 0, 0)], CONV)))
    assert got == {drop: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_pieces_hold_the_repaired_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 1), (1, 1, "user", "Well.", 1)],
                                 "conv long, turn long, role string, text string, n long")
    pieces = R.repair(rows)[1].orderBy("part", "place").collect()
    assert "".join(p["audit"] for p in pieces) == "KR" and sum(p["cost"] for p in pieces) == 1
    turns = [tuple(t) for p in pieces for t in p["turns"]]
    assert turns == [("K", "user", "Hi."), ("R", "assistant", "Well.")]
