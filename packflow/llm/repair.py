"""Operator 11: conversation structure repair by prefix-doubling path ranking.

A conversation's roles must read ``(s?(ua)+)?`` by their initials. The grammar
has four states (nothing yet, after s, after u, after a); a node is a position
in the conversation and a state. A backward cost DP gives each node's cheapest
way to the end; arcs that keep that cost are optimal. Nodes are then ranked by
the least string of 1, 2, 4, ... edits that optimal arcs spell from them: a
rank pairs the node's rank with the rank of the node its doubled pointer leads
to. Ranks choose each node's arc, and the audit is read off the doubled
pointers, all conversations of a batch at once.

A conversation of any length is cut into segments, the runs of it in range
partitions. A segment is a 4 x 4 matrix of least costs between entry and exit
states, so exit costs come from a product over segments backwards, and entry
states from each segment's map of states forwards; both tables have at most two
rows for each range partition. Only segments at the ends of a partition take
part; all others are whole conversations. Equal rows (turn, role and text) are
one row with a count before anything is sorted. The digest of a conversation's
repaired text is sequential by nature and is streamed over its segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.llm.common import buckets_for, prepare, written
from packflow.llm.oracle import CRC_TABLE, crc_sql

DROP, EMPTY, STRIP, TWICE, USER = range(5)
MODULUS = 20

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAR = np.int64(1 << 56)

#: states: 0 nothing yet, 1 after s, 2 after u, 3 after a; NEXT takes the one role that may be put there
NEXT = np.array([2, 2, 3, 2])
ROLE_INTO = {2: "user", 3: "assistant"}
#: KEPT[role code, state]: state after keeping the row, -1 where the grammar forbids it (codes: s, u, a, other)
KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
END_COST = np.array([0, 2 * INSERT, INSERT, 0], np.int64)  # missing roles at the end of a conversation
LETTERS = ("", "D", "I", "K", "R")  # by code, in ASCII order
PLAIN, CUT, FORCED = 0, 1, 2  # kinds of steps: whole row, truncated row, rows that must go
PART_BYTES = 16 << 20


def damage(conversations: DataFrame) -> DataFrame:
    """The test damage of the contract: conv_id, turn, role, text, n (copies).

    Nulls are written as one space in the key, the role and the text; the turn
    stays null. Rows with equal key are damaged alike; extra columns go."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % MODULUS
    return (conversations
            .select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"),
                    space("text").alias("text"), kind.alias("kind"))
            .where(F.col("kind") != DROP)
            .select("conv_id", "turn",
                    F.when(F.col("kind") == USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == EMPTY, F.lit(""))
                    .when(F.col("kind") == STRIP, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    F.when(F.col("kind") == TWICE, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("n")))


# --- cost DP, ranks and paths over lanes of steps -------------------------------


class Lanes:
    """Segments of similar length side by side: steps padded to one width.

    ``kind``, ``role`` and ``count`` are lanes x steps, ``size`` the true
    lengths, ``exits`` lanes x 4 costs from the end of the segment on."""

    def __init__(self, kind: np.ndarray, role: np.ndarray, count: np.ndarray, size: np.ndarray, exits: np.ndarray):
        self.kind, self.role, self.count, self.size = kind, role, count, size
        lanes, steps = kind.shape
        self.steps = steps
        h = np.full((lanes, steps + 1, 4), FAR, np.int64)
        h[np.arange(lanes), size] = exits
        for i in range(steps - 1, -1, -1):
            on = size > i
            h[on, i] = self._relax(h[on, i + 1], i, on)
        self.h = h

    def _arcs(self, after: np.ndarray, i, on) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs of deleting, keeping and retitling the step (without inserts)."""
        kind, role, count = (x[on, i][..., None] for x in (self.kind, self.role, self.count))
        forced = kind == FORCED
        late = np.where(kind == CUT, TRUNCATED, 0)
        delete = after + np.where(forced, DELETE * count, DELETE)
        into = KEPT[np.broadcast_to(role, after.shape), np.arange(4)]
        keep = np.take_along_axis(after, np.maximum(into, 0), -1) + KEEP + late
        keep = np.where(forced | (into < 0), FAR, keep)
        rerole = np.where(forced | (into >= 2), FAR, after[..., NEXT] + REROLE + late)
        return delete, keep, rerole

    def _relax(self, after: np.ndarray, i, on) -> np.ndarray:
        plain = np.minimum.reduce(self._arcs(after, i, on))
        out = plain.copy()
        out[..., 2] = np.minimum(plain[..., 2], INSERT + plain[..., 3])
        out[..., 3] = np.minimum(plain[..., 3], INSERT + plain[..., 2])
        for q in (0, 1):
            out[..., q] = np.minimum(plain[..., q], INSERT + out[..., 2])
        return np.minimum(out, FAR)

    def rank(self) -> None:
        """Ranks nodes by the least strings of 2^k optimal edits, doubling k;
        the ranks choose each node's arc, whose doubled pointers are kept."""
        lanes, width = self.kind.shape[0], self.steps + 1
        node = np.arange(lanes * width * 4).reshape(lanes, width, 4)
        here, after, ahead = self.h[:, :-1], self.h[:, 1:], node[:, 1:]
        real = (np.arange(self.steps) < self.size[:, None])[..., None] & (here < FAR)
        delete, keep, rerole = self._arcs(after, slice(None), slice(None))
        into = KEPT[np.broadcast_to(self.role[..., None], here.shape), np.arange(4)]
        # by letter: D, I, K, R; an edit letter leaves a node by one arc at most
        ways = [(delete, ahead), (here[..., NEXT] + INSERT, node[:, :-1][..., NEXT]),
                (keep, np.take_along_axis(ahead, np.maximum(into, 0), -1)), (rerole, ahead[..., NEXT])]
        arcs = [(code, np.flatnonzero(np.pad(real & (cost == here), ((0, 0), (0, 1), (0, 0)))),
                 to[real & (cost == here)]) for code, (cost, to) in enumerate(ways, 1)]
        rank, step = np.zeros(node.size, np.int64), node.reshape(-1).copy()
        for code, at, to in reversed(arcs):
            rank[at], step[at] = code, to
        while True:
            rank = np.unique(rank * (int(rank.max()) + 1) + rank[step], return_inverse=True)[1]
            far = step[step]
            if (far == step).all():
                break
            step = far
        self.letter, best = np.zeros(node.size, np.int8), np.full(node.size, np.iinfo(np.int64).max)
        step = node.reshape(-1).copy()
        for code, at, to in arcs:
            order = code * (int(rank.max()) + 1) + rank[to]
            less = order < best[at]
            at, to = at[less], to[less]
            best[at], self.letter[at], step[at] = order[less], code, to
        self.pointers = [step]
        while not ((far := step[step]) == step).all():
            self.pointers.append(far)
            step = far

    def paths(self, states: np.ndarray) -> np.ndarray:
        """Nodes of each lane's least path from its entry state, read off the
        doubled pointers; the last node repeats."""
        starts = (np.arange(len(states)) * (self.steps + 1)) * 4 + states
        out = starts[:, None]
        for p in self.pointers:
            out = np.concatenate([out, p[out]], 1)
        return out


def _lanes(batch: list[dict], exits: np.ndarray) -> Iterator[tuple[np.ndarray, Lanes]]:
    """Lanes of segments whose lengths differ less than twofold, with their row numbers."""
    size = np.array([len(b["kind"]) for b in batch], np.int64)
    level = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
    for k in np.unique(level):
        of = np.flatnonzero(level == k)
        most = max(1, (1 << 16) >> k)
        for at in range(0, len(of), most):
            rows = of[at: at + most]
            width = int(size[rows].max())
            grid = [np.zeros((len(rows), width), np.int64) for _ in range(3)]
            for lane, r in enumerate(rows):
                for g, name in zip(grid, ("kind", "role", "count")):
                    g[lane, : size[r]] = batch[r][name]
            yield rows, Lanes(*grid, size[rows], exits[rows])


def matrix(batch: list[dict]) -> np.ndarray:
    """Least cost of each segment between every entry and exit state."""
    out = np.full((len(batch), 4, 4), FAR, np.int64)
    for q in range(4):
        unit = np.full((len(batch), 4), FAR, np.int64)
        unit[:, q] = 0
        for rows, lanes in _lanes(batch, unit):
            out[rows, :, q] = lanes.h[:, 0]
    return out


def exit_states(batch: list[dict], exits: np.ndarray) -> np.ndarray:
    """Exit state of each segment's least path from every entry state."""
    out = np.zeros((len(batch), 4), np.int64)
    for rows, lanes in _lanes(batch, exits):
        lanes.rank()
        for q in range(4):
            out[rows, q] = lanes.paths(np.full(len(rows), q))[:, -1] % 4
    return out


def least_edits(batch: list[dict], exits: np.ndarray, entry: np.ndarray, final: np.ndarray) -> list[tuple]:
    """(cost, audit, [(edit, role, text)]) of each segment's least path."""
    out: list = [None] * len(batch)
    for rows, lanes in _lanes(batch, exits):
        lanes.rank()
        nodes = lanes.paths(entry[rows])
        for lane, r in enumerate(rows):
            b = batch[r]
            path = nodes[lane]
            done = int(np.argmax(lanes.letter[path] == 0))  # the last node spells nothing
            path, left = path[:done], int(path[done])
            audit, kept = [], []
            for v, code in zip(path.tolist(), lanes.letter[path].tolist()):
                step, q = (v // 4) % (lanes.steps + 1), v % 4
                if code == 1:
                    audit.append("D" * (b["count"][step] if b["kind"][step] == FORCED else 1))
                    continue
                audit.append(LETTERS[code])
                row = b["row"][step] if code != 2 else None
                role = b["roles"][row] if code == 3 else ROLE_INTO[int(NEXT[q])]
                kept.append((LETTERS[code], role, "" if row is None else b["texts"][row]))
            state = left % 4
            cost = int(lanes.h[lane, 0, entry[r]] - exits[r, state])
            while final[r] and END_COST[state]:
                audit.append("I")
                state = int(NEXT[state])
                kept.append(("I", ROLE_INTO[state], ""))
                cost += INSERT
            out[r] = (cost, "".join(audit), kept)
    return out


# --- segments ---------------------------------------------------------------------

ROWS = ("role", "text", "fault", "first", "n")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation -> one row for each conversation's run in
    this partition; ``edge`` where the run touches the partition's ends."""
    held: list[pa.RecordBatch] = []  # rows of the conversation that is still open
    number = 0

    def close(rows: pa.RecordBatch, offsets: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        nonlocal number
        ids = np.arange(number, number + len(edge))
        number += len(edge)
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows.column(c)) for c in ROWS]
        heads = pa.array(offsets[:-1])
        return pa.RecordBatch.from_arrays(
            [rows.column("conv").take(heads), rows.column("part").take(heads), pa.array(ids, pa.int64()),
             pa.array(edge), *lists], names=["conv", "part", "place", "edge", *ROWS])

    def one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        return t.to_batches(max_chunksize=max(1, t.num_rows))[0]

    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column("conv")
        same = conv.slice(1).equals(conv.slice(0, b.num_rows - 1)) if b.num_rows > 1 else True
        if same:
            cuts = np.zeros(0, np.int64)
        else:
            a, z = conv.slice(1).to_pylist(), conv.slice(0, b.num_rows - 1).to_pylist()
            cuts = np.flatnonzero([x != y for x, y in zip(a, z)]) + 1
        edges = [0, *cuts.tolist(), b.num_rows]
        if held and held[0].column("conv")[0].as_py() != conv[0].as_py():
            rows = one(held)
            yield close(rows, np.array([0, rows.num_rows]), np.array([number == 0]))
            held = []
        held.append(b.slice(0, edges[1]))
        if len(edges) > 2:
            rows = one(held)
            yield close(rows, np.array([0, rows.num_rows]), np.array([number == 0]))
            if len(edges) > 3:
                inner = np.array(edges[1:-1])
                yield close(b.slice(edges[1], edges[-2] - edges[1]), inner - inner[0], np.zeros(len(inner) - 1, bool))
            held = [b.slice(edges[-2])]
    if held:
        rows = one(held)
        yield close(rows, np.array([0, rows.num_rows]), np.array([True]))


def _steps(b: pa.RecordBatch) -> list[dict]:
    """Steps of each segment: a row's first copy, then the copies that must go."""
    out = []
    for roles, texts, faults, firsts, counts in zip(*(b.column(c).to_pylist() for c in ROWS)):
        kind, role, count, row = [], [], [], []
        for k, (r, fault, first, n) in enumerate(zip(roles, faults, firsts, counts)):
            if fault != FORCED and first:
                kind.append(fault)
                count.append(1)
                row.append(k)
                n -= 1
            if n:
                kind.append(FORCED)
                count.append(n)
                row.append(k)
            role += ["sua".find(r[0]) % 4 if r else 3] * (len(kind) - len(role))
        out.append({"kind": kind, "role": role, "count": count, "row": row, "roles": roles, "texts": texts})
    return out


def _illegal(roles: list[str], counts: list[int]) -> int:
    """Adjacent rows whose initials may not follow each other."""
    first = [r[:1] for r in roles]
    return sum(n - 1 for n in counts) + sum(x + y not in ("su", "ua", "au") for x, y in zip(first, first[1:]))


PIECE = ("cost long, illegal long, audit string, turns array<struct<edit:string,role:string,text:string>>")


def _piece_batch(b: pa.RecordBatch, solved: list[tuple], keys: list[str]) -> pa.RecordBatch:
    illegal = [_illegal(r, n) for r, n in zip(b.column("role").to_pylist(), b.column("n").to_pylist())]
    turn = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
    return pa.RecordBatch.from_arrays(
        [*(b.column(k) for k in keys), pa.array([s[0] for s in solved], pa.int64()), pa.array(illegal, pa.int64()),
         pa.array([s[1] for s in solved], pa.string()),
         pa.array([[dict(zip(("edit", "role", "text"), t)) for t in s[2]] for s in solved], turn)],
        names=[*keys, "cost", "illegal", "audit", "turns"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        steps = _steps(b)
        n = len(steps)
        solved = least_edits(steps, np.tile(END_COST, (n, 1)), np.zeros(n, np.int64), np.ones(n, bool))
        yield _piece_batch(b, solved, ["conv", "part", "place"])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        m = matrix(_steps(b))
        roles = b.column("role").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column("conv"), b.column("part"), b.column("place"), pa.array([x.reshape(-1).tolist() for x in m], pa.list_(pa.int64())),
             pa.array([r[0][:1] for r in roles]), pa.array([r[-1][:1] for r in roles])],
            names=["conv", "part", "place", "matrix", "head", "tail"])


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, last segment first -> exit costs of each segment."""
    open_, h, head = None, END_COST, ""
    for b in batches:
        exits, final, joint = [], [], []
        for conv, m, first, last in zip(*(b.column(c).to_pylist() for c in ("conv", "matrix", "head", "tail"))):
            new = open_ != (conv,)
            if new:
                open_, h = (conv,), END_COST
            exits.append(h.tolist())
            final.append(new)
            joint.append(0 if new else int(last + head not in ("su", "ua", "au")))
            h, head = np.minimum((np.array(m).reshape(4, 4) + h).min(1), FAR), first
        yield pa.RecordBatch.from_arrays(
            [b.column("part"), b.column("place"), pa.array(exits, pa.list_(pa.int64())), pa.array(final),
             pa.array(joint, pa.int64())], names=["part", "place", "exits", "final", "joint"])


def _exits(b: pa.RecordBatch) -> np.ndarray:
    return np.array(b.column("exits").to_pylist(), np.int64).reshape(-1, 4)


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        m = exit_states(_steps(b), _exits(b))
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("part"), b.column("place"),
                                          pa.array(m.tolist(), pa.list_(pa.int64()))],
                                         names=["conv", "part", "place", "states"])


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation, first segment first -> entry state of each segment."""
    open_, state = None, 0
    for b in batches:
        entry = []
        for conv, states in zip(b.column("conv").to_pylist(), b.column("states").to_pylist()):
            if open_ != (conv,):
                open_, state = (conv,), 0
            entry.append(state)
            state = states[state]
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("place"), pa.array(entry, pa.int64())],
                                         names=["part", "place", "entry"])


def _edged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        final, entry = (np.array(b.column(c).to_pylist()) for c in ("final", "entry"))
        solved = least_edits(_steps(b), _exits(b), entry.astype(np.int64), final.astype(bool))
        out = _piece_batch(b, solved, ["conv", "part", "place"])
        illegal = np.array(out.column("illegal")) + np.array(b.column("joint"))
        yield out.set_column(out.schema.get_field_index("illegal"), "illegal", pa.array(illegal, pa.int64()))


def faults(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, n -> fault (0 none, 1 truncated, 2 blank: must
    go) and first (no earlier row has this role and text). Rows are distinct."""
    text = F.col("text")
    fault = (F.when(~text.rlike(r"[^\x20\x09-\x0D]"), FORCED)
             .when(text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), PLAIN).otherwise(CUT)).cast("int")
    rows = rows.withColumn("fault", fault).withColumn("_text", F.sha2(text.cast("binary"), 256))
    # the earliest turn of a role and text, by a partial aggregate: a text that repeats in every row meets nowhere
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    early = (rows.groupBy("conv", "role", "_text").agg(F.min(turn).alias("at"))
             .select(F.col("conv").alias("e_conv"), F.col("role").alias("e_role"), F.col("_text").alias("e_text"),
                     F.col("at.turn").alias("e_turn")))
    same = (F.col("conv").eqNullSafe(F.col("e_conv")) & (F.col("role") == F.col("e_role"))
            & (F.col("_text") == F.col("e_text")) & F.col("turn").eqNullSafe(F.col("e_turn")))
    return (rows.join(early, same, "left").withColumn("first", F.col("e_text").isNotNull())
            .select("conv", "turn", "role", "text", "n", "fault", "first"))


def segments(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows with faults, and the written segments of all conversations."""
    spark = rows.sparkSession
    prepare(spark)
    rows = written(faults(rows), "turns")
    size = rows.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    parts = buckets_for(size, PART_BYTES)
    kind = rows.schema["conv"].dataType.simpleString()
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    placed = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .select("conv", F.spark_partition_id().cast("long").alias("part"), *ROWS))
    cut = placed.mapInArrow(_segments, f"conv {kind}, part long, place long, edge boolean, role array<string>, "
                                       "text array<string>, fault array<int>, first array<boolean>, n array<long>")
    return rows, written(cut, "segments")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repairs conversations given as conv, turn, role, text, n (copies).

    Returns (rows with their faults, pieces): a piece is a conversation's run
    in one partition, in the order (part, place), with cost, illegal pairs,
    audit and the repaired turns (edit K, R or I, role, text); most
    conversations are one piece (``edge`` false). Rows are ordered by turn
    (nulls first), then role and text; rows equal in all of these are copies.
    Roles and texts must not be null. A role without a first letter s, u or a
    (an empty one too) cannot be kept. An empty table gives no pieces."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    rows, cut = segments(rows)
    kind = cut.schema["conv"].dataType.simpleString()
    keys = f"conv {kind}, part long, place long"
    whole = cut.where(~F.col("edge")).mapInArrow(_whole, f"{keys}, {PIECE}").withColumn("edge", F.lit(False))
    # at most two edge segments a partition: their matrices and maps are small tables
    edge = cut.where("edge")
    by = ["part", "place"]
    small = lambda df, *order: df.repartition("conv").sortWithinPartitions(F.col("conv"), *order)
    mats = edge.mapInArrow(_matrices, f"{keys}, matrix array<long>, head string, tail string")
    exits = written(small(mats, F.desc("part"), F.desc("place")).mapInArrow(
        _backwards, "part long, place long, exits array<long>, final boolean, joint long"), "exits")
    edge = edge.join(exits, by)
    maps = edge.mapInArrow(_maps, f"{keys}, states array<long>")
    entry = written(small(maps, F.asc("part"), F.asc("place")).mapInArrow(
        _forwards, "part long, place long, entry long"), "entries")
    ends = edge.join(entry, by).mapInArrow(_edged, f"{keys}, {PIECE}").withColumn("edge", F.lit(True))
    return rows, whole.unionByName(ends)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces by conversation in order -> one row each; the text is streamed."""
    open_, audits, total, started = None, [], [0, 0], False
    sha = hashlib.sha256()

    def close():
        return open_[0], total[0], total[1], "".join(audits), sha.hexdigest()

    for b in batches:
        done = []
        for conv, cost, illegal, audit, turns in zip(*(b.column(c).to_pylist() for c in (
                "conv", "cost", "illegal", "audit", "turns"))):
            if open_ != (conv,):
                if open_ is not None:
                    done.append(close())
                open_, audits, total, started, sha = (conv,), [], [0, 0], False, hashlib.sha256()
            total = [total[0] + cost, total[1] + illegal]
            audits.append(audit)
            for t in turns:
                sha.update(("\n" if started else "").encode() + f"{t['role']}:{t['text']}".encode())
                started = True
        yield _rows(done, b.schema.field("conv").type)
    if open_ is not None:
        yield _rows([close()], b.schema.field("conv").type)


def _rows(rows: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    kinds = [conv, pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(5)],
                                      names=["conv", "cost", "illegal", "audit", "repaired_sha256"])


def digests(pieces: DataFrame) -> DataFrame:
    """conv, cost, illegal, audit, repaired_sha256 of every conversation with rows."""
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = pieces.where(~F.col("edge")).select(
        "conv", "cost", "illegal", "audit", F.sha2(text.cast("binary"), 256).alias("repaired_sha256"))
    kind = pieces.schema["conv"].dataType.simpleString()
    ends = (pieces.where("edge").repartition("conv").sortWithinPartitions("conv", "part", "place")
            .mapInArrow(_digest, f"conv {kind}, cost long, illegal long, audit string, repaired_sha256 string"))
    return whole.unionByName(ends)


def op11(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after the contract's damage.

    Null ids are one conversation; a conversation whose rows are all dropped
    has zeros, an empty audit and the digest of the empty text."""
    ids = conversations.select("conv_id").distinct()
    rows, pieces = repair(damage(conversations).withColumnRenamed("conv_id", "conv"))
    blank, copy = F.col("fault") == FORCED, ~F.col("first")
    zero = F.lit(0).cast("long")
    turns = (rows.groupBy("conv", "turn").agg(
        F.sum(F.when(blank, F.col("n")).otherwise(zero)).alias("blank"),
        F.sum(F.when(~blank, F.when(copy, F.col("n")).otherwise(F.col("n") - 1)).otherwise(zero)).alias("duplicate"),
        F.sum(F.when((F.col("fault") == CUT) & F.col("first"), 1).otherwise(zero)).alias("truncated")))
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn") + 1 - F.count("turn")
    counts = turns.groupBy("conv").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    every = ids.join(counts, ids["conv_id"].eqNullSafe(counts["conv"]), "left").drop("conv")
    done = digests(pieces)
    every = every.join(done, every["conv_id"].eqNullSafe(done["conv"]), "left")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in longs],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op11_sql() -> str:
    """The cost DP in DuckDB, backwards row by row with the least audits and
    texts carried along (letters differ, so the least suffix stays least)."""
    row = lambda cost, letter, line, q: (
        f"{{'c': {cost} + r.s{q}.c, 'a': '{letter}' || r.s{q}.a, 't': "
        + (f"list_prepend({line}, r.s{q}.t)}}" if line else f"r.s{q}.t}}"))
    keeps = {0: "CASE initial WHEN 's' THEN list_sort([{s}, {r}])[1] WHEN 'u' THEN {u} ELSE {r} END",
             1: "CASE initial WHEN 'u' THEN {u} ELSE {r} END",
             2: "CASE initial WHEN 'a' THEN {a} ELSE {r} END", 3: "CASE initial WHEN 'u' THEN {u} ELSE {r} END"}
    line = "(role || ':' || text)"
    plain = []
    for q in range(4):
        to = int(NEXT[q])
        kept = keeps[q].format(s=row("late", "K", line, 1), u=row("late", "K", line, 2), a=row("late", "K", line, 3),
                               r=row("1 + late", "R", f"('{ROLE_INTO[to]}:' || text)", to))
        plain.append(f"CASE WHEN forced THEN {row('2', 'D', '', q)} ELSE list_sort([{row('2', 'D', '', q)}, {kept}])[1] END AS p{q}")
    put = lambda p, q: f"{{'c': 5 + {p}.c, 'a': 'I' || {p}.a, 't': list_prepend('{ROLE_INTO[q]}:', {p}.t)}}"
    return rf"""
WITH RECURSIVE {CRC_TABLE},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
g AS (SELECT conv_id, turn, role, text, {crc_sql('key')} % 20 AS kind FROM k, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
      FROM g WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn FROM d),
f AS (SELECT *, substr(role, 1, 1) AS initial, NOT regexp_matches(text, '[^ 	-
]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
             NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM o),
n AS (SELECT *, blank OR again AS forced, CASE WHEN cut THEN 5 ELSE 0 END AS late FROM f),
r AS (SELECT conv_id, CAST(max(rn) AS BIGINT) AS i, {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s0,
             {{'c': 10, 'a': 'II', 't': ['user:', 'assistant:']}} AS s1, {{'c': 5, 'a': 'I', 't': ['assistant:']}} AS s2,
             {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s3 FROM n GROUP BY conv_id
      UNION ALL
      SELECT conv_id, i - 1,
             list_sort([p0, {{'c': 5 + h2.c, 'a': 'I' || h2.a, 't': list_prepend('user:', h2.t)}}])[1],
             list_sort([p1, {{'c': 5 + h2.c, 'a': 'I' || h2.a, 't': list_prepend('user:', h2.t)}}])[1], h2,
             list_sort([p3, {put('p2', 2)}])[1]
      FROM (SELECT *, list_sort([p2, {put('p3', 3)}])[1] AS h2
            FROM (SELECT r.conv_id, r.i, {', '.join(plain)}
                  FROM r JOIN n ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.i = n.rn WHERE r.i > 0))),
z AS (SELECT conv_id, s0 FROM r WHERE i = 0),
q AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND again) AS duplicate,
             count(*) FILTER (WHERE NOT forced AND cut) AS truncated,
             count(*) FILTER (WHERE rn > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
      FROM n GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(q.blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(s0.c, 0) AS BIGINT) AS cost, coalesce(s0.a, '') AS audit,
       sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN q ON c.conv_id IS NOT DISTINCT FROM q.conv_id
LEFT JOIN z ON c.conv_id IS NOT DISTINCT FROM z.conv_id
"""
