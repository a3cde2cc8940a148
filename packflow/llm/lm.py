"""Operator 2: language-model scores by online logistic context mixing.

A text is its lower-cased words and one end. Words are coded in binary
decisions: frequent words, the end and an escape along the path of a Huffman
tree; an escaped word by its training count or, as new word, by its bytes along
a second tree. Each decision is predicted by several hashed contexts (tree node
with nothing, the previous word, the last function word, both; for bytes the
last one to four and the whole prefix). Every context slot holds counts of
both outcomes from all training texts; their logits are mixed by weights that a
gate selects and that online gradient steps have learned. While a document is
read, the mix is refined: several sharpnesses of its logits are weighed by how
well they predicted the segments before, so bits per byte are those of an
online coder.

What is gathered grows with the corpus: word counts of all training texts, and
context tables of 2^16 to 2^20 slots (a bound for the broadcast).
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.llm.common import folds, prepare, text_chars, texts, written
from packflow.llm.words import prefix, slices

FREQUENT = 1 << 16  # most words with a path of their own
FUNCTION = 64  # most frequent words that count as function words
NEAR = 256  # most frequent words that are a context by themselves
PAIRS = (2 * NEAR + 1) * (FUNCTION + 1)  # previous word and function word
BATCH = 2_500_000  # tokens of a map task that are reduced together
CHUNK = 1 << 14  # slots of a table that travel together
DEPTHS = 8
SHARPNESS = (0.75, 1.0, 1.3)  # factors of the mixed logit that a document chooses from as it is read
SLICE = 6 << 20  # bytes of text at once
STEP = 40_000  # symbols at once
LEARN = 4096  # decisions of a gradient step
PART = 8 * LEARN  # decisions at once: what they need stays in the processor's cache
WORDS = 20_000  # escaped words at once
_U4 = np.uint32
HALF = np.arange(1 << 16, dtype=np.uint16).view(np.float16).astype(np.float32)  # value of each half-precision pattern


class Code:
    """Huffman code: for each symbol its tree nodes and bits, flat."""

    def __init__(self, counts: list[int]):
        heap = [(max(1, c), k, k) for k, c in enumerate(counts)]
        heapq.heapify(heap)
        n = len(counts)
        parent, side = [0] * (2 * n), [0] * (2 * n)
        nxt = n
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], side[x], parent[y], side[y] = nxt, 0, nxt, 1
            heapq.heappush(heap, (a + b, nxt, nxt))
            nxt += 1
        root = nxt - 1
        nodes, bits, start = [], [], [0]
        for s in range(n):
            path, x = [], s
            while x != root:
                path.append((parent[x] - n, side[x]))
                x = parent[x]
            for node, bit in reversed(path):
                nodes.append(node)
                bits.append(bit)
            start.append(len(nodes))
        self.nodes, self.bits = np.array(nodes, _U4), np.array(bits, _U4)
        self.start = np.array(start, np.int64)
        self.length = np.diff(self.start)
        self.hashes = self.nodes * _U4(0x85EBCA6B)
        depth = np.arange(len(nodes)) - np.repeat(self.start[:-1], self.length)
        self.deep = np.minimum(depth, DEPTHS - 1).astype(np.int8)

    def expand(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decisions of a symbol sequence: symbol place, and place in the flat arrays."""
        per = self.length[sym]
        ends = np.cumsum(per)
        place = np.repeat(np.arange(len(sym)), per)
        at = np.arange(len(place)) + np.repeat(self.start[sym] - ends + per, per)
        return place, at

    def parts(self, sym: np.ndarray):
        """Ranges of symbols with about ``PART`` decisions each."""
        ends = np.cumsum(self.length[sym])
        a = 0
        while a < len(sym):
            b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PART, side="right"))
            b = max(a + 1, b)
            yield a, b
            a = b


def hashed(x: np.ndarray, seed: int) -> np.ndarray:
    h = (x.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(32)).astype(_U4)


def slots(context: np.ndarray, node_hash: np.ndarray, log2: int, bit: np.ndarray | None = None) -> np.ndarray:
    """Table slots of decisions, from the context of each and the hash of its
    node; with ``bit``, of a table that has a value for either outcome."""
    h = context + node_hash
    h *= _U4(0xC2B2AE35)
    h >>= _U4(32 - log2)
    if bit is not None:
        h <<= _U4(1)
        h |= bit
    return h.astype(np.int64)


class Mixer:
    """Bit predictors of one code, with mixed logits."""

    def __init__(self, code: Code, log2: int, logits: list[np.ndarray], gates: int):
        self.code, self.log2, self.logits = code, log2, logits
        self.weights = np.full((gates * DEPTHS, len(logits) + 1), 1.0 / max(1, len(logits)) + 0.15, np.float32)
        self.weights[:, -1] = 0

        self.alone: np.ndarray | None = None

    def inputs(self, place: np.ndarray, at: np.ndarray, contexts: list[np.ndarray], gate: np.ndarray,
               apart: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits, logits by context and weight rows of decisions (from
        ``Code.expand``). The first context is the same everywhere, so its logits
        are kept by place in the code. ``apart``: the logits are those of
        ``apart_logits``, decisions predicted without themselves."""
        code = self.code
        if self.alone is None:
            s = slots(contexts[0][:1], code.hashes, self.log2, code.bits if apart else None)
            self.alone = self.logits[0][s].astype(np.float32)
        bit, node = code.bits[at], code.hashes[at]
        x = np.empty((len(self.logits), len(at)), np.float32)
        x[0] = self.alone[at]
        for k in range(1, len(x)):
            s = slots(contexts[k][place], node, self.log2, bit if apart else None)
            # looked up: numpy's own conversion of half precision takes longer
            np.take(HALF, self.logits[k].view(np.uint16).take(s), out=x[k], mode="clip")
        return bit, x, (gate * DEPTHS)[place] + code.deep[at]

    def logit(self, x: np.ndarray, g: np.ndarray) -> np.ndarray:
        return mixed(np.ascontiguousarray(self.weights.T), x, g)

    def learn(self, x: np.ndarray, g: np.ndarray, bit: np.ndarray, times: np.ndarray, step: float = 0.02,
              batch: int = LEARN) -> None:
        """Online gradient steps over the decisions in order, each met ``times`` times."""
        weights = np.ascontiguousarray(self.weights.T)
        rows = weights.shape[1]
        for a in range(0, len(bit), batch):
            s = slice(a, a + batch)
            xs, gs, ts = x[:, s], g[s], times[s]
            z = mixed(weights, xs, gs)
            np.minimum(np.maximum(z, -30, out=z), 30, out=z)
            err = ts * (bit[s].astype(np.float32) - 1.0 / (1.0 + np.exp(-z)))
            n = np.maximum(1.0, np.bincount(gs, weights=ts, minlength=rows))
            n = np.sqrt(np.maximum(n, n * n / batch))  # a step no longer than that of a batch without repeats
            for k, v in enumerate(xs):
                weights[k] += (step * np.bincount(gs, weights=err * v, minlength=rows) / n).astype(np.float32)
            weights[-1] += (step / 4 * np.bincount(gs, weights=err, minlength=rows) / n).astype(np.float32)
        self.weights[:] = weights.T


def mixed(weights: np.ndarray, x: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Mixed logits: weights by input and weight row, the last input a constant."""
    out = weights[-1][g]
    for w, v in zip(weights, x):
        by = w[g]
        by *= v
        out += by
    return out


def softplus(z: np.ndarray) -> np.ndarray:
    """log(1 + e^z) in single precision."""
    z = np.minimum(np.maximum(z, -30), 60)
    np.exp(z, out=z)
    z += np.float32(1)
    return np.log(z, out=z)


def cost(logit: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Bits that decisions cost under their logits."""
    return softplus(np.where(bit == 1, -logit, logit)) * np.float32(1 / math.log(2))


def table_logits(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Logit of a slot's counts, drawn to 0 where there are few."""
    n = n0 + n1
    return (np.log((n1 + 0.4) / (n0 + 0.4)) * (n / (n + 0.6))).astype(np.float16)


# --- words ------------------------------------------------------------------

class Lexicon:
    """Frequent words with their counts; then the end and the escape."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, rare: int):
        self.ids = {w: k for k, w in enumerate(words)}
        self.words = pa.array(words, pa.large_binary())
        self.end, self.escape = len(words), len(words) + 1
        self.counts = np.array([*counts, ends, 0], np.int64)
        self.code = Code([*counts, ends, rare])
        # a word's number as previous word: its own, or a class of its last two bytes
        near = min(NEAR, len(words))
        self.near = np.array([*range(near), *(NEAR + tail(w[-1], w[-2:][0]) for w in words[near:]), NEAR, NEAR], np.int64)

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> "Tokens":
        return Tokens(self, data, offsets)


def tail(last, before):
    return (last * 31 + before) % NEAR


def lowered(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of texts, and word offsets per text."""
    col = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    split = pc.ascii_split_whitespace(pc.ascii_lower(col))
    words, per = split.flatten().cast(pa.large_binary()), split.offsets.to_numpy().astype(np.int64)
    full = np.diff(ends_of(words)) > 0
    if not full.all():  # next to a space at either end of a text
        words = words.filter(pa.array(full))
        per = np.concatenate([[0], np.cumsum(full)])[per]
    return words, per - per[0]


def ends_of(words: pa.Array) -> np.ndarray:
    """Byte offsets of a large binary array's values."""
    if len(words) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]


class Tokens:
    """Tokens of a batch of texts: lower-cased words, ids with an end after
    each text, token offsets, and the word contexts as small numbers."""

    def __init__(self, lex: Lexicon, data: np.ndarray, offsets: np.ndarray):
        self.words, per = lowered(data, offsets)
        found = pc.index_in(self.words, value_set=lex.words)
        ids = found.fill_null(lex.escape).to_numpy().astype(np.int64)
        self.at = per + np.arange(len(per))  # one end for each text before
        word_place = np.ones(int(self.at[-1]), bool)
        word_place[self.at[1:] - 1] = False
        self.ids = np.full(len(word_place), lex.end, np.int64)
        self.ids[word_place] = ids
        own = lex.near[self.ids]
        rare = np.flatnonzero(ids == lex.escape)
        if len(rare):
            off, raw = ends_of(self.words), np.frombuffer(self.words.buffers()[2], np.uint8)
            last = off[rare + 1] - 1
            own[self.ids == lex.escape] = NEAR + tail(raw[last].astype(np.int64), raw[np.maximum(last - 1, off[rare])])
        self.previous = np.empty_like(own)
        self.previous[1:] = own[:-1]
        self.previous[self.at[:-1]] = 2 * NEAR
        # the last function word before a token, in the same text
        seen = np.where(self.ids < min(FUNCTION, lex.end), np.arange(len(own)), -1)
        before = np.concatenate([[-1], np.maximum.accumulate(seen)[:-1]])
        first = np.repeat(self.at[:-1], np.diff(self.at))
        self.function = np.where(before >= first, self.ids[np.maximum(before, 0)], FUNCTION)

    def escaped(self, lex: Lexicon) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Offsets per text, words and their counts in it, of the distinct escaped words of each text."""
        at = np.flatnonzero(self.ids == lex.escape)
        doc = np.searchsorted(self.at, at, side="right") - 1
        words = self.words.take(pa.array(at - doc)).dictionary_encode()
        many = max(1, len(words.dictionary))
        key, tf = np.unique(doc * many + words.indices.to_numpy(), return_counts=True)
        edges = np.searchsorted(key, np.arange(len(self.at)) * many)
        return edges, words.dictionary.take(pa.array(key % many)), tf


def word_contexts(previous: np.ndarray, function: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed contexts of tokens, and their gates."""
    c = [hashed(np.zeros(len(previous), np.int64), 1), hashed(previous, 2 << 20), hashed(function, 3 << 20),
         hashed(previous * (FUNCTION + 1) + function, 4 << 20)]
    return c, (previous >= NEAR).astype(np.int64) + (function == FUNCTION)


WORD_TABLES, WORD_GATES = 4, 3


# --- bytes of new words -----------------------------------------------------

STOP = 0x20
BYTE_TABLES, BYTE_GATES = 6, 12


def spelling(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Bytes of words, each followed by a stop: symbols, contexts, gates, offsets."""
    data = b" ".join(words) + b" "
    sym = np.frombuffer(data, np.uint8).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(list(map(len, words))) + np.arange(1, len(words) + 1)])
    first = np.repeat(at[:-1], np.diff(at))
    place = np.arange(len(sym)) - first
    back = []
    for k in range(1, 5):
        b = np.zeros(len(sym), np.int64)
        b[k:] = sym[:-k]
        b[place < k] = 0
        back.append(b)
    c, q = prefix(sym.astype(np.uint64) + np.uint64(1), 0xD6E8FEB86659FD93)
    whole = (c[:-1] - c[first]) * q[first]
    two = back[0] << 8 | back[1]
    contexts = [hashed(np.zeros(len(sym), np.int64), 5), hashed(back[0], 6 << 40), hashed(two, 7 << 40),
                hashed(two << 8 | back[2], 8 << 40), hashed(two << 16 | back[2] << 8 | back[3], 9 << 40),
                hashed(whole, 10 << 40)]
    return sym, contexts, np.minimum(place, BYTE_GATES - 1), at


# --- gathering --------------------------------------------------------------

def gathered(batches, rows: int):
    """Batches brought together until they have ``rows`` rows, none empty."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.num_rows
        if size >= rows:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _word_counts(docs: DataFrame) -> DataFrame:
    """word, c over all texts; map tasks count before the shuffle."""
    def run(batches):
        seen: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

        for b in batches:
            for _, _, data, off in slices(b.column(1)):
                raw = data.tobytes()
                for a, e in zip(off.tolist(), off[1:].tolist()):
                    seen.update(raw[a:e].lower().split())
                if len(seen) > 600_000:
                    yield flush()
                    seen = Counter()
        yield flush()

    return docs.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _tables(rows: DataFrame, log2: int, count: int, counter) -> list[np.ndarray]:
    """Counts of the context tables: each map task counts into its own, chunks
    are added up by table and place. ``counter(batches, tables)`` adds a task's
    rows."""
    width = 2 << log2
    chunk = min(CHUNK, width)

    def run(batches):
        tables = [np.zeros(width, np.uint32) for _ in range(count)]
        counter(batches, tables)
        z = zstandard.ZstdCompressor(level=1)
        for k, t in enumerate(tables):
            for a in range(0, width, chunk):
                part = t[a: a + chunk]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([a // chunk], pa.int32()),
                         pa.array([z.compress(part.tobytes())], pa.binary())],
                        names=["table", "part", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.int64)
        z = zstandard.ZstdDecompressor()
        for x in t.column("counts").to_pylist():
            total += np.frombuffer(z.decompress(x), np.uint32)
        return pa.Table.from_arrays(
            [t.column("table")[:1], t.column("part")[:1], pa.array([zstandard.compress(total.astype(np.float32).tobytes(), 1)], pa.binary())],
            names=["table", "part", "counts"])

    schema = "table int, part int, counts binary"
    out = [np.zeros(width, np.float32) for _ in range(count)]
    for r in rows.mapInArrow(run, schema).groupBy("table", "part").applyInArrow(add, schema).collect():
        a = r["part"] * chunk
        out[r["table"]][a: a + chunk] = np.frombuffer(zstandard.decompress(r["counts"]), np.float32)
    return out


def _logits(tables: list[np.ndarray]) -> list[np.ndarray]:
    return [table_logits(t[0::2], t[1::2]) for t in tables]


def _count_into(tables: list[np.ndarray], code: Code, log2: int, sym: np.ndarray, contexts: list[np.ndarray]) -> None:
    place, at = code.expand(sym)
    # the first context is the same everywhere: decisions are added up by place in the code
    np.add.at(tables[0], slots(contexts[0][:1], code.hashes, log2, code.bits),
              np.bincount(at, minlength=len(code.bits)).astype(_U4))
    node, bit = code.hashes[at], code.bits[at]
    for t, c in zip(tables[1:], contexts[1:]):
        np.add.at(t, slots(c[place], node, log2, bit), _U4(1))


def apart_logits(tables: list[np.ndarray]) -> list[np.ndarray]:
    """Logits by slot and outcome, with that outcome counted once less: what a
    training decision is predicted by when it is left out of the counts."""
    out = []
    for t in tables:
        n0, n1 = t[0::2], t[1::2]
        both = np.empty(len(t), np.float16)
        both[0::2], both[1::2] = table_logits(np.maximum(n0 - 1, 0), n1), table_logits(n0, np.maximum(n1 - 1, 0))
        out.append(both)
    return out


def _pairs(rows: DataFrame, lex) -> DataFrame:
    """Distinct (token, previous word, function word) of all texts with their
    counts, a row for each ``BATCH`` tokens of a map task."""
    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        held = WordCounts(lex.value, 0, [])

        def taken():
            return pa.RecordBatch.from_arrays([pa.array([z.compress(x.tobytes())], pa.binary()) for x in held.take()], names=["key", "n"])

        for b in batches:
            for _, _, data, off in slices(b.column(1), SLICE):
                if held.hold(lex.value.tokens(data, off)):
                    yield taken()
        if held.size:
            yield taken()

    return rows.mapInArrow(run, "key binary, n binary")


def _read_pairs(batches):
    """Tokens, their contexts as numbers, and counts of every row of ``_pairs``."""
    z = zstandard.ZstdDecompressor()
    for b in batches:
        for k in range(b.num_rows):
            key = np.frombuffer(z.decompress(b.column(0)[k].as_py()), np.int64)
            yield *np.divmod(key, PAIRS), np.frombuffer(z.decompress(b.column(1)[k].as_py()), _U4)


def _count_pairs(lex: Lexicon, log2: int, tables: list[np.ndarray], ids: np.ndarray, both: np.ndarray, n: np.ndarray) -> None:
    """Adds the decisions of counted tokens to the word tables; equal (token,
    context) pairs are added up before their decisions are."""
    previous, function = np.divmod(both, FUNCTION + 1)
    code = lex.code
    for k, c in enumerate((np.zeros_like(both), previous, function, both)):
        key = ids * PAIRS + c
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, times = key[order], n[order]
        else:
            times = n
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, times = key[first], np.add.reduceat(times, first, dtype=_U4) if len(first) else times
        for a in range(0, len(key), STEP):
            syms, c1 = np.divmod(key[a: a + STEP], PAIRS)
            context = word_contexts(*(np.divmod(c1, FUNCTION + 1) if k == 3 else (c1, c1)))[0][k]
            for lo, hi in code.parts(syms):
                place, at = code.expand(syms[lo:hi])
                s = slots(context[lo:hi][place], code.hashes[at], log2, code.bits[at])
                np.add.at(tables[k], s, times[a + lo: a + hi][place])


class WordCounts:
    """Tokens of a map task: equal (token, context) ones are added up."""

    def __init__(self, lex: Lexicon, log2: int, tables: list[np.ndarray], most: int = BATCH):
        self.lex, self.log2, self.tables, self.most = lex, log2, tables, most
        self.held: list[np.ndarray] = []
        self.size = 0

    def hold(self, t: Tokens) -> bool:
        """Whether enough are held to be taken."""
        self.held.append(t.ids * PAIRS + t.previous * (FUNCTION + 1) + t.function)
        self.size += len(t.ids)
        return self.size >= self.most

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        key, n = np.unique(np.concatenate(self.held or [np.zeros(0, np.int64)]), return_counts=True)
        self.held.clear()
        self.size = 0
        return key, n.astype(_U4)

    def add(self, t: Tokens) -> None:
        if self.hold(t):
            self.flush()

    def flush(self) -> None:
        key, n = self.take()
        _count_pairs(self.lex, self.log2, self.tables, *np.divmod(key, PAIRS), n)


def _learned(rows: DataFrame, mixer: Mixer, tables: list[np.ndarray], decisions) -> np.ndarray:
    """Mixing weights learned from every row: each task takes its steps over its
    rows from the same start, then weights are averaged by the decisions that a
    task met under their gate. ``decisions(batches)`` yields symbols, contexts,
    gates and times."""
    gates = len(mixer.weights) // DEPTHS
    shared = rows.sparkSession.sparkContext.broadcast((mixer.code, mixer.log2, apart_logits(tables)))

    def run(batches):
        code, size, apart = shared.value
        own = Mixer(code, size, apart, gates)
        met = np.zeros(len(own.weights))
        for sym, contexts, gate, times in decisions(batches):
            places, ats = code.expand(sym)
            for a in range(0, len(ats), PART):
                place = places[a: a + PART]
                bit, x, g = own.inputs(place, ats[a: a + PART], contexts, gate, apart=True)
                t = times[place]
                own.learn(x, g, bit, t)
                met += np.bincount(g, weights=t, minlength=len(met))
        at = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array((own.weights[at] * met[at, None]).astype(np.float64).tolist(), pa.list_(pa.float64())),
             pa.array(met[at])], names=["gate", "w", "met"])

    got = rows.mapInArrow(run, "gate int, w array<double>, met double").select("gate", "met", F.posexplode("w").alias("k", "w"))
    out = mixer.weights.copy()
    for r in got.groupBy("gate", "k").agg(F.sum("w").alias("w"), F.sum("met").alias("met")).collect():  # gates x inputs
        out[r["gate"], r["k"]] = r["w"] / r["met"]
    shared.unpersist()
    return out


class Model:
    """All that scoring needs: broadcast, bounded by the table sizes."""

    def __init__(self, lexicon: Lexicon, words: Mixer, letters: Mixer, rare_tokens: int, rare_types: int,
                 tokens: int, types: int):
        self.lexicon, self.words, self.letters = lexicon, words, letters
        self.rare_tokens, self.rare_types, self.tokens, self.types = rare_tokens, rare_types, tokens, types

    def spell(self, words: list[bytes]) -> np.ndarray:
        """Bits of each word's bytes."""
        sym, contexts, gate, at = spelling(words)
        c = np.zeros(len(sym))
        for a, b in self.letters.code.parts(sym):
            place, ats = self.letters.code.expand(sym[a:b])
            bit, x, g = self.letters.inputs(place, ats, [k[a:b] for k in contexts], gate[a:b])
            c[a:b] = np.bincount(place, weights=cost(self.letters.logit(x, g), bit), minlength=b - a)
        return np.add.reduceat(c, at[:-1])

    def escaped(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Bits of escaped words: training count and spelling share the
        probability as known and new words did in training."""
        known, new = self.rare_tokens, self.rare_types + 1
        spelt = self.spell(words)
        p = counts / (known + new) + np.exp2(-np.minimum(spelt, 1000.0)) * new / (known + new)
        far = p <= 0
        return np.where(far, spelt + math.log2((known + new) / new), -np.log2(np.where(far, 1.0, p)))

    def token_bits(self, t: Tokens) -> np.ndarray:
        """Bits of every token under each sharpness (rows). They depend on the
        token and its contexts alone, so equal ones are computed once."""
        key, at = np.unique(t.ids * PAIRS + t.previous * (FUNCTION + 1) + t.function, return_inverse=True)
        out, code = np.empty((len(SHARPNESS), len(key)), np.float32), self.words.code
        for a in range(0, len(key), STEP):
            syms, pair = np.divmod(key[a: a + STEP], PAIRS)
            contexts, gate = word_contexts(*np.divmod(pair, FUNCTION + 1))
            for lo, hi in code.parts(syms):
                sym = syms[lo:hi]
                place, ats = code.expand(sym)
                bit, x, g = self.words.inputs(place, ats, [c[lo:hi] for c in contexts], gate[lo:hi])
                z = self.words.logit(x, g)
                z = np.where(bit == 1, -z, z)
                start = np.cumsum(code.length[sym]) - code.length[sym]
                for k, by in enumerate(SHARPNESS):
                    out[k, a + lo: a + hi] = np.add.reduceat(softplus(z * np.float32(by)), start)
        return out[:, at] / np.float32(math.log(2))

    def score(self, t: Tokens) -> np.ndarray:
        """Bits of each text without its escaped words' own."""
        each = self.token_bits(t)
        texts_n = len(t.at) - 1
        doc = np.repeat(np.arange(texts_n), np.diff(t.at))
        nth = np.arange(len(t.ids)) - t.at[:-1][doc]
        # segments of 8, 16, 32 ... tokens; a segment is coded with the weights of those before it
        segment = np.frexp(nth / 8.0 + 1.0)[1] - 1
        order = np.argsort(segment, kind="stable")
        cut = np.searchsorted(segment[order], np.arange(int(segment.max(initial=0)) + 2))
        spent = np.zeros((len(SHARPNESS), texts_n))  # bits so far, by sharpness
        bits = np.zeros(texts_n)
        for s in range(len(cut) - 1):
            k = order[cut[s]: cut[s + 1]]
            d = doc[k]
            weight = np.exp2(-(spent - spent.min(0)))
            weight = (weight + 1e-3) / (weight + 1e-3).sum(0)
            p = sum(weight[x, d] * np.exp2(-each[x, k].astype(np.float64)) for x in range(len(SHARPNESS)))
            bits += np.bincount(d, weights=-np.log2(np.maximum(p, 1e-300)), minlength=texts_n)
            for x in range(len(SHARPNESS)):
                spent[x] += np.bincount(d, weights=each[x, k], minlength=texts_n)
        return bits


def fit(train: DataFrame, log2: int) -> tuple[Model, DataFrame]:
    """Model and word counts of (doc_id, text) rows. Counts, codes and mixing
    weights come from every row; a decision that weights are learned from is
    predicted by the counts of all others."""
    spark = train.sparkSession
    counts = written(_word_counts(train), "words")
    ends = train.count()
    n = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    total, types = int(n["n"] or 0), int(n["v"])
    top = counts.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    held = sum(r["c"] for r in top)
    lex = Lexicon([bytes(r["word"]) for r in top], [r["c"] for r in top], ends, total - held)
    shared = spark.sparkContext.broadcast(lex)
    pairs = written(_pairs(train, shared), "pairs")

    def count_words(batches, tables):
        for ids, both, times in _read_pairs(batches):
            _count_pairs(shared.value, log2, tables, ids, both, times)

    def word_decisions(batches):
        for ids, both, times in _read_pairs(batches):
            order = np.random.default_rng(len(ids)).permutation(len(ids))
            for a in range(0, len(ids), STEP):
                k = order[a: a + STEP]
                yield ids[k], *word_contexts(*np.divmod(both[k], FUNCTION + 1)), times[k]

    word_tables = _tables(pairs, log2, WORD_TABLES, count_words)
    word_mixer = Mixer(lex.code, log2, _logits(word_tables), WORD_GATES)
    word_mixer.weights = _learned(pairs, word_mixer, word_tables, word_decisions)
    del word_tables

    # new words are spelled like the word types of the training texts
    words = counts.select("word")

    def count_bytes(batches):
        seen = np.zeros(256, np.int64)
        for b in batches:
            if b.num_rows:
                seen += np.bincount(np.frombuffer(b" ".join(b.column(0).to_pylist()) + b" ", np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256), pa.int32()), pa.array(seen)], names=["byte", "c"])

    byte_counts = np.ones(256, np.int64)
    for r in words.mapInArrow(count_bytes, "byte int, c long").groupBy("byte").agg(F.sum("c").alias("c")).collect():
        byte_counts[r["byte"]] += r["c"]
    letters = Code(byte_counts.tolist())

    def count_letters(batches, tables):
        for b in gathered(batches, 2000):
            sym, contexts, _, _ = spelling(b.column(0).to_pylist())
            _count_into(tables, letters, log2, sym, contexts)

    def letter_decisions(batches):
        for b in batches:
            for a in range(0, b.num_rows, 2000):
                sym, contexts, gate, _ = spelling(b.column(0).slice(a, 2000).to_pylist())
                yield sym, contexts, gate, np.ones(len(sym))

    byte_tables = _tables(words, log2, BYTE_TABLES, count_letters)
    byte_mixer = Mixer(letters, log2, _logits(byte_tables), BYTE_GATES)
    byte_mixer.weights = _learned(words, byte_mixer, byte_tables, letter_decisions)
    del byte_tables
    model = Model(lex, word_mixer, byte_mixer, total - held, types - len(top), total + ends, types + (ends > 0))
    return model, counts


PASS = ("row long, doc_id long, n_tokens long, n_bytes long, n_known long, base double, bits double, "
        "words array<binary>, tf array<long>")
PASS_NAMES = ["row", "doc_id", "n_tokens", "n_bytes", "n_known", "base", "bits", "words", "tf"]


def scores(docs: DataFrame, train: DataFrame, log2: int | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte
    of every whole text of ``docs``, learning from the rows of ``train``.

    Null texts count as empty (one end token); rows are independent, so ties
    and repeated rows change nothing; extra columns are ignored; without
    training rows every text is scored by untrained trees; an empty table gives
    an empty result."""
    spark = docs.sparkSession
    prepare(spark)
    every, train = texts(docs), texts(train)
    if log2 is None:
        log2 = int(np.clip(round(math.log2(max(1, text_chars(train)))) - 3, 16, 20))
    model, counts = fit(train, log2)
    shared = spark.sparkContext.broadcast(model)
    denominator = math.log10(max(1, model.tokens + model.types + 1))

    def run(batches):
        m = shared.value
        lex = m.lexicon
        row = TaskContext.get().partitionId() << 33
        log_count = np.log10(lex.counts + 1.0)
        for b in batches:
            for lo, hi, data, off in slices(b.column(1), SLICE):
                t = lex.tokens(data, off)
                bits, ids, at = m.score(t), t.ids, t.at
                n = hi - lo
                frequent = ids != lex.escape
                base = np.add.reduceat(np.where(frequent, log_count[ids], 0.0), at[:-1])
                known = np.add.reduceat((frequent & (lex.counts[ids] > 0)).astype(np.int64), at[:-1])
                per, rare, tf = t.escaped(lex)
                per = pa.array(per, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), b.column(0).slice(lo, n), pa.array(np.diff(at)), pa.array(np.diff(off)),
                     pa.array(known), pa.array(base), pa.array(bits),
                     pa.ListArray.from_arrays(per, rare.cast(pa.binary())),
                     pa.ListArray.from_arrays(per, pa.array(tf, pa.int64()))], names=PASS_NAMES)
                row += n

    def rare_bits(batches):
        m = shared.value
        for part in gathered(batches, WORDS):
            words = part.column(1).dictionary_encode()
            c = part.column(3).to_numpy(zero_copy_only=False)
            own = words.dictionary.to_pylist()
            at = words.indices.to_numpy(zero_copy_only=False)
            count = np.zeros(len(own))
            count[at] = c
            each = m.escaped(own, count)
            tf = part.column(2).to_numpy(zero_copy_only=False).astype(float)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(tf * np.log10(c + 1.0)), pa.array((tf * (c > 0)).astype(np.int64)),
                 pa.array(tf * each[at])], names=["row", "base", "n_known", "bits"])

    first = written(every.mapInArrow(run, PASS), "scores")
    rare = first.select("row", F.explode(F.arrays_zip("words", "tf")).alias("e")).select(
        "row", F.col("e.words").alias("word"), F.col("e.tf").alias("tf")).join(counts, "word", "left").select(
        "row", "word", "tf", F.coalesce("c", F.lit(0)).cast("double").alias("c"))
    added = (rare.mapInArrow(rare_bits, "row long, base double, n_known long, bits double")
             .groupBy("row").agg(F.sum("base").alias("base2"), F.sum("n_known").alias("known2"),
                                 F.sum("bits").alias("bits2")))
    zero = F.lit(0.0)
    out = first.join(added, "row", "left").withColumn(
        "all_bits", F.col("bits") + F.coalesce("bits2", zero))
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", zero) - F.col("n_tokens") * denominator).alias("base_score"),
        (-F.col("all_bits") * math.log10(2)).alias("score"),
        (F.col("all_bits") / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


def op2(docs: DataFrame) -> DataFrame:
    out = scores(docs, docs.where(folds("doc_id", 7) != 2))
    return out.select("doc_id", (folds("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score", "bits_per_byte")
