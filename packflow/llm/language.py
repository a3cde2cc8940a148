"""Operator 6: language identification by cross-parsing entropy.

Labelled texts of each language (a bounded sample) become a suffix automaton,
which accepts exactly the substrings of that sample. A text is parsed greedily
into longest matches against each language; the language that needs the fewest
phrases, normalised by what a phrase costs (log2 of the sample size), wins.

The parse advances many text segments at once: a segment is 512 symbols, each
segment starts a new phrase, and every segment of every text is parsed, so
whole texts count and a very long text is only many segments.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packflow.llm.common import folds, prepare, tidy, worker_state

SEGMENT = 512
DENSE = 1 << 22  # most entries of a transition table with a place for every state and symbol


def fit_sample(docs: DataFrame, sample_docs: int = 64, sample_chars: int = 30_000,
               folds_k: int = 5) -> dict[str, str]:
    """Labelled sample per language: at most ``sample_docs`` whole texts (those
    of 200 to 4,000 characters first, then in hash order of id and text) until
    ``sample_chars`` characters; texts over four times that come last and are
    cut to ``sample_chars`` from their first letter on. Rows of fold 0 never
    take part. Every label is learned; a sample is bounded, so all may go to
    the driver."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (folds("doc_id", folds_k) != 0) & F.col("text").rlike(r"\p{L}"))
    size = F.length("text")
    kind = F.when(size.between(200, 4000), 0).when(size <= 4 * sample_chars, 1).otherwise(2)
    cut = F.regexp_extract("text", r"(?s)\p{L}.{0,%d}" % (sample_chars - 1), 0)
    rows = rows.withColumn("kind", kind).withColumn("text", F.when(F.col("kind") == 2, cut).otherwise(F.col("text")))
    w = Window.partitionBy("lang").orderBy("kind", F.xxhash64("doc_id", "text"), "text")
    best = rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= sample_docs)
    by: dict[str, list[str]] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["n"])):
        took = by.setdefault(r["lang"], [])
        if not took or sum(map(len, took)) + len(r["text"]) <= sample_chars:
            took.append(r["text"])
    return {lang: "\n".join(t) for lang, t in sorted(by.items())}


def symbol_table(samples: dict[str, str]) -> np.ndarray:
    """Code point -> symbol: every letter of the samples gets its own, other
    letters the last one, which no sample holds, everything else is a gap (0)."""
    seen = Counter(c for t in samples.values() for c in t.lower() if c.isalpha())
    own = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))]
    table = np.zeros(0x110000, np.uint8 if len(own) < 255 else np.uint32)
    table[[i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]] = len(own) + 1
    for k, c in enumerate(own):
        table[ord(c)] = k + 1
    return table


def symbols_of(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts (lower case, runs of gaps as one) and offsets."""
    low = [t.lower() for t in texts]
    ends = np.cumsum([0] + [len(t) for t in low])
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = table[points]
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
    keep[ends[:-1][ends[:-1] < len(sym)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return sym[keep], at[ends]


class Automaton:
    """Transitions (0: none) from state and symbol; the start state is 1. Small
    alphabets have a place for every state and symbol, large ones only sorted
    (state, symbol) keys."""

    def __init__(self, step: list[dict[int, int]], dense: bool):
        own = sorted({c for d in step for c in d})
        # symbols of this sample as 0, 1, ...; all others share the number after them
        self.width = len(own) + 1
        self.local = np.full(max(own, default=0) + 2, len(own), np.int64)
        self.local[own] = np.arange(len(own))
        state = np.repeat(np.arange(len(step)), [len(d) for d in step])
        symbol = self.local[np.array([c for d in step for c in d], np.int64)]
        to = np.array([x for d in step for x in d.values()], np.uint16 if len(step) < 1 << 16 else np.uint32)
        key = state * self.width + symbol
        self.table = None
        if dense and len(step) * self.width <= DENSE:
            self.table = np.zeros(len(step) * self.width, to.dtype)
            self.table[key] = to
        else:
            order = np.argsort(key)
            self.key, self.to = np.append(key[order], len(step) * self.width), np.append(to[order], 0)

    def symbols(self, sym: np.ndarray) -> np.ndarray:
        return self.local[np.minimum(sym, len(self.local) - 1)]

    def next(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = state * self.width + symbol
        if self.table is not None:
            return self.table.take(key).astype(np.int64)
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.to[at], 0).astype(np.int64)


def suffix_automaton(sample: np.ndarray, dense: bool = True) -> Automaton:
    """Suffix automaton of a sample."""
    step: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in sample.tolist():
        cur = len(step)
        step.append({})
        link.append(1)
        length.append(length[last] + 1)
        p = last
        while p and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return Automaton(step, dense)


def phrase_counts(sym: np.ndarray, offsets: np.ndarray, automata: list[Automaton]) -> np.ndarray:
    """Phrases per text (rows) and automaton (columns)."""
    sizes = np.diff(offsets)
    per = -(-sizes // SEGMENT)
    text_of = np.repeat(np.arange(len(sizes)), per)
    first = np.concatenate([[0], np.cumsum(per)])[:-1]
    nth = np.arange(len(text_of)) - np.repeat(first, per)
    lo = offsets[:-1][text_of] + nth * SEGMENT
    length = np.minimum(SEGMENT, offsets[1:][text_of] - lo)
    order = np.argsort(-length, kind="stable")
    lo, length, text_of = lo[order], length[order], text_of[order]
    out = np.zeros((len(sizes), len(automata)), np.int64)
    if not len(lo):
        return out
    active = np.searchsorted(-length, -np.arange(1, SEGMENT + 1), side="right")
    root = [a.next(np.ones(a.width, np.int64), np.arange(a.width)) for a in automata]
    state = [np.ones(len(lo), np.int64) for _ in automata]
    count = [np.ones(len(lo), np.int64) for _ in automata]
    for t in range(int(length[0])):
        n = active[t]
        here = sym[lo[:n] + t]
        for k, a in enumerate(automata):
            c = a.symbols(here)
            to = a.next(state[k][:n], c)
            miss = np.flatnonzero(to == 0)
            if len(miss):
                again = root[k][c[miss]]
                # an unknown symbol is a phrase of its own: if another follows, it starts a phrase
                count[k][miss] += (state[k][miss] != 1).astype(np.int64) + ((again == 0) & (length[miss] > t + 1))
                to[miss] = np.maximum(again, 1)
            state[k][:n] = to
    for k in range(len(automata)):
        out[:, k] = np.bincount(text_of, weights=count[k], minlength=len(sizes))
    return out


def _model(samples: dict[str, str]) -> tuple:
    """Tables of a worker process, built once for each set of samples."""
    key = hash(tuple(samples.items()))

    def build() -> tuple:
        table = symbol_table(samples)
        automata, cost = [], []
        for text in samples.values():
            sym, _ = symbols_of([text], table)
            automata.append(suffix_automaton(sym, len(samples) <= 64))
            cost.append(np.log2(max(2, len(sym))))
        return table, automata, np.array(cost)

    return worker_state(("language", key), build)


LETTER = regex.compile(r"\p{L}")


def predict_texts(texts: list[str | None], samples: dict[str, str]) -> list[tuple[str, float, str]]:
    """(language, score, phrases per language) of each text. The score is the
    runner-up's share of the two best costs, 0.5 (a tie) to 1; ties go to the
    first language by name."""
    names = list(samples)
    empty = [t is None or not LETTER.search(t) for t in texts]
    if not names:
        return [("und", 0.0, "")] * len(texts)
    table, automata, cost = _model(samples)
    sym, offsets = symbols_of([t or "" for t in texts], table)
    counts = phrase_counts(sym, offsets, automata)
    weighed = counts * cost
    out = []
    for k in range(len(texts)):
        if empty[k]:
            out.append(("und", 0.0, ""))
            continue
        best = int(np.argmin(weighed[k]))
        rest = np.delete(weighed[k], best)
        second = float(rest.min()) if len(rest) else float("inf")
        score = 1.0 if second == float("inf") else second / (second + float(weighed[k][best]))
        out.append((names[best], score, ",".join(f"{n}:{c}" for n, c in zip(names, counts[k]))))
    return out


def identify(docs: DataFrame, samples: dict[str, str], keep: tuple[str, ...] = (),
             slice_chars: int = 700_000) -> DataFrame:
    """Language of every text: doc_id, the columns ``keep``, lang_pred, score, phrases.

    Null texts and texts without a letter get ``und`` and 0; rows are
    independent, so ties, repeated rows and extra columns change nothing; an
    empty table gives an empty result; without any labelled row all are
    ``und``."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(samples)  # bounded for each label
    extra = [c for c in keep if c != "doc_id"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"), *extra)
    out = T.StructType([f for f in rows.schema if f.name != "_text"]).add("lang_pred", "string").add(
        "score", "double").add("phrases", "string")

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= slice_chars):
                    size += len(texts[end] or "")
                    end += 1
                got = predict_texts(texts[at:end], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(at, end - at) for k, c in enumerate(b.columns) if k != 1]
                    + [pa.array([g[0] for g in got], pa.string()),
                       pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.string())],
                    names=["doc_id", *extra, "lang_pred", "score", "phrases"])
                at = end

    return rows.mapInArrow(tidy(run), out)


def op6(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    out = identify(docs, fit_sample(docs))
    return out.select("doc_id", (folds("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "phrases")
