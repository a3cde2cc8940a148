"""Operator 3: removal of repeated word windows by super-k-mer partitioning.

A window is ``k`` consecutive words of one text. Its minimiser is the least
hashed m-mer of words inside it (leftmost if tied); consecutive windows with
the same minimiser place form a super-k-mer, one string of words. Equal windows
have equal minimisers, so all copies of a window meet in its minimiser's bucket.

1. Texts are written once as blocks. Each block sends its minimisers with
   their counts; only minimisers found at two places or more can hold a
   repeated window.
2. Super-k-mers of those minimisers travel as packed strings, each distinct one
   once for a block with its count. Minimisers at very many places would fill a
   bucket, so their windows travel one by one to the bucket of the window.
3. A bucket sorts windows by hash, compares the words of neighbours, and
   answers each block with a bit per window; the block marks the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.llm.common import buckets_for, prepare, text_chars, texts, tidy, tidy_groups, written
from packflow.llm.words import Words, mix, slices, span_hash, windows

K, M = 35, 4
BLOCK_BYTES = 4 << 20
BUCKET_CHARS = 12_000_000
HOT = 512  # places of a minimiser from which its windows travel one by one
_U = np.uint64

ROW = "block long, kind int, bucket int, counts binary, payload binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_text string"


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _rows(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return [pa.array([r[j] for r in rows], kinds[j]) for j in range(5)]


NAMES = ["block", "kind", "bucket", "counts", "payload"]


def _blocks(docs: DataFrame) -> DataFrame:
    """Whole texts in blocks: ids (null as a flag) and byte offsets in
    ``counts``, compressed bytes in ``payload``."""
    def run(batches):
        part, block, held, ids, sizes, parts = TaskContext.get().partitionId(), 0, 0, [], [], []

        def flush():
            i = np.array([x or 0 for x in ids], np.int64)
            null = np.array([x is None for x in ids], np.int64)
            counts = np.concatenate([i, null, np.concatenate(sizes)]).tobytes()
            return pa.RecordBatch.from_arrays(
                _rows([((part << 24) + block, 0, None, counts, _zip(b"".join(parts)))]), names=NAMES)

        for b in batches:
            keys = b.column(0).to_pylist()
            for lo, hi, data, off in slices(b.column(1)):
                ids += keys[lo:hi]
                sizes.append(np.diff(off))
                parts.append(data.tobytes())
                held += len(data) + 64 * (hi - lo)
                if held >= BLOCK_BYTES:
                    yield flush()
                    block, held, ids, sizes, parts = block + 1, 0, [], [], []
        if ids:
            yield flush()

    return docs.mapInArrow(tidy(run), ROW)


class Block:
    """Words, windows and super-k-mers of a block."""

    def __init__(self, counts: bytes, payload: bytes, k: int, m: int):
        c = np.frombuffer(counts, np.int64).reshape(3, -1)
        self.ids, self.null = c[0], c[1].astype(bool)
        self.data = _unzip(payload)
        self.words = w = Words(np.frombuffer(self.data, np.uint8), np.concatenate([[0], np.cumsum(c[2])]))
        self.k = k
        h = w.hashes(lower=False)
        g, first = windows(h, w.docs, m)
        # value of the m-mer at each word; the last words of a text have none
        value = np.full(len(h) + k, _U(2**64 - 1))
        value[first] = g
        place = np.arange(len(value))
        width, span = 1, k - m + 1
        while width < span:  # least value, leftmost, over doubling widths
            step = min(width, span - width)
            a, b = value[:-step], value[step:]
            right = b < a
            value, place = np.where(right, b, a), np.where(right, place[step:], place[:-step])
            width += step
        room = np.repeat(w.docs[1:], w.counts) - np.arange(len(h))
        self.first = np.flatnonzero(room >= k)  # first words of all windows
        self.mini, at = value[self.first], place[self.first]
        # a run: consecutive windows of one text with one minimiser place
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (self.first[1:] != self.first[:-1] + 1)
        self.run = np.flatnonzero(new)
        self.run_len = np.diff(np.append(self.run, len(at)))
        self.run_mini = self.mini[self.run]
        self.hashes = h

    def string(self, word: int, words: int) -> bytes:
        """``words`` words from ``word`` on, joined by one space."""
        w = self.words
        return b" ".join(self.data[w.starts[word]: w.ends[word + words - 1]].split())

    def strings(self, shared: np.ndarray, hot: np.ndarray, buckets: int) -> tuple[dict, list[tuple]]:
        """Packed strings by bucket, {bucket: {string: [number, count]}}, and
        where each comes from: (bucket, number, index of its first window,
        windows)."""
        out: dict[int, dict[bytes, list[int]]] = {}
        origin = []

        def send(bucket: int, text: bytes, window: int, n: int) -> None:
            mine = out.setdefault(bucket, {})
            entry = mine.setdefault(text, [len(mine), 0])
            entry[1] += 1
            origin.append((bucket, entry[0], window, n))

        def member(sorted_set: np.ndarray) -> np.ndarray:
            if not len(sorted_set):
                return np.zeros(len(self.run_mini), bool)
            p = np.minimum(np.searchsorted(sorted_set, self.run_mini), len(sorted_set) - 1)
            return sorted_set[p] == self.run_mini

        is_hot, is_shared = member(hot), member(shared)
        bucket = (mix(self.run_mini) % _U(buckets)).astype(np.int64)
        for r in np.flatnonzero(is_shared & ~is_hot).tolist():
            start, n = int(self.run[r]), int(self.run_len[r])
            send(int(bucket[r]), self.string(int(self.first[start]), n + self.k - 1), start, n)
        runs = np.flatnonzero(is_hot)
        if len(runs):
            own = np.repeat(self.run[runs], self.run_len[runs])
            each = own + np.arange(len(own)) - np.repeat(np.cumsum(self.run_len[runs]) - self.run_len[runs], self.run_len[runs])
            g = span_hash(self.hashes, self.first[each], self.first[each] + self.k)
            for window, b in zip(each.tolist(), (g % _U(buckets)).tolist()):
                send(b, self.string(int(self.first[window]), self.k), window, 1)
        return out, origin


def _block_of(rows: list[dict], k: int, m: int) -> Block:
    home = next(r for r in rows if r["kind"] == 0)
    return Block(home["counts"], home["payload"], k, m)


def _minimisers(blocks: DataFrame, buckets: int, k: int, m: int) -> DataFrame:
    """Minimisers of each block and at how many places, for each bucket."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                mini, n = np.unique(Block(r["counts"], r["payload"], k, m).run_mini, return_counts=True)
                b = (mix(mini) % _U(buckets)).astype(np.int64)
                order = np.argsort(b, kind="stable")
                mini, n, b = mini[order], n[order].astype(np.uint32), b[order]
                own, cut = np.unique(b, return_index=True)
                rows = [(r["block"], 1, int(x), n[a:e].tobytes(), mini[a:e].tobytes())
                        for x, a, e in zip(own, cut, np.append(cut[1:], len(b)))]
                yield pa.RecordBatch.from_arrays(_rows(rows), names=NAMES)

    return blocks.mapInArrow(tidy(run), ROW)


def _shared(minimisers: DataFrame, buckets: int) -> DataFrame:
    """For each block its minimisers found at two places or more; ``counts``
    flags those at HOT places or more."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [np.frombuffer(r["payload"], _U) for r in rows]
        n = np.concatenate([np.frombuffer(r["counts"], np.uint32) for r in rows]).astype(np.int64)
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=n).astype(np.int64)[at]
        out, pos = [], 0
        for r, key in zip(rows, keys):
            t = total[pos: pos + len(key)]
            pos += len(key)
            keep = t >= 2
            out.append((r["block"], 1, r["bucket"], (t[keep] >= HOT).tobytes(), key[keep].tobytes()))
        return pa.Table.from_arrays(_rows(out), names=NAMES)

    return minimisers.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(tidy_groups(run), ROW)


def _shared_sets(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    mine = [r for r in rows if r["kind"] == 1]
    if not mine:
        return np.zeros(0, _U), np.zeros(0, _U)
    key = np.concatenate([np.frombuffer(r["payload"], _U) for r in mine])
    hot = np.concatenate([np.frombuffer(r["counts"], bool) for r in mine])
    return np.sort(key), np.sort(key[hot])


def _strings(rows: DataFrame, parts: int, buckets: int, k: int, m: int) -> DataFrame:
    """Packed super-k-mers of every block for each bucket."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        by, _ = _block_of(rows, k, m).strings(*_shared_sets(rows), buckets)
        out = [(rows[0]["block"], 2, b, np.array([c for _, c in s.values()], np.uint32).tobytes(),
                _zip(b"\n".join(s))) for b, s in by.items()]
        return pa.Table.from_arrays(_rows(out), names=NAMES)

    return rows.repartition(parts, "block").groupBy("block").applyInArrow(tidy_groups(run), ROW)


def repeated_windows(lines: list[bytes], weights: np.ndarray, k: int) -> np.ndarray:
    """For all windows of all lines in order: whether the window's words occur
    twice or more, a line counting ``weight`` times."""
    data = b"\n".join(lines)
    sizes = np.array([len(x) + 1 for x in lines], np.int64)
    ends = np.cumsum(sizes)
    w = Words(np.frombuffer(data, np.uint8), np.minimum(np.concatenate([[0], ends]), len(data)))
    g, first = windows(w.hashes(lower=False), w.docs, k)
    line = np.searchsorted(w.docs, first, side="right") - 1
    order = np.argsort(g, kind="stable")
    s = g[order]
    lead = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    size = np.diff(np.append(lead, len(s)))
    total = np.add.reduceat(weights[line][order], lead) if len(s) else np.zeros(0, np.int64)
    out = np.zeros(len(g), bool)
    out[order] = np.repeat(total >= 2, size)
    # words decide: neighbours of equal hash are compared, a group of mixed words is counted anew
    lo, hi = w.starts[first], w.ends[first + k - 1] if len(first) else first
    for a, n in zip(lead[size > 1].tolist(), size[size > 1].tolist()):
        group = order[a: a + n].tolist()
        head = data[lo[group[0]]: hi[group[0]]]
        if any(data[lo[x]: hi[x]] != head for x in group[1:]):
            seen: dict[bytes, int] = {}
            for x in group:
                t = data[lo[x]: hi[x]]
                seen[t] = seen.get(t, 0) + int(weights[line[x]])
            for x in group:
                out[x] = seen[data[lo[x]: hi[x]]] >= 2
    return out


def _answers(strings: DataFrame, buckets: int, k: int) -> DataFrame:
    """A bit for each window of the packed strings of a block."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lines, weights, per = [], [], []
        for r in rows:
            own = _unzip(r["payload"]).split(b"\n")
            lines += own
            per.append(len(own))
            weights.append(np.frombuffer(r["counts"], np.uint32).astype(np.int64))
        flags = repeated_windows(lines, np.concatenate(weights), k)
        n = np.array([x.count(b" ") + 2 - k for x in lines], np.int64)  # windows of each line
        cut = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(per)])]
        out = [(r["block"], 2, r["bucket"], None, np.packbits(flags[a:b]).tobytes())
               for r, a, b in zip(rows, cut, cut[1:]) if flags[a:b].any()]
        return pa.Table.from_arrays(_rows(out), names=NAMES)

    return strings.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(tidy_groups(run), ROW)


def _finish(rows: DataFrame, parts: int, buckets: int, k: int, m: int) -> DataFrame:
    """Marks the words of repeated windows and returns the texts without them."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        block = _block_of(rows, k, m)
        w = block.words
        edge = np.zeros(len(w.starts) + k + 1, np.int64)
        answers = {r["bucket"]: np.unpackbits(np.frombuffer(r["payload"], np.uint8)) for r in rows if r["kind"] == 2}
        if answers:
            by, origin = block.strings(*_shared_sets(rows), buckets)
            at = {}
            for b, strings in by.items():
                if b in answers:
                    at[b] = np.concatenate([[0], np.cumsum([x.count(b" ") + 2 - k for x in strings])])
            for b, number, window, n in origin:
                if b in at:
                    a = at[b][number]
                    hit = np.flatnonzero(answers[b][a: a + n])
                    if len(hit):
                        first = block.first[window + hit]
                        np.add.at(edge, first, 1)
                        np.add.at(edge, first + k, -1)
        gone = np.cumsum(edge)[: len(w.starts)] > 0
        kept, removed = [], []
        for d in range(len(w.counts)):
            a, b = int(w.docs[d]), int(w.docs[d + 1])
            text = block.data[w.offsets[d]: w.offsets[d + 1]].split()
            drop = gone[a:b]
            n = int(drop.sum())
            removed.append(n)
            if n:
                text = [text[i] for i in np.flatnonzero(~drop).tolist()]
            kept.append(b" ".join(text))
        return pa.Table.from_arrays(
            [pa.array(block.ids, pa.int64(), mask=block.null), pa.array(w.counts, pa.int64()),
             pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text"])

    return rows.repartition(parts, "block").groupBy("block").applyInArrow(tidy_groups(run), RESULT)


def remove_repeats(docs: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    Windows are judged on the input. Null texts count as empty; texts with
    fewer than ``k`` words lose nothing; repeated rows repeat each other's
    windows; an empty table gives an empty result; extra columns are ignored."""
    prepare(docs.sparkSession)
    every = texts(docs)
    chars = text_chars(every)
    blocks = written(_blocks(every), "blocks", "none")
    buckets = buckets_for(chars, BUCKET_CHARS)
    parts = buckets_for(chars, 2 * BUCKET_CHARS)
    counted = written(_shared(_minimisers(blocks, parts, k, m), parts), "minimisers", "none")
    known = blocks.unionByName(counted)
    answers = _answers(_strings(known, parts, buckets, k, m), buckets, k)
    return _finish(known.unionByName(answers), parts, buckets, k, m)


def op3(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed",
                                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
