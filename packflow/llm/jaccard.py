"""Operator 9: n-gram Jaccard self join with signature trees.

1. Routing. Every document's shingle set (64-bit hashes; 48 bits and the bucket
   travel) is dealt out by hash in packed blocks. A bucket counts how many
   documents hold each shingle and answers the blocks with the shared ones. A
   document that shares less than the threshold with all others together has
   no link. The others' prefixes, rarest shingles first, must meet for any
   link, so documents that share a prefix shingle form coarse groups; no link
   leaves a group. Blocks send one entry for each shingle and bucket, however
   many documents hold it.
2. Signature trees. A group's documents become the leaves of a tree whose nodes
   hold OR-combined token bitmaps and size ranges. Dual traversal drops a pair
   of nodes when the sizes or the largest possible overlap rule out a link;
   every remaining pair is counted exactly. Equal sets are one class, which its
   first document stands for and which counts with its number of rows. Large
   groups are cut into chunks with a tree each, and every two chunks meet.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.llm.common import buckets_for, prepare, release_worker_state, text_chars, texts, tidy, tidy_groups, written
from packflow.llm.graph import Forest
from packflow.llm.graph import components as graph_components
from packflow.llm.words import Words, mix, slices, span_hash, windows

BLOCK_TOKENS = 400_000
BUCKET_CHARS = 10_000_000
KEY_CHARS = 200_000_000  # prefix entries are few: fewer buckets find fewer edges twice
CHUNK = 2048
FAN = 8
BITS = 4096
HOT = 16  # documents of a block that hold a shingle before the block sends it only once
_U = np.uint64

REQUEST = "bucket int, block long, size int, docs binary, counts binary, low binary, high binary, hot binary, hot_counts binary"
REPLY = ("block long, bucket int, docs binary, counts binary, tokens binary, class binary, hot binary, "
         "hot_class binary")
ROUTED = "kind int, doc_id long, n long, tokens binary, bucket int, keys binary, nodes binary, block long, cls long"
LINKS = "kind int, a long, b long"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and offsets. A
    text with fewer words is one shingle, without words none."""
    w = Words(data, offsets)
    h = w.hashes(lower=True)
    g, first = windows(h, w.docs, size)
    doc = np.searchsorted(w.docs, first, side="right") - 1
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        g = np.concatenate([g, span_hash(h, w.docs[short], w.docs[short + 1])])
        doc = np.concatenate([doc, short])
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[keep], doc[keep]
    return g, np.searchsorted(doc, np.arange(len(offsets)))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the top 16 bits, which the travelling 48 bits leave out."""
    return ((h >> _U(48)) * _U(buckets) >> _U(16)).astype(np.int64)


def owners(doc: np.ndarray, documents: int) -> bytes:
    """Ascending document numbers, as counts of every document or as steps from
    one to the next, whichever is shorter; single bytes where they fit."""
    if len(doc) < documents:
        kind, x = b"i", np.diff(doc, prepend=0)
    else:
        kind, x = b"c", np.bincount(doc, minlength=documents)
    if x.max(initial=0) < 256:
        return kind + x.astype(np.uint8).tobytes()
    return kind.upper() + x.astype(np.uint32).tobytes()


def owned(packed: bytes) -> np.ndarray:
    kind = packed[:1]
    x = np.frombuffer(packed, np.uint8 if kind.islower() else np.uint32, offset=1).astype(np.int64)
    return np.cumsum(x) if kind in b"iI" else np.repeat(np.arange(len(x)), x)


def low48(x: np.ndarray) -> bytes:
    """The low 48 bits of each value, six bytes each."""
    return np.ascontiguousarray(x.astype("<u8").view("<u2").reshape(-1, 4)[:, :3]).tobytes()


def from48(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 4), "<u2")
    out[:, :3] = np.frombuffer(packed, "<u2").reshape(-1, 3)
    return out.view("<u8").ravel().astype(_U)


def packed_set(tokens: np.ndarray) -> bytes:
    """Ascending tokens: 48 bits of each, then the steps of their top 16 bits."""
    steps = np.diff(tokens >> _U(48), prepend=_U(0))
    kind, width = (b"s", np.uint8) if steps.max(initial=0) < 256 else (b"S", "<u2")
    return kind + low48(tokens) + steps.astype(width).tobytes()


def unpacked_set(packed: bytes) -> np.ndarray:
    width = np.dtype(np.uint8 if packed[:1] == b"s" else "<u2")
    n = (len(packed) - 1) // (6 + width.itemsize)
    top = np.cumsum(np.frombuffer(packed, width, offset=1 + 6 * n), dtype=_U)
    return from48(packed[1: 1 + 6 * n]) | top << _U(48)


def class_id(packed: bytes) -> int:
    """64 bits that stand for a class of equal sets."""
    return int.from_bytes(hashlib.blake2b(packed, digest_size=8).digest(), "little", signed=True)


def _requests(docs: DataFrame, size: int, buckets: int) -> DataFrame:
    """Blocks of documents as packed shingles for each bucket."""
    def run(batches):
        release_worker_state()
        part, block = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        sets: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def flush():
            doc_ids, counts, g = np.concatenate(ids), np.concatenate(sizes), np.concatenate(sets)
            doc = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
            b = bucket_of(g, buckets)
            order = np.lexsort((g & _U(0xFFFFFFFFFFFF), b))  # by shingle within its bucket
            g, doc, b = g[order] & _U(0xFFFFFFFFFFFF) | b[order].astype(_U) << _U(48), doc[order], b[order]
            lead = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
            many = np.diff(np.append(lead, len(g)))
            hot, hot_counts = g[lead[many >= HOT]], many[many >= HOT].astype(np.uint32)
            is_hot = np.repeat(many >= HOT, many)
            # which documents hold the hot shingles stays with the block
            table = [doc_ids.tobytes() + counts.astype(np.int64).tobytes(),
                     doc[is_hot].astype(np.uint16 if len(counts) <= 1 << 16 else np.uint32).tobytes(),
                     hot_counts.tobytes(), hot.tobytes()]
            table = np.array([len(x) for x in table[:3]], np.int64).tobytes() + b"".join(table)
            g, doc, b = g[~is_hot], doc[~is_hot], b[~is_hot]
            order = np.lexsort((doc, b))
            g, doc, b = g[order], doc[order], b[order]
            cut = np.searchsorted(b, np.arange(buckets + 1))
            hot_cut = np.searchsorted(hot >> _U(48), np.arange(buckets + 1).astype(_U))
            home = (part + block) % buckets
            for k in np.union1d(np.append(np.unique(b), home), np.unique(hot >> _U(48)).astype(np.int64)).tolist():
                gs, ds = g[cut[k]: cut[k + 1]], doc[cut[k]: cut[k + 1]]
                hs = slice(hot_cut[k], hot_cut[k + 1])
                yield (k, (part << 24) + block, len(counts), table if k == home else None,
                       owners(ds, len(counts)),
                       (gs & _U(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                       (gs >> _U(32) & _U(0xFFFF)).astype(np.uint16).tobytes(),
                       (hot[hs] & _U(0xFFFFFFFFFFFF)).tobytes(), hot_counts[hs].tobytes())

        def batch_of(rows):
            rows = list(rows)
            kinds = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], kinds[j]) for j in range(9)],
                names=["bucket", "block", "size", "docs", "counts", "low", "high", "hot", "hot_counts"])

        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, data, off in slices(b.column(1), 1 << 19):
                g, at = shingle_sets(data, off, size)
                ids.append(keys[lo:hi])
                sets.append(g)
                sizes.append(np.diff(at))
                held += len(g)
                if held >= BLOCK_TOKENS:
                    yield batch_of(flush())
                    ids, sets, sizes, held, block = [], [], [], 0, block + 1
        if ids:
            yield batch_of(flush())

    return docs.mapInArrow(tidy(run), REQUEST)


def df_class(df: np.ndarray) -> np.ndarray:
    """Rarity class of a document count: its bit length."""
    return np.ceil(np.log2(np.maximum(df, 1) + 1)).astype(np.uint8)


def _answers(requests: DataFrame, buckets: int) -> DataFrame:
    """For every block, the shared shingles of a bucket and their rarity."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        counts = [owned(r["counts"]) for r in rows]
        keys = [np.frombuffer(r["low"], np.uint32).astype(_U) | np.frombuffer(r["high"], np.uint16).astype(_U) << _U(32)
                for r in rows]
        hot = [np.frombuffer(r["hot"], _U) for r in rows]
        weight = np.concatenate([np.ones(sum(map(len, keys)), np.int64)]
                                + [np.frombuffer(r["hot_counts"], np.uint32).astype(np.int64) for r in rows])
        flat = np.concatenate(keys + hot)
        order = np.argsort(flat)
        s = flat[order]
        edge = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
        group = np.cumsum(edge) - 1
        df = np.empty(len(flat), np.int64)
        df[order] = np.bincount(group, weights=weight[order]).astype(np.int64)[group] if len(s) else 0
        out, at, hot_at = [], 0, sum(map(len, keys))
        for r, c, k, h in zip(rows, counts, keys, hot):
            hot_df = df[hot_at: hot_at + len(h)]
            hot_at += len(h)
            d = df[at: at + len(k)]
            at += len(k)
            keep = d >= 2
            out.append((r["block"], r["bucket"], r["docs"], owners(c[keep], r["size"]), low48(k[keep]),
                        df_class(d[keep]).tobytes(), low48(h), df_class(hot_df).tobytes()))
        kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 6
        return pa.Table.from_arrays([pa.array([o[j] for o in out], kinds[j]) for j in range(8)],
                                    names=["block", "bucket", "docs", "counts", "tokens", "class", "hot", "hot_class"])

    return requests.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(tidy_groups(run), REPLY)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of which a linked partner must share one, in any fixed order."""
    return n - -(-percent * n // 100) + 1


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A forest with the components of the edges a - b, as rows (root, member)."""
    f = Forest()
    apart = a != b
    for x, y in set(zip(a[apart].tolist(), b[apart].tolist())):
        f.join(x, y)
    return np.array([(f.find(x), x) for x in f.parent if f.find(x) != x], np.int64).reshape(-1, 2)


def _routed(replies: DataFrame, blocks: int, buckets: int, percent: int) -> DataFrame:
    """kind 0: every document (candidates with their class; the first of a class
    in a block has bucket 0 and its shared shingles); kind 1: packed prefix entries; kind 2: coarse edges (a forest); kind 3: links of equal
    sets, found inside blocks."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        home = next(r for r in rows if r["docs"] is not None)
        cut = np.frombuffer(home["docs"][:24], np.int64).cumsum() + 24
        raw = np.frombuffer(home["docs"][24: cut[0]], np.int64)
        ids, n = raw[: len(raw) // 2], raw[len(raw) // 2:]
        hot_doc = np.frombuffer(home["docs"][cut[0]: cut[1]],
                                np.uint16 if len(ids) <= 1 << 16 else np.uint32).astype(np.int64)
        hot_tok = np.repeat(np.frombuffer(home["docs"][cut[2]:], _U),
                            np.frombuffer(home["docs"][cut[1]: cut[2]], np.uint32))
        whole = lambda r, column: from48(r[column]) | _U(r["bucket"]) << _U(48)
        doc = np.concatenate([owned(r["counts"]) for r in rows])
        tok = np.concatenate([whole(r, "tokens") for r in rows])
        rare = np.concatenate([np.frombuffer(r["class"], np.uint8) for r in rows])
        if len(hot_tok):
            h = np.concatenate([whole(r, "hot") for r in rows])
            c = np.concatenate([np.frombuffer(r["hot_class"], np.uint8) for r in rows])
            order = np.argsort(h)
            doc, tok = np.concatenate([doc, hot_doc]), np.concatenate([tok, hot_tok])
            rare = np.concatenate([rare, c[order][np.searchsorted(h[order], hot_tok)]])
        shared = np.bincount(doc, minlength=len(ids))
        left = prefix_length(n, percent) - (n - shared)  # prefix entries beyond the unshared shingles
        candidate = (n > 0) & (left > 0)
        keep = candidate[doc]
        doc, tok, rare = doc[keep], tok[keep], rare[keep]
        order = np.lexsort((tok, doc))
        by_set_doc, by_set = doc[order], tok[order]
        at = np.searchsorted(by_set_doc, np.arange(len(ids) + 1))
        tokens: list[bytes | None] = [None] * len(ids)
        first: dict[tuple, int] = {}
        links, alive = [], np.zeros(len(ids), bool)
        block, classes = home["block"], [None] * len(ids)
        for d in np.flatnonzero(candidate):
            t = packed_set(by_set[at[d]: at[d + 1]])
            # a set with shingles of its own equals no other
            classes[d] = class_id(b"=" + t if shared[d] == n[d] else b"%d %d" % (block, d))
            if shared[d] == n[d]:
                other = first.setdefault((int(n[d]), t), int(d))
                if other != d:
                    links.append((int(ids[other]), int(ids[d])))
                    continue
            tokens[d], alive[d] = t, True
        # prefixes of the remaining documents
        order = np.lexsort((tok, rare, doc))
        d, t = doc[order], tok[order]
        place = np.arange(len(d)) - np.searchsorted(d, d)
        use = alive[d] & (place < left[d])
        d, t = ids[d[use]], t[use]
        order = np.lexsort((d, t))
        d, t = d[order], t[order]
        lead = np.concatenate([[True], t[1:] != t[:-1]]) if len(t) else np.zeros(0, bool)
        least = d[lead][np.cumsum(lead) - 1] if len(t) else d
        pairs = spanning(least, d)
        t, d = t[lead], d[lead]
        b = (mix(t) % _U(buckets)).astype(np.int64)
        out = [(0, int(ids[k]), int(n[k]), tokens[k], 0 if alive[k] else None, None, None, block, classes[k])
               for k in range(len(ids))]
        out += [(1, None, None, None, int(k), t[b == k].tobytes(), d[b == k].tobytes(), None, None) for k in np.unique(b)]
        if len(pairs):
            out.append((2, None, None, None, None, pairs[:, 0].tobytes(), pairs[:, 1].tobytes(), None, None))
        if links:
            x = np.array(links, np.int64)
            out.append((3, None, None, None, None, x[:, 0].tobytes(), x[:, 1].tobytes(), None, None))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array([o[j] for o in out], kinds[j]) for j in range(9)],
                                    names=["kind", "doc_id", "n", "tokens", "bucket", "keys", "nodes", "block", "cls"])

    return replies.repartition(blocks, "block").groupBy("block").applyInArrow(tidy_groups(run), ROUTED)


def _pairs(rows: DataFrame) -> DataFrame:
    """Packed pairs as edges."""
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b.column(j)[k].as_py(), np.int64)) for j in (0, 1)], names=["a", "b"])

    return rows.select("keys", "nodes").mapInArrow(run, "a long, b long")


def _meetings(rows: DataFrame, buckets: int) -> DataFrame:
    """Edges from the smallest document of each prefix shingle to the others."""
    def run(table: pa.Table) -> pa.Table:
        t = np.concatenate([np.frombuffer(x, _U) for x in table.column("keys").to_pylist()])
        d = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("nodes").to_pylist()])
        order = np.lexsort((d, t))
        t, d = t[order], d[order]
        lead = np.concatenate([[True], t[1:] != t[:-1]])
        pairs = spanning(d[lead][np.cumsum(lead) - 1], d)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return rows.select("bucket", "keys", "nodes").repartition(buckets, "bucket").groupBy("bucket").applyInArrow(
        tidy_groups(run), "a long, b long")


class SignatureTree:
    """Documents under nodes with OR-combined token bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        least = np.array([s[0] if len(s) else 0 for s in sets], _U)
        self.order = np.lexsort((least, sizes))
        m = len(sets)
        flags = np.zeros((m, BITS), bool)
        lengths = np.array([len(sets[k]) for k in self.order])
        flat = np.concatenate([sets[k] for k in self.order]) if m else np.zeros(0, _U)
        flags[np.repeat(np.arange(m), lengths), (mix(flat) >> _U(64 - 12)).astype(np.int64)] = True
        bits = np.packbits(flags, axis=1).view(_U)
        n = sizes[self.order].astype(np.int64)
        # tokens beyond the first of each bit: an overlap may exceed the common bits by these
        more = lengths - flags.sum(1)
        self.levels = [(bits, n, n, more)]
        while len(n) > FAN:
            cut = np.arange(0, len(n), FAN)
            bits, more = np.bitwise_or.reduceat(bits, cut, axis=0), np.maximum.reduceat(more, cut)
            lo = np.minimum.reduceat(self.levels[-1][1], cut)
            hi = np.maximum.reduceat(self.levels[-1][2], cut)
            self.levels.append((bits, lo, hi, more))
            n = lo


def possible(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Overlap bound minus the overlap a link needs, for node pairs; below 0
    there is no link under them."""
    (bits_a, lo_a, hi_a, more_a), (bits_b, lo_b, hi_b, more_b) = a, b
    room = np.empty(len(i), np.int64)
    for s in range(0, len(i), 1 << 15):
        x, y = i[s: s + (1 << 15)], j[s: s + (1 << 15)]
        common = np.bitwise_count(bits_a[x] & bits_b[y]).sum(1, dtype=np.int64)
        most = np.minimum(common + np.minimum(more_a[x], more_b[y]), np.minimum(hi_a[x], hi_b[y]))
        need = -(-percent * (lo_a[x] + lo_b[y]) // (100 + percent))
        far = (100 * hi_a[x] < percent * lo_b[y]) | (100 * hi_b[y] < percent * lo_a[x])
        room[s: s + (1 << 15)] = np.where(far, -1, most - need)
    return room


def dual(a: SignatureTree, b: SignatureTree, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Document pairs that traversal of two trees cannot rule out, likeliest
    first (for one tree with itself each pair once)."""
    same = a is b
    depth = max(len(a.levels), len(b.levels)) - 1
    level = lambda t, k: t.levels[min(k, len(t.levels) - 1)]
    na, nb = len(level(a, depth)[1]), len(level(b, depth)[1])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(na), np.arange(nb), indexing="ij"))
    for k in range(depth, -1, -1):
        if same:
            ok = i < j if k == 0 else i <= j
            i, j = i[ok], j[ok]
        room = possible(level(a, k), level(b, k), i, j, percent)
        i, j, room = i[room >= 0], j[room >= 0], room[room >= 0]
        if k:
            def kids(t: SignatureTree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                if k > len(t.levels) - 1:  # the shorter tree waits
                    return x, np.ones(len(x), np.int64)
                return x * FAN, np.minimum(FAN, len(t.levels[k - 1][1]) - x * FAN)
            (i0, ni), (j0, nj) = kids(a, i), kids(b, j)
            per = ni * nj
            pair = np.repeat(np.arange(len(i)), per)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(per) - per, per)
            i, j = i0[pair] + nth // nj[pair], j0[pair] + nth % nj[pair]
    order = np.argsort(-room, kind="stable")
    return a.order[i[order]], b.order[j[order]]


def link_members(a: list[tuple], b: list[tuple] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all linked members (class, doc_id, weight, n, set) of one
    chunk, each pair once, or of two."""
    tree = lambda rows: SignatureTree([r[4] for r in rows], np.array([r[3] for r in rows]))
    ta = tree(a)
    tb, b = (ta, a) if b is None else (tree(b), b)
    i, j = dual(ta, tb, percent)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    sets = [r[4] for r in a] + ([r[4] for r in b] if b is not a else [])
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    codes = np.split(code, np.cumsum([len(x) for x in sets])[:-1])
    other = codes if b is a else codes[len(a):]
    length = np.array([len(x) for x in other])
    mark = np.zeros(int(code.max(initial=-1)) + 1, bool)
    both = np.zeros(len(i), np.int64)
    first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, np.int64)
    for lo, hi in zip(first.tolist(), np.append(first[1:], len(i)).tolist()):
        mine = codes[i[lo]]
        mark[mine] = True
        for s in range(lo, hi, 256):
            to = j[s: min(s + 256, hi)]
            hits = np.concatenate([[0], np.cumsum(mark[np.concatenate([other[k] for k in to])])])
            both[s: s + len(to)] = np.diff(hits[np.concatenate([[0], np.cumsum(length[to])])])
        mark[mine] = False
    na, nb = np.array([r[3] for r in a])[i], np.array([r[3] for r in b])[j]
    ok = 100 * both >= percent * (na + nb - both)
    return i[ok], j[ok]


def _links(a: list[tuple], b: list[tuple] | None, percent: int, every: bool) -> list[np.ndarray]:
    """Rows of LINKS. kind 0: a forest of the linked documents; kind 1: a class
    and the number of rows it is linked with; with ``every`` also kind 2: the
    documents that stand for two linked classes."""
    i, j = link_members(a, b, percent)
    b = a if b is None else b
    column = lambda rows, k: np.array([r[k] for r in rows], np.int64)
    ia, jb = column(a, 1)[i], column(b, 1)[j]
    row = lambda kind, x, y: np.stack([np.full(len(x), kind, np.int64), x, y], 1)
    forest = spanning(ia, jb)
    out = [row(0, forest[:, 0], forest[:, 1])]
    for rows, at, to in ((a, i, column(b, 2)[j]), (b, j, column(a, 2)[i])):
        n = np.zeros(len(rows), np.int64)
        np.add.at(n, at, to)
        out.append(row(1, column(rows, 0)[n > 0], n[n > 0]))
    return out + [row(2, ia, jb)] * every


def _link_table(found: list[np.ndarray]) -> pa.Table:
    x = np.concatenate([np.zeros((0, 3), np.int64), *found])
    return pa.Table.from_arrays([pa.array(x[:, 0], pa.int32()), pa.array(x[:, 1]), pa.array(x[:, 2])],
                                names=["kind", "a", "b"])


def _member(r: dict) -> tuple:
    return r["cls"], r["doc_id"], r["weight"], r["n"], unpacked_set(r["tokens"])


def _inside(members: DataFrame, tasks: int, percent: int, every: bool) -> DataFrame:
    """Links inside each (group, chunk)."""
    def run(table: pa.Table) -> pa.Table:
        groups: dict[tuple, list[tuple]] = {}
        for r in table.to_pylist():
            groups.setdefault((r["root"], r["chunk"]), []).append(_member(r))
        return _link_table([x for rows in groups.values() if len(rows) > 1 for x in _links(rows, None, percent, every)])

    return (members.withColumn("task", F.pmod(F.xxhash64("root", "chunk"), F.lit(tasks)).cast("int"))
            .repartition(tasks, "task").groupBy("task").applyInArrow(tidy_groups(run), LINKS))


def _across(members: DataFrame, percent: int, every: bool) -> DataFrame:
    """Links between every two chunks of large groups."""
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                sides = [[_member(m) for m in r[s]] for s in ("left", "right")]
                yield from _link_table(_links(*sides, percent, every)).to_batches()

    chunks = written(members.groupBy("root", "chunk").agg(
        F.collect_list(F.struct("cls", "doc_id", "weight", "n", "tokens")).alias("rows")), "chunks", "none")  # about CHUNK rows
    left = chunks.select("root", F.col("chunk").alias("i"), F.col("rows").alias("left"))
    right = chunks.select("root", F.col("chunk").alias("j"), F.col("rows").alias("right"))
    pairs = left.select("root", "i").join(right.select("root", "j"), "root").where("i < j")
    return (pairs.join(left, ["root", "i"]).join(right, ["root", "j"]).select("left", "right")
            .mapInArrow(tidy(run), LINKS))


def _joined(every: DataFrame, size: int, percent: int, all_pairs: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Routed rows, classes (cls, weight, rep), links of equal sets, LINKS of all others."""
    named = every.where(F.col("doc_id").isNotNull())
    chars = text_chars(every)
    buckets = min(1 << 16, buckets_for(chars, BUCKET_CHARS))
    keys = min(1 << 16, buckets_for(chars, KEY_CHARS, 4))
    replies = _answers(_requests(named, size, buckets), buckets)
    routed = _routed(replies, buckets, keys, percent)
    path = written(routed, "routed", "none")
    classes = written(path.where("kind = 0 and cls is not null").groupBy("cls").agg(
        F.count("*").alias("weight"),
        F.min(F.when(F.col("bucket") == 0, F.struct("doc_id", "block"))).alias("rep")), "classes")
    firsts = written(path.where("kind = 0 and bucket = 0").select("cls", "doc_id", "block").join(classes, "cls"), "firsts")
    equal = _pairs(path.where("kind = 3")).unionByName(
        firsts.where("doc_id <> rep.doc_id").select(F.col("rep.doc_id").alias("a"), F.col("doc_id").alias("b")))
    coarse = _meetings(path.where("kind = 1"), keys).unionByName(_pairs(path.where("kind = 2")))
    # written first: a task then needs one Python worker, not one for each of two steps
    groups = graph_components(written(coarse, "coarse"))
    reps = written(firsts.where("doc_id = rep.doc_id and block = rep.block").select("cls", "doc_id", "block", "weight")
                   .join(groups, F.col("doc_id") == F.col("node")).drop("node"), "reps")
    sizes = reps.groupBy("root").agg(F.count("*").alias("size")).where("size > 1")
    chunk = F.when(F.col("size") > CHUNK, F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / CHUNK))).otherwise(0)
    placed = reps.join(sizes, "root").withColumn("chunk", chunk.cast("int"))
    # the sets themselves are shuffled once here, and once to their chunks
    members = written(path.where("kind = 0 and bucket = 0").select("cls", "block", "n", "tokens")
                      .join(placed, ["cls", "block"]), "members", "none")
    found = written(_inside(members, buckets, percent, all_pairs), "links")
    large = members.where(F.col("size") > CHUNK)
    if large.limit(1).count():
        found = found.unionByName(written(_across(large, percent, all_pairs), "links"))
    return path, classes, equal, found


def pairs(docs: DataFrame, size: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """All links: pairs (a, b) of documents that stand for two linked classes
    of equal sets, and membership (doc_id, class_doc_id) of every row that
    could have a link. Documents of one class are linked with each other."""
    prepare(docs.sparkSession)
    path, classes, _, found = _joined(texts(docs), size, percent, True)
    members = path.where("kind = 0 and cls is not null").select("cls", "doc_id").join(classes, "cls").select(
        "doc_id", F.col("rep.doc_id").alias("class_doc_id"))
    return found.where("kind = 2").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), members


def components(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (other rows it is linked with)
    of every row.

    Null and wordless texts have no shingles and link with nothing; texts with
    fewer than ``size`` words are one shingle; rows with one id are one node
    (each row keeps its own counts); rows without an id stand alone with a null
    component; an empty table gives an empty result; extra columns are
    ignored."""
    prepare(docs.sparkSession)
    every = texts(docs)
    path, classes, equal, found = _joined(every, size, percent, False)
    roots = graph_components(equal.unionByName(found.where("kind = 0").select("a", "b")))
    others = found.where("kind = 1").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("others"))
    n_links = classes.join(others, "cls", "left").select(
        F.col("cls").alias("key"), (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    # rows without a class are spread, not gathered under null
    rows = (path.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "cls")
            .join(roots, F.col("doc_id") == F.col("node"), "left")
            .withColumn("key", F.coalesce("cls", F.xxhash64("doc_id", "n_shingles"))))
    out = rows.join(n_links, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"),
        F.when(F.col("cls").isNull(), 0).otherwise(F.col("n_links")).cast("long").alias("n_links"))
    return out.unionByName(_nameless(every.where(F.col("doc_id").isNull()), size).withColumn("n_links", F.lit(0).cast("long")))


def _nameless(rows: DataFrame, size: int) -> DataFrame:
    """Shingle counts of rows without an id."""
    def run(batches):
        for b in batches:
            for lo, hi, data, off in slices(b.column(1)):
                _, at = shingle_sets(data, off, size)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(np.diff(at), pa.int64()),
                     pa.nulls(hi - lo, pa.int64())], names=["doc_id", "n_shingles", "component_id"])

    return rows.mapInArrow(run, "doc_id long, n_shingles long, component_id long")


def op9(docs: DataFrame) -> DataFrame:
    return components(docs)
