"""Operator 1: token ids as bit-packed blocks.

Ids are stored in the fewest bits the vocabulary needs. The file format is a
Parquet table of blocks: (shard, block, first, n_ids, bits, doc_ids, counts,
payload). A block holds whole documents, at least ``BLOCK_IDS`` ids except the
last of a shard; ``payload`` packs its ids least significant bit first, eight
ids to every ``bits`` bytes, so numpy unpacks a block lane by lane and any id
is found from its block's ``first`` and a bit offset. Shards follow each other
in ascending doc_id order. Spark writes the table: commits are atomic, lost
executors are retried, any file system will do.
"""

from __future__ import annotations

import array
import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packflow.llm.common import prepare, texts
from packflow.session import shared_path

BLOCK_IDS = 1 << 17
MEMORY = 700_000  # chunks of a generation that a worker remembers

BLOCKS = ("shard int, block int, first long, n_ids long, bits int, doc_ids array<long>, "
          "counts array<long>, payload binary")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, least significant first."""
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.ravel()[: len(ids)] = ids
    out = np.zeros((len(groups), bits), np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        v = groups[:, lane] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, byte + k] |= (v >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(payload: bytes, bits: int, lo: int, hi: int) -> np.ndarray:
    """Ids lo to hi (exclusive) of a block, without reading the rest of it."""
    start = lo // 8
    raw = np.frombuffer(payload, np.uint8, offset=min(len(payload), start * bits))
    groups = -(-hi // 8) - start
    need = groups * bits
    raw = raw[:need]
    if len(raw) < need:
        raw = np.concatenate([raw, np.zeros(need - len(raw), np.uint8)])
    raw = raw.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        v = np.zeros(groups, np.uint64)
        for k in range((shift + bits + 7) // 8):
            v |= raw[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (v >> np.uint64(shift)) & mask
    return out.ravel()[lo - 8 * start: hi - 8 * start]


SPACE = "\u0120"  # how the byte-level vocabulary writes a space
#: a run of these at a chunk's end is a piece of its own after a letter or digit
MARKS = ".,;:!?"
MIXED = re.compile(r"\s | \s").search
RARE_GAP = re.compile(r"[^\S \n]").search
#: found in every text with mixed gaps (for Arrow, whose \s knows ASCII only)
GAPS = (r"  | \n|\n |[\t\x{b}-\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
        r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def mixed_gaps(text: str) -> bool:
    """Whether a space stands beside other white space: pieces then cross the
    cuts at spaces."""
    if "  " in text or " \n" in text or "\n " in text:
        return True
    return RARE_GAP(text) is not None and MIXED(text) is not None


class ChunkEncoder:
    """The tokenizers library's ids of a text, from remembered chunks.

    The byte-level pattern starts a new piece at every single space, so a text
    without mixed white space is encoded chunk by chunk (a space and what
    follows it); chunks repeat. New chunks go to the library many at a time as
    one text, whose ids are cut where a token starts with a space. Any other
    text goes to the library whole. Two generations of chunks are remembered."""

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(str(public_tokenizers.path(name)))
        self.library.no_truncation()
        self.library.no_padding()
        # chunks are remembered here: the library's own memory of words costs time only
        self.library.model._resize_cache(0)
        # the same model and vocabulary for words of ASCII letters, each a piece of its own
        # with the space before it: split at the space's letter instead of by the pattern
        self.letters = Tokenizer.from_str(self.library.to_str())
        self.letters.pre_tokenizer = Split(SPACE, "merged_with_next")
        self.letters.model._resize_cache(0)
        size = self.library.get_vocab_size(with_added_tokens=True)
        special = self.library.get_added_tokens_decoder()
        self.starts_with_space = np.array([i not in special and (self.library.id_to_token(i) or "").startswith(SPACE)
                                           for i in range(size)])
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def ids(self, texts: list[str], library=None) -> list[bytes]:
        """Ids of texts as little-endian 32-bit integers, by the library."""
        found = (library or self.library).encode_batch_fast(texts, add_special_tokens=False)
        return [array.array("I", e.ids).tobytes() for e in found]

    def learn(self, chunks: list[str], group: int = 1000) -> None:
        letters, whole, alone = [], [], []
        for c in chunks:
            (letters if c.isalpha() and c.isascii() else whole if c and not c[-1].isspace() else alone).append(c)
        self.cut(letters, lambda part: self.ids([SPACE + SPACE.join(part)], self.letters)[0], alone, group)
        self.cut(whole, lambda part: self.ids([" " + " ".join(part)])[0], alone, group)
        self.memory.update(zip(alone, self.ids([" " + c for c in alone])))

    def cut(self, chunks: list[str], encode, alone: list[str], group: int) -> None:
        """Learn chunks from the ids of many together, cut where a token starts
        with a space; groups that do not cut into their chunks join ``alone``."""
        for a in range(0, len(chunks), group):
            part = chunks[a: a + group]
            raw = encode(part)
            cut = np.flatnonzero(self.starts_with_space[np.frombuffer(raw, np.uint32)])
            if len(cut) == len(part):
                edges = [*(4 * cut).tolist(), len(raw)]
                self.memory.update(zip(part, [raw[x:y] for x, y in zip(edges, edges[1:])]))
            else:
                alone += part

    def learn_all(self, chunks: set[str]) -> None:
        """Learn chunks; one that ends in marks is its stem's ids and the marks'."""
        marked, stems = [], set()
        for c in chunks:
            stem = c.rstrip(MARKS)
            if stem != c and stem and stem[-1] < "\u0530" and stem[-1].isalnum():
                marked.append((c, stem, c[len(stem):]))
                stems.add(stem)
        stems -= chunks
        known = stems & self.older.keys()
        self.memory.update((c, self.older[c]) for c in known)
        # "set - dict.keys()" would walk through the whole memory
        self.learn([c for c in (chunks | stems) - {c for c, _, _ in marked} if c not in self.memory])
        tails = [t for t in {t for _, _, t in marked} if t not in self.tails]
        self.tails.update(zip(tails, self.ids(tails)))
        self.memory.update((c, self.memory[stem] + self.tails[t]) for c, stem, t in marked)

    def encode_all(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids as little-endian 32-bit integers, for each text. Arrow splits the
        texts, tells equal chunks and puts their ids together; only distinct
        chunks are looked up."""
        if len(self.memory) > MEMORY:
            self.older, self.memory = self.memory, {}
        col = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        plain = np.ones(len(col), bool)
        for i in np.flatnonzero(pc.match_substring_regex(col, GAPS).to_numpy(zero_copy_only=False)).tolist():
            plain[i] = not mixed_gaps(col[i].as_py())
        split = pc.split_pattern(col.filter(pa.array(plain)), " ")
        edges = split.offsets.to_numpy()
        chunks = split.values.dictionary_encode()
        # the place after the last chunk stands for a text's first one, which has no space
        place = chunks.indices.to_numpy().astype(np.int64)
        place[edges[:-1]] = len(chunks.dictionary)
        used = np.zeros(len(chunks.dictionary) + 1, bool)
        used[place] = True
        names = chunks.dictionary.take(pa.array(np.flatnonzero(used[:-1])))
        names = names.to_numpy(zero_copy_only=False).tolist()  # quicker than to_pylist
        ids = list(map(self.memory.get, names))
        new = [i for i, x in enumerate(ids) if x is None]
        missing = {names[i] for i in new}
        again = missing & self.older.keys()
        self.memory.update((c, self.older[c]) for c in again)
        self.learn_all(missing - again)
        for i in new:
            ids[i] = self.memory[names[i]]
        found = pa.array([*ids, b""], pa.large_binary()).take(pa.array((np.cumsum(used) - 1)[place]))
        _, ends, data = found.buffers()
        cut = np.frombuffer(ends, np.int64)[edges].tolist() if len(found) else [0]
        rest = zip(cut, cut[1:])
        alone = col.to_pylist()
        for i, head in zip(np.flatnonzero(plain).tolist(), split.values.take(pa.array(edges[:-1])).to_pylist()):
            alone[i] = head
        raw = memoryview(data or b"")
        return [h + raw[slice(*next(rest))] if p else h for h, p in zip(self.ids(alone), plain.tolist())]


@functools.lru_cache(maxsize=2)
def chunk_encoder(name: str) -> ChunkEncoder:
    return ChunkEncoder(name)


def vocabulary_size(name: str) -> int:
    return chunk_encoder(name).library.get_vocab_size(with_added_tokens=True)


def encode_blocks(docs: DataFrame, name: str, end_id: int, bits: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of the encoded texts, each followed by ``end_id``.

    Rows go to ranges of doc_id (null first; equal ids by text) and are sorted
    there, so shard order is id order. Null texts count as empty: only the end
    id. An empty table gives no blocks."""
    prepare(docs.sparkSession)

    def run(batches):
        enc = chunk_encoder(name)
        shard = TaskContext.get().partitionId()
        ids, parts, block, first, held = [], [], 0, 0, 0
        end = np.array([end_id], "<u4").tobytes()

        def flush():
            flat = np.frombuffer(b"".join(parts), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([len(flat)], pa.int64()), pa.array([bits], pa.int32()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([[len(p) // 4 for p in parts]], pa.list_(pa.int64())),
                 pa.array([pack(flat, bits)], pa.binary())],
                names=["shard", "block", "first", "n_ids", "bits", "doc_ids", "counts", "payload"])

        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                for i, e in zip(part.column(0).to_pylist(), enc.encode_all(part.column(1))):
                    ids.append(i)
                    parts.append(e + end)
                    held += len(e) // 4 + 1
                    if held >= block_ids:
                        yield flush()
                        block, first, held, ids, parts = block + 1, first + held, 0, [], []
        if parts:
            yield flush()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, BLOCKS)


def write_packed(docs: DataFrame, path: str, name: str = "byte_bpe_50k.json", end_id: int = 2,
                 block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` and write the block table to ``path``."""
    bits = bits_for(max(vocabulary_size(name), end_id + 1))
    (encode_blocks(docs, name, end_id, bits, block_ids)
     .write.option("compression", "none").parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start``, the global position of each block's first id.
    Shard totals (one row for each written partition) give the offsets."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    at, offsets = 0, []
    for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect():
        offsets.append((r["shard"], at))
        at += r["n"]
    shards = spark.createDataFrame(offsets, "shard int, shard_start long")
    return blocks.join(F.broadcast(shards), "shard").withColumn("start", F.col("shard_start") + F.col("first"))


def read_ids(spark: SparkSession, path: str, lo: int, hi: int) -> np.ndarray:
    """Random access: ids of the global positions [lo, hi), at most a few blocks."""
    hit = read_blocks(spark, path).where((F.col("start") < hi) & (F.col("start") + F.col("n_ids") > lo))
    got = [unpack(r["payload"], r["bits"], max(0, lo - r["start"]), min(r["n_ids"], hi - r["start"]))
           for r in sorted(hit.select("start", "n_ids", "bits", "payload").collect(), key=lambda r: r["start"])]
    return np.concatenate(got) if got else np.zeros(0, np.uint32)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    def run(batches):
        for b in batches:
            start, bits, payload = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4)
            for k in range(b.num_rows):
                counts = np.array(b.column(3)[k].as_py(), np.int64)
                at = np.concatenate([[0], np.cumsum(counts)])
                raw = memoryview(unpack(payload[k].as_py(), bits[k], 0, int(at[-1])).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * at[i]: 4 * at[i + 1]]) for i in range(len(counts))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.column(2)[k].as_py(), pa.int64()), pa.array(start[k] + at[:-1], pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = read_blocks(spark, path).select("start", "bits", "doc_ids", "counts", "payload")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1(docs: DataFrame) -> DataFrame:
    """Write the packed file into the shared folder and report on it from the file."""
    spark = docs.sparkSession
    prepare(spark)
    path = shared_path(spark, "llm", "packed")
    write_packed(docs, path)
    return read_documents(spark, path)
