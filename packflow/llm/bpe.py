"""Operator 7: BPE encoding by backtracking, and decoding by an offset table.

The merges of a pair-merge vocabulary give each token its rank and its last
split. Two neighbouring tokens are compatible when merging their joined
symbols would leave exactly these two; a piece's encoding is the one sequence
of pairwise compatible tokens. An Aho-Corasick automaton over the vocabulary
finds the longest token at each place; the encoder takes it, checks it against
its predecessor, and on a conflict tries the next shorter one or steps back.
Places proven dead are marked, so the work is linear in the piece.

Pieces (words as the tokenizer's pattern cuts them) repeat, so a task keeps a
bounded memory of encoded words, in two generations.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from packflow.llm.common import prepare, texts, tidy, worker_state

#: stands for the word end mark: one symbol that no byte maps to
END = "\u0200"
MEMORY = 200_000  # words of a generation that a worker remembers (about 220 bytes each)
PAIRS = 1 << 18  # token pairs whose compatibility a worker remembers (about 130 bytes each)
MARKS = ".,;:!?"
GAP = "\n"  # between ids and decoded text of a remembered word; no token holds it

FAR = regex.compile("[^\\x00-\u052f]")
CONTROL = regex.compile("[\\x1c-\\x1f]")

#: the tokenizer's white space (Unicode White_Space) and letter, digit, other runs: fixed values of its file format
WHITE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
GAPS = regex.compile(f"[{WHITE}]+")


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes, as byte-level vocabularies use:
    printable Latin-1 bytes stand for themselves, the rest count up from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Vocabulary:
    """Tokens, ranks, splits and the automaton of one tokenizer file."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        mark = model.get("end_of_word_suffix") or ""
        self.bytes_to_text = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}")).findall
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split

        def inner(token: str) -> str:
            return token[: -len(mark)] + END if mark and token.endswith(mark) and len(token) > len(mark) else token

        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        # rank of a token: the place of its merge; base symbols come before all merges
        self.rank = {}
        self.parts = {}
        self.merged = {}
        for k, (a, b) in enumerate(model["merges"]):
            a, b = inner(a), inner(b)
            t = a + b
            if t not in self.rank and t in self.ids:
                self.rank[t] = k + 1
                self.parts[t] = (a, b)
            self.merged.setdefault((a, b), t)
        base = [t for t in self.ids if t not in self.rank]
        for t in base:
            self.rank[t] = 0
            self.parts[t] = (t, t)
        self.by_id = [""] * (max(self.ids.values()) + 1)
        for t, i in self.ids.items():
            self.by_id[i] = t
        # the same tables by id, for the checks between tokens
        self.rank_of = [self.rank.get(t, 0) for t in self.by_id]
        self.left_of = [self.ids[self.parts[t][0]] if t in self.parts else 0 for t in self.by_id]
        self.right_of = [self.ids[self.parts[t][1]] if t in self.parts else 0 for t in self.by_id]
        self.merge_rank = {self.ids[a] << 20 | self.ids[b]: self.rank[t] for (a, b), t in self.merged.items()
                           if t in self.rank and a in self.ids and b in self.ids}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            if len(t) <= 2 or self.reachable(t):
                self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        # decoding: all token texts joined, and where each starts
        table = sorted([(i, t) for t, i in model["vocab"].items()] + [(i, t) for t, i in self.special.items()])
        at, out = 0, []
        self.offsets = np.zeros(table[-1][0] + 2, np.int64)
        for i, t in table:
            self.offsets[i] = at
            at += len(t)
            self.offsets[i + 1] = at
            out.append(t)
        self.joined = "".join(out)
        self.starts = self.offsets.tolist()

    def reachable(self, token: str) -> bool:
        """Whether merging the token's own symbols gives the token: its two
        halves must be compatible up to its own rank."""
        a, b = self.parts[token]
        return a == b == token or self._compatible(a, b, self.rank[token])

    def _compatible(self, a: str, b: str, limit: float = float("inf")) -> bool:
        """No merge across the border of ``a`` and ``b`` would happen before the
        merges that make them. Undoing the latest merge on either side shows
        every pair that ever met at the border; equal ranks merge from the left."""
        rank, parts, merged = self.rank, self.parts, self.merged
        while True:
            t = merged.get((a, b))
            if t is not None and rank[t] < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra == 0 and rb == 0:
                return True
            if ra > rb:
                limit, a = ra, parts[a][1]
            else:
                limit, b = rb + 1, parts[b][0]

    def fits(self, a: int, b: int) -> bool:
        """``_compatible`` of two ids, remembered."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        key = a << 20 | b
        rank, left, right, merges = self.rank_of, self.left_of, self.right_of, self.merge_rank
        limit = 1 << 30
        ok = True
        while True:
            if merges.get(a << 20 | b, limit) < limit:
                ok = False
                break
            ra, rb = rank[a], rank[b]
            if ra == 0 and rb == 0:
                break
            if ra > rb:
                limit, a = ra, right[a]
            else:
                limit, b = rb + 1, left[b]
        self.pairs[key] = ok
        return ok

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece of text."""
        if piece.isascii() and piece.isprintable():
            return self.encode_symbols(piece)
        alphabet = self.bytes_to_text
        return self.encode_symbols("".join([alphabet[x] for x in piece.encode("utf-8", "surrogatepass")]))

    def encode_symbols(self, symbols: str) -> list[int]:
        """Ids of one piece given as byte stand-ins."""
        s = symbols + END
        whole = self.automaton.get(s, None)
        if whole is not None:
            return [whole[1]]
        n = len(s)
        sizes: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # at each start, ascending
        for end, token in self.automaton.iter(s):
            sizes[end - token[0] + 1].append(token)
        known, fits = self.pairs.get, self.fits
        dead = bytearray(n + 1)
        took: list[tuple[int, int]] = []
        last = -1
        left = [len(sizes[0])]  # candidates not yet tried at each place of the stack
        pos = 0
        while pos < n:
            options, k, step = sizes[pos], left[-1], 0
            while k:
                k -= 1
                size, token = options[k]
                if dead[pos + size]:
                    continue
                if last >= 0:
                    ok = known(last << 20 | token)
                    if ok is None:
                        ok = fits(last, token)
                    if not ok:
                        continue
                step = size
                break
            if step:
                left[-1] = k
                took.append(options[k])
                last = token
                pos += step
                if pos < n:
                    left.append(len(sizes[pos]))
            else:
                dead[pos] = 1
                left.pop()
                pos -= took.pop()[0]
                last = took[-1][1] if took else -1
        return [i for _, i in took]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by one space (the file names no decoder)."""
        joined, offsets = self.joined, self.starts
        return " ".join([joined[offsets[i]: offsets[i + 1]] for i in ids])


class Encoder:
    """Texts to ids, with a memory of words.

    Characters beyond U+052F are classed and put in lower case by the
    tokenizers library's own normaliser and splitter, so that its Unicode
    version counts; merging is done here."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.vocabulary = Vocabulary(path)
        self.library = Tokenizer.from_file(path)

    def word(self, word: str) -> list[int]:
        v = self.vocabulary
        if word.isascii() and word.isalpha():
            return v.encode_symbols(word)  # one piece of letters
        if FAR.search(word):
            return [t for s, _ in self.library.pre_tokenizer.pre_tokenize_str(word) for t in v.encode_symbols(s)]
        return [t for p in v.pieces(word) for t in v.encode_piece(p)]

    def words(self, text: str) -> list[str]:
        """Words after the tokenizer's normalisation: composed form, white
        space runs cut, each character in lower case by itself."""
        if text.isascii() and not CONTROL.search(text):
            return text.lower().split()
        if FAR.search(text):
            text = self.library.normalizer.normalize_str(text)
        else:
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        return [w for w in GAPS.split(text) if w]

    def parts(self, text: str) -> list[tuple[list[str] | None, int]]:
        """The text cut at special tokens: (words, 0) or (None, id)."""
        v = self.vocabulary
        if not any(t in text for t in v.special):
            return [(self.words(text), 0)]
        return [(None, v.special[x]) if x in v.special else (self.words(x), 0) for x in v.split_special(text) if x]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for words, special in self.parts(text):
            if words is None:
                out.append(special)
            else:
                for w in words:
                    out.extend(self.word(w))
        return out


class Memory(dict):
    """word -> ids as text, GAP, decoded text (one string: half the memory of
    two). When full, its words become the older generation, from which words
    that are met again come back."""

    def __init__(self, owner: Encoder):
        super().__init__()
        self.owner = owner
        self.older: dict[str, str] = {}

    def __missing__(self, word: str) -> str:
        if len(self) >= MEMORY:
            self.older = dict(self)
            self.clear()
        got = self.older.get(word)
        if got is None:
            # marks after a letter or digit are a piece of their own: the word before them may be known
            stem = word.rstrip(MARKS)
            if stem != word and stem and stem[-1] < "\u0530" and stem[-1].isalnum():
                a, b = self[stem].split(GAP), self[word[len(stem):]].split(GAP)
                got = a[0] + " " + b[0] + GAP + a[1] + " " + b[1]
            else:
                ids = self.owner.word(word)
                got = " ".join(map(str, ids)) + GAP + self.owner.vocabulary.decode(ids)
        self[word] = got
        return got


class Digests(Encoder):
    """Count, id digest and decoded digest of texts, from remembered word strings."""

    def __init__(self, path: str):
        super().__init__(path)
        self.memory = Memory(self)

    def of(self, text: str) -> tuple[int, str, str]:
        got: list[str] = []
        for words, special in self.parts(text):
            if words is None:
                got.append(str(special) + GAP + self.vocabulary.decode([special]))
            else:
                got += map(self.memory.__getitem__, words)
        both = GAP.join(got).split(GAP)
        joined, decoded = " ".join(both[0::2]), " ".join(both[1::2])
        return (joined.count(" ") + 1 if joined else 0, hashlib.sha256(joined.encode()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_file(name: str) -> str:
    """The public file's place on this machine (workers look it up themselves)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def encode(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, ids (array), decoded text of every whole text; null texts count
    as empty (no ids, empty text); rows are independent."""
    prepare(docs.sparkSession)

    def run(batches):
        e = encoder(tokenizer_file(name))
        for b in batches:
            ids = [e.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([e.vocabulary.decode(i) for i in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def op7(docs: DataFrame, name: str = "word_bpe_49k.json") -> DataFrame:
    """Count and digests of the encoder's ids and of their decoding."""
    prepare(docs.sparkSession)

    def run(batches):
        d = worker_state(("digests", name), lambda: Digests(tokenizer_file(name)))
        for b in batches:
            got = [d.of(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()),
                 pa.array([g[2] for g in got], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
