"""The pipeline against its stages' plain versions."""

from __future__ import annotations

import collections
import hashlib
import re

import corpus_pipeline
import regex
from packflow.llm import bpe
from tests.llm.test_mixing import WORD, plain_mix
from tests.llm.test_operators import linked
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert set(docs.columns) == set(corpus_pipeline.COLUMNS), name


def test_near_duplicates_and_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    want = linked([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert kept == {i for i, (_, root) in want.items() if i == root}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and set(out[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    times = collections.Counter(r["doc_id"] for r in out)
    assert max(times.values()) <= 3
    docs = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(times) <= docs


def test_run_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert bpe.op7(spark.read.parquet(f"{tmp_path}/documents.parquet")).count() == 0


def test_unlike_rows_with_one_id_stay(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, "first text of its own here", "en", "a", 1), (1, "another one that is unlike it", "en", "b", 1),
            (1, "first text of its own here", "de", "c", 1), (2, base, "en", "a", 1), (3, base + " end", "en", "a", 1),
            (None, base, "en", "a", 1), (None, "alone without an id or a copy", "en", "a", 1), (9, None, None, None, None)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got) == sorted([
        ("1", rows[0][1]), ("1", rows[1][1]), ("2", base), ("None", rows[6][1]), ("9", "")])
    assert {r["lang"] for r in got if r["text"] == rows[0][1]} == {"de"}


PATTERNS = [
    ("assign", r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)(?P<v>[A-Za-z0-9+/_.=-]+)"""),
    ("access", r"(?P<v>AKIA[A-Z0-9]{14,})"), ("hex", r"(?P<v>[0-9a-f]{16,})"),
    ("user", r"""(?:(?i:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?)(?P<v>[A-Za-z0-9._@+-]{3,})"""),
    ("end", r"""(?P<v>[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>,;]{4,})""")]


def masked(text: str) -> str:
    """Base spans, and weak parts whose 200-character cells touch or neighbour a complementary part's."""
    found = {k: [(m.start(), m.end(), len(m["v"])) for m in re.finditer(p, text)] for k, p in PATTERNS}
    full = [s for s in found["assign"] if s[2] >= 12]
    weak = [s for s in found["assign"] if 6 <= s[2] <= 11]
    if not (found["assign"] or found["access"] or found["hex"]):
        return text
    cells = lambda spans: {c for s, e, _ in spans for c in range(s // 200 - 1, e // 200 + 2)}
    near = lambda spans, c: [s for s in spans if any(x in c for x in range(s[0] // 200, s[1] // 200 + 1))]
    secrets_, others = cells(full + found["hex"] + weak), cells(found["access"] + found["user"] + found["end"])
    spans = full + found["access"] + found["hex"] + near(weak, others) + near(found["user"], secrets_) + near(found["end"], secrets_)
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if s >= at:
            out.append(text[at:s] + "[REDACTED]")
        at = max(at, e)
    return "".join(out) + text[at:]


def test_run_against_a_plain_pipeline(spark):
    """All five stages done plainly: letters, links, masks, mix, the tokenizers library."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs if r["text"] is not None and regex.search(r"\p{L}", r["text"])]
    roots = linked([(i, t) for i, _, t in rows])
    rows = [(i, s, masked(t)) for i, s, t in rows if roots[i][1] == i]
    library = Tokenizer.from_file(bpe.tokenizer_file("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = collections.Counter()
    for (i, _, t), words in zip(rows, plain_mix(rows)):
        ids = library.encode(t, add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        size = len(WORD.findall(t))
        want[(i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += (
            words // size if size else 0)
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                              for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want
