"""Cross-tokenizer alignment against a plain version with the two libraries, and the perfect hash."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF
from tests.llm.test_operators import CLASHES, HARD, bag
from tests.llm.test_parts import TWINS
from tidemark.llm import alignment
from tidemark.llm.alignment import Coded, align, byte_level, coded, default_pieces, line_up, pair_counts, pieces_of
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.queries import QUERIES
from tidemark.llm.tokens import SPELLING, default_tokenizer

LIBRARY = Tokenizer.from_file(default_tokenizer())
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=default_pieces())
PLAIN = {c: b for b, c in SPELLING.items()}


def piece_bytes(i):
    piece = PIECES.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()


def plain_groups(text):
    """[(ids of A, ids of B)], empty for a text without tokens."""
    if not text:
        return []
    a, b = LIBRARY.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    spelt = [[bytes(PLAIN[c] for c in LIBRARY.id_to_token(i)) for i in a], [piece_bytes(i) for i in b]]
    if any(b"".join(s) != (" " + text).encode() for s in spelt):
        return []
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelt]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out, i, j = [], 0, 0
    for cut in cuts:
        x, y = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
        out.append((a[i:x], b[j:y]))
        i, j = x, y
    return out


def plain(rows):
    lined = [(d, plain_groups(t)) for d, t in rows]
    count = Counter(pair for _, groups in lined for pair in {(x, y) for a, b in groups for x in a for y in b})
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = Counter()
    for d, groups in lined:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        sizes = sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links)
        out[d, *sizes, sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), sha] += 1
    return out, count, most


@pytest.fixture(scope="module")
def hard(spark):
    names = ", ".join(f"{c} int" for c in (*CLASHES, "block", "node", "keys", "counts", "best", "vector", "hash", "packs"))
    odd = ["a▁b", "tab\tand  two   spaces ", " lead", "x", " ", "<s> </s> <unk> <0x41>", "q\x00r", "½ ﬁ Å", "</w>" * 40, "z" * 3000, "ab" + " " * 9 + "c"]
    rows = [*HARD, *((100 + i, t) for i, t in enumerate([*odd, *TWINS]))]
    return spark.createDataFrame([(*r, *[7] * (len(CLASHES) + 8)) for r in rows], f"doc_id long, text string, {names}").repartition(3)


@pytest.mark.parametrize("small", [False, True])
def test_hard_rows(hard, small, monkeypatch):
    sizes = {}
    if small:  # long texts in parts, few links at a time, blocks of a few documents, a tree of several levels
        monkeypatch.setattr(alignment, "PART", 300)
        monkeypatch.setattr(alignment, "TOKENS", 200)
        monkeypatch.setattr(alignment, "LINKS", 7)
        sizes = {"block_bytes": 2000, "shards": 5, "fan": 2}
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    if small:
        rows = [r for r in rows if len(r[1] or "") < 20_000]
        hard = hard.filter("text is null or length(text) < 20000")
    want, count, most = plain(rows)
    assert bag(align(hard, default_tokenizer(), default_pieces(), **sizes)) == want
    got = pair_counts(hard, default_tokenizer(), default_pieces(), **sizes)
    assert bag(got) == Counter((x, y, n, n == most[x]) for (x, y), n in count.items())


def test_groups_are_returned(hard):
    rows = align(hard, default_tokenizer(), default_pieces(), groups=True).collect()
    for r in rows:
        assert r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")
    assert {r["groups"] for r in rows if r["doc_id"] == 103} == {";".join(f"{a[0]}|{','.join(map(str, b))}" for a, b in plain_groups("x"))}


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_token_alignment"](spark, SF)
    assert bag(got) == plain(docs)[0]
    assert {k for c, k in got.dtypes if c != "groups_sha256"} == {"bigint"}


def test_empty_table(hard):
    assert align(hard.limit(0), default_tokenizer(), default_pieces()).count() == 0
    assert pair_counts(hard.limit(0), default_tokenizer(), default_pieces()).count() == 0


@given(st.lists(st.text(alphabet=st.sampled_from("ab  cé\n\t▁.1'<>s\x00🙂"), max_size=40), max_size=5), st.sampled_from([5, 1 << 20]))
@settings(deadline=None, max_examples=150)
def test_lined_up_ids(texts, part):
    first, second = byte_level(default_tokenizer()), pieces_of(default_pieces())
    sizes = alignment.PART, alignment.TOKENS
    alignment.PART, alignment.TOKENS = part, part
    try:
        lines = [[] for _ in texts]
        for own in Coded.from_bytes(coded([t.encode() for t in texts], first, second).to_bytes()).slices():
            got = line_up(own, (first.size, second.size))
            for doc, a, b in zip(got.doc.tolist(), np.split(got.a, got.a_cut), np.split(got.b, got.b_cut)):
                lines[doc].append((a.tolist(), b.tolist()))
    finally:
        alignment.PART, alignment.TOKENS = sizes
    assert lines == [plain_groups(t) for t in texts]


@given(st.sets(st.integers(0, 2**40), max_size=300))
@settings(deadline=None)
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.int64)
    own = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes())
    assert sorted(own.numbers(keys).tolist()) == list(range(len(keys)))
    assert len(own.numbers(np.array([7, 2**41]))) == 2


def test_wide_numbers_round_trip():
    for values in ([], [0, 2**40, -1]):
        assert alignment._narrow(alignment._wide(np.array(values, np.int64))).tolist() == values
    assert pa.schema(alignment.TABLES).names == ["shard", "hash", "keys", "counts", "best"]
