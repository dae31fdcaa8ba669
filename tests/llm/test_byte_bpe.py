"""Byte-level BPE against the tokenizer library, and the cutter against its pattern."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from tests.conftest import SF
from tests.llm.test_operators import CLASHES, HARD, bag
from tests.llm.test_parts import TWINS
from tidemark.llm import byte_bpe
from tidemark.llm.byte_bpe import decode, default_ranks, encode, ranks_of, round_trip, token_bytes
from tidemark.llm.pretokens import PATTERN, matches
from tidemark.llm.queries import QUERIES

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks_of(default_ranks()), special_tokens={})


@pytest.fixture(scope="module")
def hard(spark):
    names = ", ".join(f"{c} int" for c in (*CLASHES, "block", "ids", "id", "token", "counts"))
    rows = [*HARD, (30, TWINS[0]), (31, TWINS[1]), (32, "don't we'll 'sup ''s 's's \n's x'"), (33, "y" * 200_000)]
    return spark.createDataFrame([(*r, *[7] * (len(CLASHES) + 5)) for r in rows], f"doc_id long, text string, {names}").repartition(3)


def want(library, docs):
    out = Counter()
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        out[doc_id, len(ids), sha, hashlib.sha256((text or "").encode()).hexdigest()] += 1
    return out


def test_matches_are_those_of_the_pattern():
    assert PATTERN == public_tokenizers.PATTERN
    rng, pattern = random.Random(5), regex.compile(PATTERN)
    for _ in range(2000):
        texts = ["".join(rng.choice("ab1'  \n\t!stredvlm 　é½🙂\x1c\x00") for _ in range(rng.randint(0, 30))) for _ in range(4)]
        found, ends = matches(pa.array([*texts, None]), limit=rng.choice([1, 3, 10, 1000]))
        own = [pattern.findall(t) for t in texts]
        assert found.to_pylist() == [m.encode() for ms in own for m in ms]
        assert ends.tolist() == [*np.cumsum([len(ms) for ms in own]).tolist(), len(found)]


@pytest.mark.parametrize("small", [False, True])
def test_round_trip(spark, library, hard, small, monkeypatch):
    if small:  # blocks of a few documents, many ranges, long texts in several slices
        monkeypatch.setattr(byte_bpe, "SLICE", 500)
    sizes = {"block_bytes": 3000, "range_bytes": 20_000} if small else {}
    assert bag(round_trip(hard, default_ranks(), **sizes)) == want(library, hard)


def test_query_on_the_given_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert bag(QUERIES["op11_byte_bpe"](spark, SF)) == want(library, docs)


def test_each_distinct_word_is_sent_once_a_block_and_encoded_once(spark):
    docs = spark.createDataFrame([(i, "same words again and again the same words") for i in range(200)], "doc_id long, text string").coalesce(1)
    blocks = byte_bpe.blocks_of(docs, block_bytes=1000)
    sent = [len(byte_bpe.unpack_words(p["words"])) for r in blocks.collect() for p in r["packs"]]
    assert blocks.count() == 9 and sum(sent) == 9 * 6


def test_encode_and_decode(spark, library, hard):
    ids = encode(hard, default_ranks())
    own = Counter((r["doc_id"], tuple(library.encode_ordinary(r["text"] or ""))) for r in hard.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in ids.collect()) == own
    table = token_bytes(spark, default_ranks())
    back = decode(ids, table, rows=4)
    assert Counter((r["doc_id"], bytes(r["bytes"])) for r in back.collect()) == Counter((r["doc_id"], (r["text"] or "").encode()) for r in hard.collect())
    none = spark.createDataFrame([(1, None), (None, []), (2, [72, 73])], "doc_id long, ids array<int>")
    assert Counter((r[0], bytes(r[1])) for r in decode(none, table).collect()) == Counter([(1, b""), (None, b""), (2, library.decode_bytes([72, 73]))])
    with pytest.raises(Exception, match="not in the token-byte table"):
        decode(spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>"), table).collect()


def test_empty_tables(spark, hard):
    assert round_trip(hard.limit(0), default_ranks()).count() == 0
    assert encode(hard.limit(0), default_ranks()).count() == 0
    assert decode(encode(hard.limit(0), default_ranks()), token_bytes(spark, default_ranks())).count() == 0


def test_packed_numbers():
    for values in ([], [0], [65534, 65535, 65536, 2**32 - 1], range(70_000)):
        assert byte_bpe.unpack(byte_bpe.pack(np.array(values, np.int64))).tolist() == list(values)
