"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from check import compare
from tests.conftest import SF
from tests.llm.test_operators import HARD, fingerprint, repeats
from tidemark.llm.decontamination import contaminated
from tidemark.llm.quality_classifier import classify
from tidemark.llm.queries import ORACLES, QUERIES

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, SF, name) == ""


def test_all_are_registered():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {name.split("_")[0] for name in QUERIES}


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(d, t, "en", "s", len(t or ""), 1, 2) for d, t in HARD]
    return spark.createDataFrame(rows, COLUMNS + ", text_hash int, own_id int")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_are_as_asked():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "repeated_passages", "decontamination", "packing"
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_keeps_what_the_classifier_accepts(spark, given):
    out = corpus_pipeline.quality(spark, given, SF)
    good = {r["doc_id"] for r in classify(given, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    assert rows(out) == rows(given.filter(given["doc_id"].isin(good))) and out.dtypes == given.dtypes
    assert 0 < len(good) < given.count()


def plain_components(texts):
    codes = [(d, fingerprint(t or "")) for d, t in texts]
    label = {d: d for d, _ in codes}
    for i, (d, a) in enumerate(codes):
        for e, b in codes[:i]:
            if (a ^ b).bit_count() <= 2:
                old, new = max(label[d], label[e]), min(label[d], label[e])
                label = {k: new if v == old else v for k, v in label.items()}
    return label


def test_near_duplicates_keep_one_of_each_group(spark, given):
    out = corpus_pipeline.near_duplicates(spark, given, SF)
    label = plain_components([(r["doc_id"], r["text"]) for r in given.collect()])
    assert {r["doc_id"] for r in out.collect()} == set(label.values()) and out.dtypes == given.dtypes
    assert rows(out) == rows(given.filter(given["doc_id"].isin(set(label.values()))))


def test_repeated_passages_go_from_all_documents(spark, given):
    out = corpus_pipeline.repeated_passages(spark, given, SF)
    own = [(tuple(r), r["doc_id"], r["text"].encode()) for r in given.collect()]
    want = Counter()
    for (row, _, text), gone in zip(own, repeats([t for *_, t in own], 200)):
        first = 0
        for k in range(len(text)):  # a character of which a byte goes, goes whole
            first = k if text[k] & 0xC0 != 0x80 else first
            if gone[k]:
                stop = next((j for j in range(first + 1, len(text)) if text[j] & 0xC0 != 0x80), len(text))
                gone[first:stop] = b"\1" * (stop - first)
        kept = bytes(x for x, g in zip(text, gone) if not g).decode()
        want[row[0], kept, *row[2:4], len(kept) if sum(gone) else row[4]] += 1
    assert rows(out) == want and out.dtypes == given.dtypes


def test_decontamination_drops_holders_of_items(spark, given):
    out = corpus_pipeline.decontamination(spark, given, SF)
    bad = {r["doc_id"] for r in contaminated(given, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert bad and rows(out) == rows(given.filter(~given["doc_id"].isin(bad))) and out.dtypes == given.dtypes


def test_stages_on_hard_rows_and_empty_tables(spark, hard):
    for docs in (hard, hard.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.dtypes == docs.dtypes
            count = out.count()
            assert (count > 0) == (docs.count() > 0)
            if name == "repeated_passages":
                assert count == docs.count()
    once = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, hard, SF).collect()]
    assert once.count(4) == 1 and once.count(1) == 1 and 2 not in once and 3 not in once and 15 not in once


def test_the_pipeline_is_its_stages(spark, given):
    docs = given
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    once = lambda df: rows(df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens"))
    assert once(docs) == once(corpus_pipeline.run(spark, SF))
