"""The corpus pipeline: quality, near duplicates, repeated passages, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and applies one operator of tidemark.llm to all rows that the stage before kept;
its result is written as Parquet to the shared folder and read again, so a lost executor never goes back further than one
stage. All stages but the last return the columns of documents.

A doc_id names a document: rows of one doc_id stay or go together, and null counts as one doc_id. Other
columns, whatever their names, are carried along up to packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import saved
from tidemark.llm.decontamination import contaminated
from tidemark.llm.packing import pack
from tidemark.llm.quality_classifier import classify
from tidemark.llm.simhash import simhash_groups
from tidemark.llm.suffix_dedup import suffix_dedup
from tidemark.llm.tokens import default_tokenizer


def _only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Documents whose doc_id is (left_semi) or is not (left_anti) among the ids."""
    named = ids.select(F.col("doc_id").alias("own_id"))
    return docs.join(named, docs["doc_id"].eqNullSafe(named["own_id"]), how)


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the classifier accepts a row. Its labels are the table labels."""
    scored = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _only(docs, scored.filter("predicted = 1"), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash component; once, if its row is repeated."""
    groups = simhash_groups(docs)
    kept = _only(docs, groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))), "left_semi")
    mark = _unused(docs, "text_hash")
    return kept.withColumn(mark, F.xxhash64("text")).dropDuplicates(["doc_id", mark]).drop(mark)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur twice. A character that a passage cuts in two goes whole."""
    cut = suffix_dedup(docs, whole_characters=True).filter("n_removed > 0")
    cut = cut.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", F.col("kept").cast("string").alias("kept"))
    same = docs["doc_id"].eqNullSafe(cut["doc_id"]) & (F.xxhash64(docs["text"]) == cut["text_hash"])
    text = F.coalesce(cut["kept"], docs["text"])
    n_chars = F.when(cut["kept"].isNull(), docs["n_chars"]).otherwise(F.length(cut["kept"]).cast("long"))
    new = {"text": text, "n_chars": n_chars}
    return docs.join(cut, same, "left").select(*[new.get(c, docs[c]).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the table benchmark."""
    return _only(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their sequences of at most 1024 ids."""
    return pack(docs, default_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: SQL cannot express the classifier; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
