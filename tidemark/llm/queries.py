"""The registered queries of this subpackage: one for each operator, and the pipeline. ORACLES has checks in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm.alignment import op13_token_alignment
from tidemark.llm.byte_bpe import op11_byte_bpe
from tidemark.llm.decontamination import op4_decontamination
from tidemark.llm.oracles import ORACLES
from tidemark.llm.packing import op6_packing
from tidemark.llm.periodic_runs import op12_periodic_runs
from tidemark.llm.quality_classifier import op3_quality_classifier
from tidemark.llm.quality_rules import op9_quality_rules
from tidemark.llm.sharding import op10_shard
from tidemark.llm.simhash import op2_simhash
from tidemark.llm.substring_dedup import op1_substring_dedup
from tidemark.llm.suffix_dedup import op5_suffix_dedup
from tidemark.llm.token_files import op8_token_files
from tidemark.llm.warc import op7_warc

__all__ = ["ORACLES", "QUERIES"]
ROOT = str(Path(corpus_pipeline.__file__).resolve().parent)


def importable(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with Python workers told where the driver has this package; they need it from wherever they start."""

    @wraps(run)
    def started(spark: SparkSession, sf: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return run(spark, sf)

    return started


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash": op2_simhash,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_decontamination": op4_decontamination,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_token_files": op8_token_files,
    "op9_quality_rules": op9_quality_rules,
    "op10_shard": op10_shard,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}
QUERIES = {name: importable(run) for name, run in QUERIES.items()}
