"""Documents to training tokens: each stage works on what its predecessor kept, written as Parquet between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley.llm.common import read, written
from parley.llm.stages import decontaminate, language, mix_sources, near_duplicates, token_files

#: (name, function of (spark, docs, sf_dir)), in this order.
STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_output", token_files),
]
#: Viterbi, suffix order and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
