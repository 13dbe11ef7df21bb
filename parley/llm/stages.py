"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import decontaminate as benchmark
from parley.llm import jaccard, mixing, tokens
from parley.llm import language as langid
from parley.llm.common import has, read


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; the model is learned from the rows that name a language. If none does, no language decides."""
    columns = docs.columns
    known = docs.select(has(docs, "text", "string").alias("text"), has(docs, "lang", "string").alias("lang"))
    marked = docs.select(*[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(columns)], has(docs, "text", "string").alias("text"))
    model = langid.fit(known)
    if model.languages:
        found = langid.identify(marked, model).filter(F.col("lang_pred") != langid.UNKNOWN)
    else:
        found = marked.filter(F.col("text").rlike(r"\p{L}"))
    return found.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(columns)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark."""
    columns = docs.columns
    names = {c: f"__{i}" for i, c in enumerate(columns) if c != "text"}
    rows = docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in columns])
    left = benchmark.without_passages(benchmark.find_passages(rows, read(spark, sf_dir, "benchmark")))
    return left.select(*[F.col(names.get(c, c)).alias(c) for c in columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.token_table(docs)
