"""The registered queries: each operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import alignment, decontaminate, jaccard, language, mixing, neighbours, passages, repair, sharding, suffixes, tokens, toxicity, warc
from parley.llm.common import has, read, written


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    kept = language.held_out(F.col("doc_id"))
    rows = language.identify(docs.select("doc_id", "text"), language.fit(docs.filter(~kept)))
    return rows.select("doc_id", F.coalesce(kept, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.measured(read(spark, sf_dir, "documents"))
    rows = mixing.mix(written(docs.select("doc_id", "source", "__size", "__hash"), "mixing"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", F.col("passes.position").alias("positions"), F.col("passes.start").alias("starts"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(read(spark, sf_dir, "documents"), words=3, percent=90).drop("row", "component")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archived(read(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = passages.repeats(read(spark, sf_dir, "documents")).withColumn("n", F.col("last") - F.col("first"))
    return spans.groupBy("doc_id", "row").agg(
        F.count("*").alias("n_spans"),
        F.sum("n").alias("repeated_words"),
        F.sum(F.when(F.col("removed"), F.col("n")).otherwise(0)).alias("removed_words"),
        F.array_sort(F.collect_list(F.struct("first", "last", "removed"))).alias("spans"),
    ).drop("row")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~language.held_out(F.col("doc_id"), 3, 1)))
    kept = F.coalesce(language.held_out(F.col("doc_id"), 3, 1), F.lit(False))
    return toxicity.score(docs, model).select("doc_id", kept.alias("held_out"), "score", "predicted")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(read(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(decontaminate.find_passages(docs, read(spark, sf_dir, "benchmark")))


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.without_repeats(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.with_corpus_counts(read(spark, sf_dir, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """Every conversation row, some with a planted fault; ``present`` is false for the dropped ones."""
    one = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), F.concat_ws(":", one("conv_id"), one("turn")).alias("key"))
    rows = rows.withColumn("kind", F.crc32("key") % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), times.alias("copy"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(damaged(read(spark, sf_dir, "conversations")), F.col("present"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_mixing": op2_mixing,
    "op3_jaccard": op3_jaccard,
    "op4_warc": op4_warc,
    "op5_passages": op5_passages,
    "op6_neighbours": op6_neighbours,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_tokens": op9_tokens,
    "op10_decontamination": op10_decontamination,
    "op11_suffixes": op11_suffixes,
    "op12_alignment": op12_alignment,
    "op13_repair": op13_repair,
    "pipeline": pipeline,
}
ORACLE_SQL: dict[str, str] = {}
