"""Shards by weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import has, running_before, written


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest score -weight / ln(u), u drawn from the hash of key and shard.

    A shard's scores depend on nothing but the key and its own number and weight. So a further shard
    takes rows only into itself, and a shard's rows are in proportion to its weight. A NULL key is a
    key like any other. A weight of 0 leaves a shard empty.
    """
    scores = []
    for shard, weight in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        scores.append(F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(-shard).alias("shard")))
    return (-F.array_max(F.array(*scores))["shard"]).cast("int")


def assign_shards(docs: DataFrame, weights: Sequence[float] = (1.0,) * 8, added: float = 1.0) -> DataFrame:
    """A row for each document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``shard`` depends on doc_id and the weights alone; ``grown_shard`` is the shard after one of weight
    ``added`` joins. ``slot`` counts the rows of a shard from 0 without gaps, in the order of a hash of
    id and text. ``size`` is the UTF-8 length plus 1, so 1 for NULL and empty texts; ``text_crc32`` is
    NULL for a NULL text. Rows without an id share a shard; repeated rows share a shard and take a slot
    each. An empty table gives no rows; further columns are ignored.
    """
    key = has(docs, "doc_id", "long")
    text = has(docs, "text", "string")
    rows = docs.select(
        key.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(key, text).alias("__hash"),
    )
    rows = rows.withColumns(
        {"shard": rendezvous(F.col("doc_id"), weights), "grown_shard": rendezvous(F.col("doc_id"), [*weights, added])}
    )
    rows = written(rows, "sharding")
    slots = running_before(rows, "shard", "__hash", ["doc_id", "text_crc32"], F.lit(1).cast("long"), "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
