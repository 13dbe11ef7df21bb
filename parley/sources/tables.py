"""Partitioned Parquet tables: idempotent writes, catalog registration, flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_PARTS = ("year", "month", "day")


def write_partitions(df: DataFrame, path: str, partitions: Sequence[str] = DATE_PARTS) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay.

    Rows are rebalanced by partition value first: few files for small partitions, while AQE splits
    one that holds a large share of the rows.
    """
    write_placed(df.hint("rebalance", *partitions), path, partitions)


def write_placed(df: DataFrame, path: str, partitions: Sequence[str] = DATE_PARTS) -> None:
    """The same for rows that are dealt by partition already."""
    writer = df.write.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)


def write_rollup(df: DataFrame, path: str) -> None:
    """Entity rollups by date: the latest run of a date is the one that stays."""
    write_partitions(df, path, ["rollup_date"])


def write_buckets(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    """A table stored in buckets of ``key``: joins and aggregates on the key read it without a shuffle.

    Both sides of a join need the same number of buckets. Each task writes a file for every bucket it has rows of,
    so rows are brought together by key first.
    """
    together = df.repartition(buckets, key)
    together.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(name)


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partitions: Sequence[str] = DATE_PARTS
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'"
    )
    discover_partitions(spark, name)


def discover_partitions(spark: SparkSession, name: str) -> None:
    """Make partitions that were written since the last call visible."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """Column names, types and partition flags of a registered table."""
    rows = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, "name string, type string, is_partition boolean")


def _leaves(dtype: T.StructType, col: Column, prefix: str) -> list[Column]:
    out = []
    for field in dtype:
        name = f"{prefix}_{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, col[field.name], name)
        else:
            out.append(col[field.name].alias(name.lower()))
    return out


def date_parts(call_date: Column) -> list[Column]:
    return [F.year(call_date), F.month(call_date), F.dayofmonth(call_date)]


def flatten_insights(df: DataFrame, insight: str, call_date: Column | None, keep: Sequence[str] = ()) -> DataFrame:
    """Nested insight struct -> flat lower-case columns plus ``year``, ``month``, ``day``, which are there if no date is given."""
    flat: list[Column] = []
    for field in df.schema[insight].dataType:
        flat += _leaves(field.dataType, F.col(insight)[field.name], field.name)
    return df.select(
        *keep,
        *flat,
        *(DATE_PARTS if call_date is None else [c.alias(name) for name, c in zip(DATE_PARTS, date_parts(call_date), strict=True)]),
    )
