"""Readers for call exports and account metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.schemas import CALL_TYPE, METADATA_TYPE


def _parsed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines of gzipped exports with their file; each is parsed whole, whatever columns are asked for later."""
    lines = spark.read.option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    whole = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    return lines.withColumn("call", F.from_json("value", whole, options))


def read_call_exports(spark: SparkSession, path: str, schema: T.StructType = CALL_TYPE) -> DataFrame:
    """Calls of gzipped JSON lines, of files of any size. Blank lines are skipped; ``bad_lines`` has the broken ones."""
    calls = _parsed(spark, path, schema).where("call._broken IS NULL")
    return calls.select(*[F.col(f"call.`{f.name}`") for f in schema.fields])


def bad_lines(spark: SparkSession, path: str, schema: T.StructType = CALL_TYPE) -> DataFrame:
    """``file, line`` of what ``read_call_exports`` can't read: not JSON, or a field of another type."""
    return _parsed(spark, path, schema).where("call._broken IS NOT NULL").select("file", F.col("value").alias("line"))


def split_exports(spark: SparkSession, path: str, out: str, schema: T.StructType = CALL_TYPE) -> dict[str, int]:
    """Write the calls and the broken lines of exports in one scan; gives ``{"calls": n, "broken": n}``.

    Under ``out``, ``broken=false`` holds the calls in ``call`` and ``broken=true`` the quarantine, each with its
    file and line. The counts ride on the write, and a re-run replaces both.
    """
    seen = Observation()
    rows = _parsed(spark, path, schema).withColumn("broken", F.col("call._broken").isNotNull())
    rows = rows.select(
        "file",
        F.when(F.col("broken"), F.col("value")).alias("line"),
        F.when(~F.col("broken"), F.struct(*[F.col(f"call.`{f.name}`") for f in schema.fields])).alias("call"),
        "broken",
    )
    counted = rows.observe(seen, F.count_if(~F.col("broken")).alias("calls"), F.count_if("broken").alias("broken"))
    counted.write.partitionBy("broken").mode("overwrite").parquet(out)
    return {name: int(seen.get[name]) for name in ("calls", "broken")}


def read_split(spark: SparkSession, out: str, schema: T.StructType = CALL_TYPE) -> tuple[DataFrame, DataFrame]:
    """Calls, and broken lines with their number per file and line, of what ``split_exports`` wrote."""
    stored = T.StructType([T.StructField("file", T.StringType()), T.StructField("line", T.StringType()), T.StructField("call", schema), T.StructField("broken", T.BooleanType())])
    rows = spark.read.schema(stored).parquet(out)
    broken = rows.where("broken").groupBy("file", "line").agg(F.count(F.lit(1)).alias("n"))
    return rows.where("NOT broken").select("call.*"), broken


def read_metadata(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Account rows with ``version``, their order: time of the file, file, place in it. The last one of a key counts."""
    rows = spark.read.schema(METADATA_TYPE).format(fmt).load(path)
    place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_modification_time", "file_path", "file_block_start")]
    return rows.select("*", F.struct(*place, F.monotonically_increasing_id().alias("line")).alias("version"))


def typed_calls(df: DataFrame, date_column: str = "call_date") -> DataFrame:
    """Parse the call date where the column exists; unparseable dates become NULL."""
    if date_column not in df.columns:
        return df
    return df.withColumn(date_column, F.try_to_date(F.col(date_column)))
