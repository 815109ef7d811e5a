"""File sources and sinks. Schemas are always given, so no read ever scans to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.schema import APPLICATIONS, REQUEST


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType = APPLICATIONS) -> DataFrame:
    """Applications from CSV, JSON or Parquet; a missing path or a malformed row raises."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.csv(path, header=True, mode="FAILFAST")
    if fmt == "json":
        return reader.json(path, mode="FAILFAST")
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] = ()) -> None:
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


RAW = "raw_record"


def with_raw(schema: T.StructType) -> T.StructType:
    """The schema with a column for the text of records that do not parse."""
    return T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])


def read_requests(spark: SparkSession, path: str, schema: T.StructType = REQUEST,
                  keep_raw: bool = False) -> DataFrame:
    """Request records, one JSON object per line; unparsable lines surface as all-null rows,
    which validation then rejects. ``keep_raw`` adds their text as ``raw_record``."""
    reader = spark.read.schema(with_raw(schema) if keep_raw else schema)
    return reader.option("columnNameOfCorruptRecord", RAW).json(path, mode="PERMISSIVE")


def read_request_stream(spark: SparkSession, path: str, schema: T.StructType = REQUEST,
                        files_per_batch: int | None = None, keep_raw: bool = False) -> DataFrame:
    reader = spark.readStream.schema(with_raw(schema) if keep_raw else schema) \
        .option("columnNameOfCorruptRecord", RAW)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def as_json(df: DataFrame, columns: list[str] | None = None, out: str = "record") -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(out))


def write_results(assessed: DataFrame, metrics: DataFrame, path: str) -> None:
    """Assessment records and portfolio metrics as JSON lines under one folder."""
    assessed.write.mode("overwrite").json(f"{path}/predictions")
    metrics.write.mode("overwrite").json(f"{path}/portfolio_metrics")


def write_comparison(comparison: DataFrame, path: str) -> None:
    """Ranked model metrics as one CSV file (one row per model)."""
    comparison.coalesce(1).write.mode("overwrite").csv(path, header=True)


COMPARISON = T.StructType([T.StructField("model", T.StringType())] + [
    T.StructField(c, T.DoubleType()) for c in ("roc_auc", "precision", "recall", "f1")])


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPARISON).csv(path, header=True)
