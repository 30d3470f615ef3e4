"""Scans and sinks: tables of a folder, columns and filters pushed to the files by the optimizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Formats that hold a schema of their own; others need one, as inferring it reads the whole input.
TYPED = {"parquet", "orc", "avro"}


def scan(spark: SparkSession, folder: str, name: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """The table <folder>/<name>.<fmt>. schema: StructType or DDL."""
    if schema is None and fmt not in TYPED:
        raise ValueError(f"{fmt} needs a schema")
    reader = spark.read.format(fmt).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(f"{folder}/{name}.{fmt}")


def sink(df: DataFrame, folder: str, name: str, fmt: str = "parquet", by=(), mode: str = "errorifexists", **options) -> None:
    """Writes <folder>/<name>.<fmt>; by: columns whose values become folders, so that scans read those asked for alone."""
    df.write.format(fmt).options(**options).partitionBy(*by).mode(mode).save(f"{folder}/{name}.{fmt}")


def register(spark: SparkSession, folder: str, *names: str) -> None:
    """The folder's tables as views of the session."""
    for name in names:
        scan(spark, folder, name).createOrReplaceTempView(name)
