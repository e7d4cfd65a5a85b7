"""Scans: glob scans, dated partition scans, temp views and file inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_PARTS = ("year", "month", "day")
HOUR_PARTS = DAY_PARTS + ("hour",)


def scan_glob(
    spark: SparkSession, folder: str, pattern: str, file_format: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Files of one folder that match a pattern; give a schema to spare the inference pass."""
    reader = spark.read.format(file_format)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{folder.rstrip('/')}/{pattern}")


def json_view(spark: SparkSession, name: str, path: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING JSON OPTIONS (path='{path}')")


def table_path(base: str, layer: str, dataset: str) -> str:
    """Layers are raw, converted, final and validation."""
    return f"{base.rstrip('/')}/{layer}/{dataset}"


def partition_path(table: str, run_date: str, hour: str | None = None) -> str:
    year, month, day = run_date.split("-", 2)
    leaf = f"{table.rstrip('/')}/year={year}/month={month}/day={day}"
    return leaf if hour is None else f"{leaf}/hour={hour}"


def scan_partitions(
    spark: SparkSession, table: str, run_date: str | None = None, hours: tuple[str, ...] = (), hourly: bool = True
) -> DataFrame:
    """The named day or hours of a dated table, or all of it.

    Only the wanted folders are listed. The partition columns are declared as strings, so '05' stays '05'
    whatever the session says about partition type inference.
    """
    if run_date is None:
        leaves = [table]
    elif hours:
        leaves = [partition_path(table, run_date, h) for h in hours]
    else:
        leaves = [partition_path(table, run_date)]
    parts = HOUR_PARTS if hourly else DAY_PARTS
    stored = spark.read.parquet(leaves[0]).schema
    declared = [field for field in stored if field.name not in parts]
    declared += [T.StructField(name, T.StringType()) for name in parts]
    return spark.read.schema(T.StructType(declared)).option("basePath", table).parquet(*leaves)


def file_inventory(df: DataFrame) -> DataFrame:
    """Files, bytes and rows behind a file-backed DataFrame."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.max("_metadata.file_size").alias("file_bytes"), F.count(F.lit(1)).alias("file_rows")
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_bytes").alias("bytes"),
        F.sum("file_rows").alias("rows"),
    )
