"""Activity ingest: JSON files, date columns, dated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidloom.functions.scalars import calendar_date, date_parts
from bidloom.sources.files import scan_glob
from bidloom.sources.sinks import write_dated

DATE_KEYS = ["year", "month", "dayofmonth"]


def with_date_parts(activity: DataFrame, created: str = "created_at") -> DataFrame:
    return activity.withColumns(date_parts(created))


def ingest(
    spark: SparkSession,
    source: str,
    pattern: str,
    target: str,
    source_format: str = "json",
    target_format: str = "parquet",
    mode: str = "append",
    schema: T.StructType | str | None = None,
) -> None:
    """One run of the job; without a schema the files are read once more to infer it.

    A gzip file is one task to read, so the write regroups rows by date.
    """
    activity = scan_glob(spark, source, f"{pattern}-*", source_format, schema)
    write_dated(with_date_parts(activity), target, DATE_KEYS, target_format, mode)


def expand(df: DataFrame, struct: str, *keep: str) -> DataFrame:
    """A struct's fields as columns."""
    return df.select(*keep, f"{struct}.*")


def expand_json(df: DataFrame, text: str, schema: str, *keep: str) -> DataFrame:
    return expand(df.withColumn(text, F.from_json(text, schema)), text, *keep)


def daily_counts(df: DataFrame, created: str) -> DataFrame:
    return df.groupBy(calendar_date(created).alias("created_at")).agg(F.count(F.lit(1)).alias("rows"))
