"""Sinks: dated appends, snapshots, clustered files, codec comparison and read-back checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.sources.files import file_inventory


def write_dated(
    df: DataFrame, path: str, keys: list[str], file_format: str = "parquet", mode: str = "append"
) -> None:
    """Append or replace by partition.

    The rebalance hint groups rows by partition, so few files are written, and lets AQE split a date that holds
    most of the rows. `mode="overwrite"` replaces only the partitions present in `df`, which makes a re-run
    safe; "append" repeats its rows when run twice.
    """
    writer = df.hint("rebalance", *[F.col(k) for k in keys]).write.partitionBy(*keys).format(file_format)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.mode(mode).save(path)


def write_snapshot(
    df: DataFrame, path: str, mode: str = "overwrite", codec: str = "snappy", partitions: int | None = None
) -> None:
    out = df if partitions is None else df.repartition(partitions)
    out.write.mode(mode).option("compression", codec).parquet(path)


def write_by_key(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    """Snapshot with equal keys stored together; a hot key is split over several files."""
    df.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).option("compression", "snappy").parquet(path)


def write_clustered(df: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    """Range-clustered files sorted inside, without one global sort.

    A row hash follows the keys in the range, so that one key can span several tasks.
    """
    spread = df.withColumn("_spread", F.xxhash64(*df.columns))
    ranged = spread.repartitionByRange(*keys, "_spread").sortWithinPartitions(*keys).drop("_spread")
    ranged.write.mode(mode).parquet(path)


def overwrite_directory(spark: SparkSession, path: str, select: str, file_format: str = "JSON") -> None:
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING {file_format} {select}")


def compare_codecs(df: DataFrame, folder: str, codecs: tuple[str, ...] = ("snappy", "gzip", "zstd")) -> DataFrame:
    """Write once per codec, read back: codec, files, bytes, rows."""
    reports = []
    for codec in codecs:
        path = f"{folder}/{codec}"
        write_snapshot(df, path, codec=codec)
        back = df.sparkSession.read.schema(df.schema).parquet(path)
        reports.append(file_inventory(back).select(F.lit(codec).alias("codec"), "files", "bytes", "rows"))
    return reduce(DataFrame.unionByName, reports)


def reconcile_counts(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key on both sides, in one shuffle; keys missing on a side count 0."""
    def sided(df: DataFrame, is_source: int) -> DataFrame:
        return df.select(*keys, F.lit(is_source).alias("_s"), F.lit(1 - is_source).alias("_t"))

    counts = sided(source, 1).unionByName(sided(target, 0)).groupBy(*keys).agg(
        F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows")
    )
    return counts.withColumn("difference", F.col("target_rows") - F.col("source_rows"))
