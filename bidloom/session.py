"""What the library reads from the caller's session; it never changes the caller's settings."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach: under spark.checkpoint.dir, or else under the warehouse.

    Without spark.checkpoint.dir on a cluster the warehouse must be on a shared file system; a folder of the driver's
    own disk is refused, since executors would each write to their own. One machine (a local master) shares its disk.
    The caller's session owns what is written there. The library deletes nothing, because a returned DataFrame may
    still read it; clear the folder when the session's results have been stored.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir") + "/_work"
        if not _shared(spark, root):
            raise ValueError(
                f"no folder that all executors share: set spark.checkpoint.dir, or spark.sql.warehouse.dir to a shared "
                f"file system (it is {root})")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _shared(spark: SparkSession, path: str) -> bool:
    """Whether executors reach the path that the driver sees: not a local disk, unless all run in one process."""
    master = spark.conf.get("spark.master", "") or ""
    if master == "local" or master.startswith("local["):
        return True
    scheme, found, _ = path.partition(":")
    default = spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file:///"
    return (scheme if found else default.partition(":")[0]) != "file"


def materialize(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write once, read back: cuts lineage through a table that outlives any executor.

    The session's Parquet codec unless one is named: zstd halves hex digests, which snappy leaves as they are.
    """
    path = work_folder(df.sparkSession, purpose)
    writer = df.write.mode("errorifexists")
    (writer if codec is None else writer.option("compression", codec)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def sql_variables(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session variables for `${name}` in SQL text, restored afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
