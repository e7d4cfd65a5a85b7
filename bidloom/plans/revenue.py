"""Daily product revenue, as DataFrames and as SQL text with variables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.functions.fixed_point import money_sum
from bidloom.session import sql_variables
from bidloom.sources.sinks import overwrite_directory

ORDER = ("order_date", "revenue", "order_status", "product_id")


def daily_product_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue per day, status and product, best product first.

    orders: order_id, order_date, order_status. items: order_id, product_id, subtotal. Ties are ordered by status
    and product, which also spreads a busy day over the range partitions of the sort.
    """
    revenue = (
        items.join(orders, "order_id")
        .groupBy("order_date", "order_status", "product_id")
        .agg(money_sum(F.col("subtotal")).alias("revenue"))
    )
    day, amount, *rest = ORDER
    return revenue.orderBy(F.asc(day), F.desc(amount), *rest)


@contextmanager
def _database(spark: SparkSession, name: str | None) -> Iterator[None]:
    """The database, created if need be, as the current one; the former one afterwards."""
    before = spark.catalog.currentDatabase()
    if name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
        spark.sql(f"USE {name}")
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def script_from_json(
    spark: SparkSession, select: str, variables: dict[str, str], views: tuple[str, ...] = ("orders", "order_items"),
    database: str | None = None,
) -> None:
    """The script form: views over JSON folders, the result of `select` written as JSON.

    `variables` must give retail.in and retail.out; ${...} in the text is filled in by Spark.
    """
    with sql_variables(spark, variables), _database(spark, database):
        for view in views:
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY VIEW {view} USING JSON OPTIONS (path='${{retail.in}}/{view}')"
            )
        overwrite_directory(spark, "${retail.out}", select)
