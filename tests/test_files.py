import gzip
import json

import pytest
from pyspark.sql import functions as F

from bidloom import session
from bidloom.plans import ingest, revenue
from bidloom.sources import files, sinks, synthetic


def landing(folder, days=("2021-01-13", "2021-01-14"), hours=2):
    n = 0
    for day in days:
        for hour in range(hours):
            rows = [{"id": n + i, "created_at": f"{day}T{hour:02d}:00:0{i}Z", "repo": {"id": i, "name": f"r{i}"}}
                    for i in range(3)]
            n += 3
            with gzip.open(folder / f"{day}-{hour}.json.gz", "wt") as out:
                out.writelines(json.dumps(r) + "\n" for r in rows)


def test_activity_ingest(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    landing(source)
    ingest.ingest(spark, str(source), "2021-01-13", target)
    ingest.ingest(spark, str(source), "2021-01-14", target)
    out = spark.read.parquet(target)
    assert out.count() == 12
    assert [tuple(r) for r in out.groupBy("year", "month", "dayofmonth").count().orderBy("dayofmonth").collect()] == [
        (2021, 1, 13, 6), (2021, 1, 14, 6)]
    back = sinks.reconcile_counts(ingest.with_date_parts(spark.read.json(str(source))), out, ingest.DATE_KEYS)
    assert back.filter("difference <> 0").isEmpty() and back.count() == 2
    # Appending a day again repeats it, replacing it does not.
    ingest.ingest(spark, str(source), "2021-01-14", target)
    assert spark.read.parquet(target).count() == 18
    ingest.ingest(spark, str(source), "2021-01-14", target, mode="overwrite")
    out = spark.read.parquet(target)
    assert out.count() == 12
    assert ingest.expand(out, "repo", F.col("id").alias("event")).columns == ["event", "id", "name"]
    counts = ingest.daily_counts(out, "created_at").orderBy("created_at").collect()
    assert [r["rows"] for r in counts] == [6, 6]


def test_hot_date_is_split_over_tasks(spark, tmp_path):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 200_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"),
                                                  F.expr("if(id % 10 = 0, id % 3, 7)").alias("day"))
        sinks.write_dated(df, str(tmp_path / "o"), ["day"])
        written = spark.read.parquet(str(tmp_path / "o"))
        hot = files.file_inventory(written.filter("day = 7")).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert hot["rows"] == 180_000 and hot["files"] > 4


def test_partition_scan_keeps_strings_and_prunes(spark, tmp_path):
    run = synthetic.Run()
    base = str(tmp_path)
    synthetic_bids = synthetic.impressions(spark.range(10), run), synthetic.impressions(spark.range(4), run, late=True)
    table = files.table_path(base, "raw", "impressions_feedback")
    for df, hour in zip(synthetic_bids, (run.hour, run.late_hour)):
        sinks.write_snapshot(df, files.partition_path(table, run.day, hour))
    one = files.scan_partitions(spark, table, run.day, (run.hour,))
    both = files.scan_partitions(spark, table, run.day, (run.hour, run.late_hour))
    assert (one.count(), both.count(), files.scan_partitions(spark, table).count()) == (10, 14, 14)
    assert {tuple(r) for r in both.select("year", "month", "day", "hour").distinct().collect()} == {
        ("2026", "05", "21", "10"), ("2026", "05", "21", "11")}


def test_write_run(spark, tmp_path):
    run = synthetic.Run()
    synthetic.write_run(spark, str(tmp_path), run)

    def scan(name, hours=(), hourly=True):
        return files.scan_partitions(spark, files.table_path(str(tmp_path), "raw", name), run.day, hours, hourly)

    assert scan("bids", (run.hour,)).count() == 100_000
    assert scan("impressions_feedback", (run.hour, run.late_hour)).count() == 70_000
    assert scan("impressions_feedback", (run.late_hour,)).count() == 10_500
    assert scan("sib", hourly=False).first()["month"] == "05"


def test_revenue_script(spark, tmp_path):
    orders = [(1, "2024-01-01 00:00:00.0", "COMPLETE"), (2, "2024-01-01 00:00:00.0", "CLOSED"), (3, "2024-01-02 00:00:00.0", "CLOSED")]
    items = [(1, 7, 10.25), (1, 7, 5.5), (2, 8, 99.99), (3, 9, 1.0), (4, 9, 50.0)]
    (tmp_path / "orders").mkdir()
    (tmp_path / "order_items").mkdir()
    (tmp_path / "orders" / "part-0").write_text("\n".join(json.dumps(
        {"order_id": a, "order_date": b, "order_status": c}) for a, b, c in orders))
    (tmp_path / "order_items" / "part-0").write_text("\n".join(json.dumps(
        {"order_item_order_id": a, "order_item_product_id": b, "order_item_subtotal": c}) for a, b, c in items))
    out = str(tmp_path / "out")
    select = """SELECT order_date, order_status, order_item_product_id, round(sum(order_item_subtotal), 2) AS revenue
                FROM order_items JOIN orders ON order_id = order_item_order_id GROUP BY ALL"""
    revenue.script_from_json(spark, select, {"retail.in": str(tmp_path), "retail.out": out}, database="retail_check")
    spark.sql("USE default")
    got = sorted(tuple(r) for r in spark.read.json(out).select(
        "order_date", "order_status", "order_item_product_id", "revenue").collect())
    assert got == [("2024-01-01 00:00:00.0", "CLOSED", 8, 99.99), ("2024-01-01 00:00:00.0", "COMPLETE", 7, 15.75),
                   ("2024-01-02 00:00:00.0", "CLOSED", 9, 1.0)]
    assert spark.conf.get("retail.in", None) is None


def test_json_view(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n{"x": 2}\n')
    files.json_view(spark, "some_json", str(tmp_path))
    assert spark.sql("SELECT sum(x) FROM some_json").first()[0] == 3


def test_codecs_and_clustering(spark, tmp_path):
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("k"), F.lit("same text").alias("t"))
    report = {r["codec"]: r for r in sinks.compare_codecs(df, str(tmp_path / "c")).collect()}
    assert set(report) == {"snappy", "gzip", "zstd"}
    assert all(r["rows"] == 20_000 and r["bytes"] > 0 for r in report.values())
    sinks.write_clustered(df, str(tmp_path / "k"), ["k"])
    assert spark.read.parquet(str(tmp_path / "k")).count() == 20_000
    sinks.write_by_key(df, str(tmp_path / "b"), ["k"])
    assert spark.read.parquet(str(tmp_path / "b")).count() == 20_000


def test_work_folder_prefers_the_shared_one(spark):
    assert session.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    df = spark.range(5)
    assert session.materialize(df, "t").count() == 5


def test_work_folder_falls_back_to_the_warehouse():
    class Unset:
        class conf:
            get = staticmethod(lambda name, *_: {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}.get(name))

    assert session.work_folder(Unset, "x").startswith("hdfs://store/warehouse/_work/x-")


@pytest.mark.parametrize("warehouse, master, shared", [
    ("file:/tmp/warehouse", "spark://host:7077", False), ("/data/warehouse", "yarn", False), ("file:/tmp/w", "local[4]", True)])
def test_a_folder_on_a_local_disk_is_refused_on_a_cluster(warehouse, master, shared):
    class Session:
        class conf:
            get = staticmethod(lambda name, *_: {"spark.sql.warehouse.dir": warehouse, "spark.master": master}.get(name))

    if shared:
        assert session.work_folder(Session, "x").startswith(warehouse)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.work_folder(Session, "x")
