"""Times the headline queries and the synthetic presets; prints one JSON line.

BENCH_SF_DIR   given tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_PRESETS  presets of the ad-event job to run end to end from Parquet (default "tiny,lightmedium,medium", "" for none)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from dataclasses import replace

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from bidloom.plans import converters, enrichment  # noqa: E402
from bidloom.plans.enrichment import Inputs  # noqa: E402
from bidloom.registry import roles  # noqa: E402
from bidloom.registry.catalog import QUERIES  # noqa: E402
from bidloom.sources import synthetic  # noqa: E402
from bidloom.sources.files import scan_partitions, table_path  # noqa: E402

HEADLINE = [
    "daily_product_revenue", "daily_revenue_param", "ingest_partitioned", "feature_convert", "eligible_convert",
    "prepare_bids", "dedup_latest", "wide_enrich", "enrichment_final", "low_freq_agg", "high_freq_salted_agg",
    "salt_merge_agg", "feature_fanout_join", "feature_interval_join", "join_fanout_estimate", "key_skew_profile",
    "key_overlap", "skew_indicators", "join_match_rates", "run_diff", "clustered_write", "register_merge",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def raw_tables(spark, base: str, run: synthetic.Run) -> Inputs:
    def read(name: str, hours=None, hourly=True):
        return scan_partitions(spark, table_path(base, "raw", name), run.day, hours or (), hourly)

    hour = (run.hour,)
    return Inputs(
        bids=read("bids", hour), impressions_same=read("impressions_feedback", hour),
        impressions_late=read("impressions_feedback", (run.late_hour,)), contextual=read("contextual", hour),
        advertiser=read("advertiser", hourly=False), settings=read("koa_settings", hourly=False),
        eligible=read("matched_user_data", hour), features=read("feature_log", hour),
        sib=read("sib", hourly=False),
    )


def preset(spark, folder: str, scale: str) -> dict[str, float]:
    """Both converters and the main job of one preset, each reading Parquet and writing Parquet."""
    run = synthetic.Run(scale=scale)
    base = f"{folder}/{scale}"
    synthetic.write_run(spark, base, run)
    raw = raw_tables(spark, base, run)
    done = {}
    paths = {n: f"{base}/converted/{n}" for n in ("feature_log", "eligible_user_data")}
    done[f"preset_{scale}_feature_converter"] = timed(
        lambda: converters.run_features(raw.features, paths["feature_log"]).collect())
    done[f"preset_{scale}_eligible_converter"] = timed(
        lambda: converters.run_eligible(raw.eligible, paths["eligible_user_data"]).collect())
    inputs = replace(raw, features=spark.read.parquet(paths["feature_log"]),
                     eligible=spark.read.parquet(paths["eligible_user_data"]))
    # The whole job as published: source counts, join counts, output, its count.
    done[f"preset_{scale}_main_job"] = timed(lambda: enrichment.run_job(inputs, f"{base}/final").collect())
    return done


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE[:2]:
        consume(QUERIES[name](spark, sf_dir))
    times = {name: timed(lambda q=QUERIES[name]: consume(q(spark, sf_dir))) for name in HEADLINE}
    # The written-out join, for comparison with enrichment_final.
    written_out = lambda: consume(enrichment.final_output(roles.job_inputs(spark, sf_dir), written_out=True))
    times["enrichment_final_written_out"] = timed(written_out)
    for scale in filter(None, os.environ.get("BENCH_PRESETS", "tiny,lightmedium,medium").split(",")):
        times.update(preset(spark, scratch, scale))
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
