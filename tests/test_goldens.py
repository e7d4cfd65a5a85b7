"""Recorded results of the tiny preset."""

from pyspark.sql import functions as F

from bidloom.operators import fanout
from bidloom.plans import contract, converters, enrichment
from bidloom.sources import synthetic


def metrics(df):
    return {r["name"]: r["value"] for r in df.collect()}


def test_counts(tiny_raw):
    assert metrics(contract.dataset_counts(tiny_raw)) == {
        "bids": 100_000, "impressions_feedback_same_hour": 59_500, "impressions_feedback_late_hour": 10_500,
        "impressions_feedback_total": 70_000, "contextual": 20_000, "matched_user_data": 20_000, "advertiser": 1_000,
        "koa_settings": 1_000, "feature_log": 50_000, "sib": 20_000,
    }


def test_overlaps(tiny_raw):
    found = metrics(contract.overlaps(tiny_raw))
    found.pop("bids_to_feature_log_user_context")
    assert found == {
        "bids_to_impressions_bid_request_id": 70_000, "bids_to_matched_user_data_bid_request_id": 20_000,
        "bids_to_advertiser_advertiser_id": 555, "bids_to_contextual_contextual_id": 13_035,
        "bids_to_feature_log_user_id_hash": 40_200, "bids_to_sib_user_id_hash": 16_200,
        "bids_to_koa_settings_advertiser_campaign": 555,
    }


def test_skew_indicators(tiny_raw):
    rows = {(r["indicator"], r["key"]): r["rows"] for r in contract.skew_indicators(tiny_raw.bids).collect()}
    assert rows["frequency_bracket", "high"] == 20_000
    assert rows["frequency_bracket", "low"] == 80_000
    assert len(rows) == 12


def test_converters(tiny_raw, tiny_job):
    assert metrics(converters.feature_metrics(tiny_raw.features, tiny_job.features)) == {
        "raw_feature_log_count": 50_000, "converted_feature_log_count": 50_000,
        "distinct_user_hash_count": 40_200, "distinct_contextual_count": 13_035,
    }
    assert metrics(converters.eligible_metrics(tiny_raw.eligible, tiny_job.eligible)) == {
        "raw_matched_user_data_count": 20_000, "converted_eligible_user_data_count": 20_000,
        "eligible_user_count": 5_000, "high_frequency_count": 4_000, "low_frequency_count": 16_000,
    }


def test_job(spark, tiny_job, tmp_path):
    found = metrics(enrichment.run_job(tiny_job, str(tmp_path / "final")))
    assert {k: v for k, v in found.items() if not k.startswith("source")} == {
        "joined_row_count": 1_080_000, "joined_impression_match_count": 756_000,
        "joined_eligible_user_match_count": 216_000, "joined_feature_log_match_count": 1_040_000,
        "joined_sib_match_count": 1_016_000, "high_frequency_joined_count": 1_000_000,
        "low_frequency_joined_count": 80_000, "final_output_count": 91_883,
    }
    assert found["source_impressions_count"] == 70_000 and found["source_sib_count"] == 16_200
    final = spark.read.parquet(str(tmp_path / "final"))
    assert {r["branch"]: r["count"] for r in final.groupBy("branch").count().collect()} == {
        "high_frequency_salted": 19_383, "low_frequency_hash": 72_500,
    }
    salts = final.filter("salt IS NOT NULL").groupBy("salt").count().orderBy("salt").collect()
    assert [r["count"] for r in salts] == [
        1215, 1240, 1203, 1230, 1153, 1201, 1310, 1200, 1156, 1204, 1205, 1169, 1217, 1241, 1205, 1234,
    ]


def test_weights_equal_the_written_out_join(tiny_job):
    """Exact counters and means, over more than a million joined rows."""
    weighted = enrichment.final_output(tiny_job)
    written_out = enrichment.final_output(tiny_job, written_out=True)
    assert weighted.exceptAll(written_out).isEmpty()
    assert written_out.exceptAll(weighted).isEmpty()


def test_averages_agree_with_sums_of_doubles(tiny_job):
    rows = enrichment.enrich(tiny_job)
    keys = ["advertiser_id", "campaign_id", "contextual_id", "content_category", "koa_group"]
    weight = F.col("joined_rows")
    plain = rows.filter(~F.col("is_high_frequency")).groupBy(*keys).agg(
        (F.sum(F.col("quality_weighted_price") * weight) / F.sum(F.when(
            F.col("quality_weighted_price").isNotNull(), weight).otherwise(0))).alias("plain"))
    exact = enrichment.low_frequency(rows)
    on = [F.col(f"p.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    off = plain.alias("p").join(exact.alias("f"), on).filter("abs(plain - avg_quality_weighted_price) > 1e-9")
    assert off.isEmpty()


def test_merged_salts_equal_the_unsalted_aggregate(tiny_job):
    rows = enrichment.enrich(tiny_job)
    merged = enrichment.merged_output(rows)
    unsalted = enrichment.high_frequency(rows, salt=F.lit(0)).select(*merged.columns)
    assert merged.count() == 10_000
    assert merged.exceptAll(unsalted).isEmpty() and unsalted.exceptAll(merged).isEmpty()


def test_conservation(tiny_job):
    row = enrichment.conservation(enrichment.enrich(tiny_job)).first()
    assert (row["joined"], row["high"], row["low"], row["unclassified"], row["missing"]) == (
        1_080_000, 1_000_000, 80_000, 0, 0)


def test_fanout_estimate(spark, tiny_raw):
    keys = ["user_id_hash", "contextual_id"]
    sizes = fanout.estimate(tiny_raw.bids, tiny_raw.features, keys, keys).first()
    assert sizes["left_rows"] == 100_000 and int(sizes["left_join_rows"]) == 1_080_000


def test_fanout_estimate_at_a_larger_preset(spark):
    """602.4 million joined rows, sized from key counts alone."""
    run = synthetic.Run(scale="lightmedium")
    keys = ["user_id", "contextual_id"]
    bids = synthetic.bids(spark.range(run.rows["bids"]), run)
    features = synthetic.features(spark.range(run.rows["features"]), run)
    assert int(fanout.estimate(bids, features, keys, keys).first()["left_join_rows"]) == 602_400_000


def test_split_hot_keys_give_the_same_output(tiny_job):
    """With every search for hot keys forced, and a low limit, the output stays the same."""
    rows = enrichment.enrich(tiny_job, hot_rows=100)
    assert "_piece" in rows._jdf.queryExecution().toString()
    assert {r["name"]: r["value"] for r in enrichment.joined_counts(rows).collect()}["joined_row_count"] == 1_080_000
    split, plain = (enrichment.low_frequency(r) for r in (rows, enrichment.enrich(tiny_job)))
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
