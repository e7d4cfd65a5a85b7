"""Four bids through the whole job."""

import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bidloom.operators import quality
from bidloom.plans import converters, enrichment
from bidloom.plans.enrichment import Inputs

T0 = dt.datetime(2026, 5, 21, 10, 2, 3)
PARTS = ("2026", "05", "21", "10")
PART_DDL = "year string, month string, day string, hour string"


@pytest.fixture(scope="module")
def job(spark):
    def frame(rows, ddl, parts=PARTS):
        return spark.createDataFrame([(*r, *parts) for r in rows], f"{ddl}, {PART_DDL}" if parts else ddl)

    bids = frame(
        [("br_1", "userA", 1, 100, 10, T0, 2.0, "d", "g", 1, "high", False, "h"),
         ("br_2", "UserA ", 1, 100, 10, T0, 3.0, "d", "g", 1, "high", False, "h"),
         ("br_3", "userB", 2, 200, 20, T0, 1.0, "d", "g", 1, "low", False, "h"),
         ("br_4", "userC", 2, 200, 20, T0, 5.0, "d", "g", 1, "low", False, "h")],
        "bid_request_id string, user_id string, advertiser_id bigint, campaign_id bigint, contextual_id bigint, "
        "bid_timestamp timestamp, bid_price double, device_type string, geo_id string, daily_user_freq int, "
        "frequency_bracket string, is_test_bid boolean, user_id_hash string")
    feedback = ("impression_id string, bid_request_id string, feedback_timestamp timestamp, is_billable boolean, "
                "clearing_price double, feedback_type string")
    features = frame(
        [("f1", "userA", 10, "x", 0.8, T0, "h"), ("f2", "userA", 10, "y", 0.1, T0, "h"),
         ("f3", "userB", 20, "x", 0.3, T0, "h"), ("f3", "userB", 20, "x", 0.3, T0, "h")],
        "feature_event_id string, user_id string, contextual_id bigint, feature_name string, feature_value double, "
        "event_timestamp timestamp, user_id_hash string")
    matched = frame([("br_1", "userA", "s1", True, 80, "h")],
                    "bid_request_id string, user_id string, segment_id string, is_eligible boolean, "
                    "eligibility_score int, user_id_hash string")
    return Inputs(
        bids=bids,
        impressions_same=frame([("i1", "br_1", T0, True, 1.0, "same_hour")], feedback, ()),
        impressions_late=frame([("i3", "br_3", T0, True, 0.5, "late_n_plus_1")], feedback, ()),
        contextual=frame([(10, "d10", "news", True, 0.5), (20, "d20", "sport", False, 0.2)],
                         "contextual_id bigint, domain string, content_category string, is_hot_context boolean, "
                         "context_score double", ()),
        advertiser=frame([(1, "a", "v", "high", True), (2, "b", "v", "standard", True)],
                         "advertiser_id bigint, advertiser_name string, vertical string, priority_tier string, "
                         "is_active boolean", ()),
        settings=frame([(1, 100, "k1", 1.1, "strict"), (2, 200, "k2", 0.9, "normal")],
                       "advertiser_id bigint, campaign_id bigint, koa_group string, bid_modifier double, "
                       "policy_mode string", ()),
        eligible=converters.convert_eligible(matched),
        features=converters.convert_features(features),
        sib=frame([("userA", "g1", 0.5, "current", "h")],
                  "user_id string, sib_group string, sib_score double, sib_source string, user_id_hash string", ()),
    )


def test_prices(job):
    rows = enrichment.enrich(job).select("bid_request_id", "quality_weighted_price").collect()
    assert {r[0]: round(r[1], 6) for r in rows} == {"br_1": 1.54, "br_2": 2.31, "br_3": 0.63, "br_4": 4.275}


@pytest.mark.parametrize("written_out", [False, True])
def test_joined_rows(job, written_out):
    rows = enrichment.enrich(job, written_out).groupBy("bid_request_id").agg({"joined_rows": "sum", "feature_events": "sum"})
    assert {r[0]: (r["sum(joined_rows)"], r["sum(feature_events)"]) for r in rows.collect()} == {
        "br_1": (2, 2), "br_2": (2, 2), "br_3": (1, 1), "br_4": (1, 0)}


def test_eligible_bracket_wins_over_the_bid(job):
    rows = enrichment.enrich(job).select("bid_request_id", "final_frequency_bracket").collect()
    assert dict(rows) == {"br_1": "low", "br_2": "high", "br_3": "low", "br_4": "low"}


def test_output(job):
    out = {(r["branch"], r["advertiser_id"]): r for r in enrichment.final_output(job).collect()}
    low = out["low_frequency_hash", 2]
    assert (low["event_count"], low["bid_count"], low["impression_count"], low["feature_event_count"]) == (2, 2, 1, 1)
    assert low["avg_bid_price"] == pytest.approx(3.0) and low["avg_clearing_price"] == pytest.approx(0.5)
    assert low["salt"] is None and low["avg_sib_score"] is None
    high = out["high_frequency_salted", 1]
    assert (high["event_count"], high["bid_count"]) == (2, 1) and 0 <= high["salt"] < 16
    matched = out["low_frequency_hash", 1]
    assert matched["eligible_user_count"] == 2


def test_null_bracket_joins_neither_branch(job):
    from dataclasses import replace

    from pyspark.sql import functions as F

    bids = job.bids.withColumn("frequency_bracket", F.expr("nullif(frequency_bracket, 'low')"))
    rows = enrichment.enrich(replace(job, bids=bids))
    row = enrichment.conservation(rows).first()
    assert (row["joined"], row["high"], row["low"], row["unclassified"], row["missing"]) == (6, 2, 2, 2, 0)


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_bids_with_several_eligible_users_keep_their_own(job, spark, hot_rows):
    """br_1 has two eligible users, br_2 one that is not its own, br_3 its own one; a row without a bid matches nothing."""
    matched = spark.createDataFrame(
        [("br_1", "userA", "s1", True, 80, "h", *PARTS), ("br_1", "userB", "s2", False, 10, "h", *PARTS),
         ("br_2", "userC", "s3", True, 50, "h", *PARTS), ("br_3", "userB", "s4", True, 30, "h", *PARTS),
         (None, "userC", "s5", True, 30, "h", *PARTS)], converters_ddl())
    rows = enrichment.enrich(replace(job, eligible=converters.convert_eligible(matched)), hot_rows=hot_rows)
    found = {r[0]: r[1:] for r in rows.select("bid_request_id", "segment_id", "eligible_user_flag", "impression_id").collect()}
    assert found == {"br_1": ("s1", 1, "i1"), "br_2": (None, None, None), "br_3": ("s4", 1, "i3"), "br_4": (None, None, None)}


def test_no_shuffle_of_the_bids_carries_the_users_hash(job):
    plan = enrichment.enrich(job)._jdf.queryExecution().optimizedPlan()
    shuffled = [n for n in str(plan).splitlines() if "RepartitionByExpression" in n]
    assert len(shuffled) == 2
    walk, bids = [plan], []
    while walk:
        node = walk.pop()
        if node.nodeName() == "RepartitionByExpression":
            bids.append([c.name() for c in _listed(node.output())])
        walk += _listed(node.children())
    assert len(bids) == 2 and not any("user_id_hash" in names for names in bids)


def _same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_groups_and_contexts_dealt_to_parts_give_the_same_output(job, spark):
    """Every group and user counts as too large for one task; a setting and a context that come twice repeat their bids."""
    twice = replace(job, settings=job.settings.unionByName(job.settings).unionByName(
        spark.createDataFrame([(1, 100, "k3", 1.1, "strict")], job.settings.schema)),
        contextual=job.contextual.unionByName(job.contextual.limit(1)),
        bids=job.bids.unionByName(job.bids.filter("bid_request_id = 'br_1'")))
    for inputs in (job, twice):
        written_out = enrichment.final_output(inputs, written_out=True, salt=F.lit(1))
        assert _same(enrichment.final_output(inputs, salt=F.lit(1)), written_out)
        rows = enrichment.enrich(inputs, hot_rows=1, for_groups=True, wide_rows=1)
        assert enrichment.PIECE in rows.columns and "_feature_part" in rows._jdf.queryExecution().toString()
        assert _same(enrichment._aggregate(enrichment._with_branch(rows, F.lit(1)), dealt=True), written_out)
        assert _same(enrichment.low_frequency(enrichment.enrich(inputs, hot_rows=1, wide_rows=1)),
                     written_out.filter("salt IS NULL"))
        merged = enrichment.merged_output(enrichment.enrich(inputs, hot_rows=1), F.lit(1))
        assert _same(merged, written_out.filter("salt = 1").select(*merged.columns))


def test_the_job_writes_groups_and_no_bids(job, spark, tmp_path):
    """The metrics of bids in neither branch come from groups that are written, and not published."""
    job = replace(job, bids=job.bids.withColumns({
        "frequency_bracket": F.expr("nullif(frequency_bracket, 'low')"),
        "bid_price": F.expr("if(frequency_bracket = 'low', double('NaN'), bid_price)")}))
    kept = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(kept.iterdir())
    found = {r["name"]: r["value"] for r in enrichment.run_job(job, str(tmp_path / "final")).collect()}
    written = set(kept.iterdir()) - before
    assert [p.name.partition("-")[0] for p in written] == ["groups"]
    assert all(".zstd." in f.name for p in written for f in p.glob("*.parquet"))
    counted = {r["name"]: r["value"] for r in enrichment.joined_counts(enrichment.enrich(job)).collect()}
    assert counted == {name: found[name] for name in counted} and counted["joined_row_count"] == 6
    assert found["final_output_count"] == spark.read.parquet(str(tmp_path / "final")).count() == 2
    assert _same(spark.read.parquet(str(tmp_path / "final")), enrichment.final_output(job))


def test_a_job_without_bids_of_a_branch_publishes_nothing(job, tmp_path):
    job = replace(job, bids=job.bids.withColumn("frequency_bracket", F.lit(None).cast("string")),
                  eligible=job.eligible.limit(0))
    with pytest.raises(quality.AuditError, match="final_output is empty"):
        enrichment.run_job(job, str(tmp_path / "final"))
    assert not (tmp_path / "final").exists()


def _listed(seq):
    return [seq.apply(i) for i in range(seq.size())]


def converters_ddl():
    return ("bid_request_id string, user_id string, segment_id string, is_eligible boolean, eligibility_score int, "
            f"user_id_hash string, {PART_DDL}")
