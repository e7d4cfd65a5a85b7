import collections
import random

import pytest
from pyspark.sql import functions as F

from bidloom.operators import dedup, fanout, intervals, joins, nullable, quality, quantiles, salting, skew, sketches
from bidloom.plans import converters, remedies


def as_set(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_keep_extreme_is_deterministic(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "x"), (2, 1, "y"), (None, 1, "p"), (None, 2, "q")]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    assert as_set(dedup.keep_extreme(df, ["k"], ["o"])) == collections.Counter([(1, 5, "b"), (2, 1, "y"), (None, 2, "q")])
    assert as_set(dedup.keep_extreme(df, ["k"], ["o"], latest=False))[(1, 4, "z")] == 1
    assert dedup.keep_any(df, ["k"]).count() == 3


def test_keep_extreme_needs_no_window(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    assert "Window" not in dedup.keep_extreme(df, ["k"], ["id"])._jdf.queryExecution().toString()


@pytest.mark.parametrize("join", [nullable.null_safe_left, nullable.surrogate_left, nullable.split_null_left])
@pytest.mark.parametrize("limits", [{}, {"hot_rows": 1}])
def test_nullable_lookups(spark, join, limits):
    left = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "a", "b"), (4, "c", "d"), (5, None, "b")],
                                 "i int, a string, b string")
    right = spark.createDataFrame([("a", None, 10), (None, None, 20), ("a", "b", 30), ("a", "b", 31)],
                                  "x string, y string, v int")
    left = left.unionByName(left)
    got = as_set(join(left, right, [("a", "x"), ("b", "y")], ["i"], **limits).select("i", "v"))
    assert got == collections.Counter([(1, 10), (2, 20), (3, 30), (3, 31), (4, None), (5, None)] * 2)


@pytest.mark.parametrize("seconds", [1, 7, 60])
@pytest.mark.parametrize("limits", [{}, {"hot_rows": 1}])
def test_count_within_against_brute_force(spark, seconds, limits):
    rng = random.Random(seconds)
    # User 0 holds most of both sides.
    def moment():
        return rng.randrange(-200, 1200) * 250_000 + rng.choice([0, 0, -1, 1])

    left = [(i, 0 if rng.random() < 0.6 else rng.randrange(4), moment()) for i in range(150)]
    right = [(0 if rng.random() < 0.6 else rng.randrange(4), moment()) for _ in range(250)] + [(None, 5)]
    width = seconds * 1_000_000
    want = {i: sum(u2 == u and t - width <= t2 <= t for u2, t2 in right) for i, u, t in left}
    got = intervals.count_within(
        spark.createDataFrame(left, "i int, u int, at bigint"), spark.createDataFrame(right, "u int, at2 bigint"),
        ["u"], "at", "at2", seconds, ["i"], **limits)
    assert {r["i"]: r["matches"] for r in got.collect()} == want


def test_broadcast_only_when_measured_small(spark):
    small = spark.range(100).withColumn("name", F.concat(F.lit("n"), "id"))
    assert "broadcast" in joins.broadcast_if_small(small)._jdf.queryExecution().toString()
    assert "broadcast" not in joins.broadcast_if_small(small, limit=100)._jdf.queryExecution().toString()
    # Under the planner's estimate but wide in memory.
    wide = spark.range(1000).withColumn("text", F.repeat(F.lit("x"), 10_000))
    assert joins.measured_bytes(wide) > 10_000_000
    assert "broadcast" not in joins.broadcast_if_small(wide, limit=1_000_000)._jdf.queryExecution().toString()


def test_lookup_is_the_same_either_way(spark):
    left = spark.range(50).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert as_set(joins.lookup(left, right, ["k"])) == as_set(joins.lookup(left, right, ["k"], limit=0))


def test_fanout_estimate_equals_the_join(spark):
    left = spark.range(300).select(F.expr("if(id % 3 = 0, 0, id % 17)").alias("a"), "id")
    right = spark.range(200).select(F.expr("if(id % 3 = 0, 0, nullif(id % 11, 5))").alias("b"))
    sizes = fanout.estimate(left, right, ["a"], ["b"]).first()
    cond = left["a"] == right["b"]
    assert int(sizes["left_join_rows"]) == left.join(right, cond, "left").count()
    assert int(sizes["inner_rows"]) == left.join(right, cond).count()
    top = fanout.largest_keys(left, right, ["a"], ["b"], 1).first()
    assert top["key_0"] == 0 and int(top["join_rows"]) == top["left_rows"] * top["right_rows"]


def test_fanout_products_pass_the_range_of_a_long(spark):
    counts = spark.sql("SELECT 4000000000000000000 AS rows_per_key UNION ALL SELECT 4000000000000000000 "
                       "UNION ALL SELECT 4000000000000000000")
    assert int(fanout.value_profile(counts, "rows_per_key").first()["rows"]) == 12 * 10**18


def test_value_profile(spark):
    df = spark.createDataFrame([(v,) for v in (1, 1, 2, 3, 10)], "v bigint")
    r = fanout.value_profile(df, "v").first()
    assert (r["keys"], int(r["rows"]), r["avg"], r["p50"], int(r["max"])) == (5, 17, 3.4, 2.0, 10)


def test_remedies(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    right = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), (None, 9, 90)], "k2 string, t int, v int")
    latest = remedies.join_latest(left, right, [("k", "k2")], ["t"], ["i"]).select("i", "v")
    assert as_set(latest) == collections.Counter([(1, 20), (2, None), (3, None)])
    total = remedies.join_summary(left, right, [("k", "k2")], [F.sum("v").alias("s")], ["i"]).select("i", "s")
    assert as_set(total) == collections.Counter([(1, 30), (2, None), (3, None)])
    assert remedies.only_named(right, "k2", ["a"]).count() == 2


def test_quality_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, v int")
    assert as_set(quality.duplicate_keys(df, ["k", "v"])) == collections.Counter([("a", 1, 2)])
    assert {r["column_name"]: r["null_rate"] for r in quality.null_rates(df).collect()} == {"k": 0.25, "v": 0.25}
    assert df.agg(quality.distinct_rows("k").alias("n")).first()["n"] == 3
    assert quality.key_overlap(df, df, [("k", "k")], "x").first()["value"] == 2
    profile = quality.join_key_profile({"t": (df, "k")}).first()
    assert (profile["rows"], profile["distinct_keys"], profile["null_keys"]) == (4, 2, 1)
    top = quality.hot_keys(df, "k", 1, default="a").first()
    assert (top["k"], top["rows"], top["share"], top["is_null_or_default"]) == ("a", 2, 0.5, True)
    assert quality.null_rates(df.limit(0)).first()["null_rate"] is None


def test_key_overlaps_equal_single_checks(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (None, "c"), (1, "b")], "i bigint, s string")
    right = spark.createDataFrame([(2, "b"), (2, "z"), (None, None), (1, "q")], "j bigint, t string")
    checks = [("one", right, [("i", "j")]), ("both", right, [("i", "j"), ("s", "t")]), ("text", right, [("s", "t")]),
              ("again", right.filter("j = 2"), [("i", "j")])]
    got = {r["name"]: r["value"] for r in quality.key_overlaps(left, checks).collect()}
    want = {n: quality.key_overlap(left, r, pairs, n).first()["value"] for n, r, pairs in checks}
    assert got == want == {"one": 2, "both": 1, "text": 1, "again": 1}


def test_run_comparison(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "i int, s string")
    assert as_set(quality.run_diff(a, b)) == collections.Counter([(1, "x", "only_before", 1), (3, "y", "only_after", 1)])
    assert quality.run_diff(a, a).isEmpty()
    old = spark.createDataFrame([("s", "m", 10), ("s", "gone", 1)], quality.METRIC_SCHEMA)
    new = spark.createDataFrame([("s", "m", 15)], quality.METRIC_SCHEMA)
    rows = {r["name"]: r for r in quality.compare_runs(old, new).collect()}
    assert rows["m"]["change"] == 5 and rows["m"]["percent"] == 50.0 and rows["gone"]["after"] is None


def test_require_rows(spark):
    assert quality.require_rows(spark.range(3), "t").first()["rows"] == 3
    with pytest.raises(Exception, match="t is empty"):
        quality.require_rows(spark.range(0), "t").collect()


def test_task_diagnosis(spark):
    tasks = spark.createDataFrame([("s", 100, 5)] * 9 + [("s", 600, 400)] + [("t", 10, 0)] * 3,
                                  "stage string, ms bigint, gc bigint")
    skew = {r["stage"]: r for r in quality.task_skew(tasks, "stage", "ms").collect()}
    assert (skew["s"]["median_ms"], skew["s"]["skew_class"], skew["t"]["skew_class"]) == (100.0, "likely", "ok")
    gc = {r["stage"]: r["gc_class"] for r in quality.gc_pressure(tasks, "stage", "ms", "gc").collect()}
    assert gc == {"s": "pressure", "t": "ok"}


def test_task_waves_worked_case(spark):
    tasks = spark.range(200).select(F.lit("s").alias("stage"), F.lit(4000).cast("bigint").alias("ms"))
    r = quality.task_waves(tasks, "stage", "ms", slots=12).first()
    assert (r["waves"], r["expected_ms"]) == (17, 68_000.0)


def test_register_merge(spark):
    df = spark.createDataFrame([("a", [1, 5, 2]), ("a", [3, 1, 2]), ("b", [0, 0, 9])], "k string, r array<bigint>")
    assert {r["k"]: r["r"] for r in sketches.merge_registers(df, "k", "r").collect()} == {"a": [3, 5, 2], "b": [0, 0, 9]}


def test_merged_sketches_are_close(spark):
    df = spark.range(50_000).select((F.col("id") % 5).alias("day"), F.lit("x").alias("k"), (F.col("id") % 20_000).alias("u"))
    merged = sketches.merge_sketches(sketches.distinct_sketches(df, ["k", "day"], "u"), ["k"])
    assert abs(merged.first()["distinct_estimate"] - 20_000) < 1_000


def test_salted_key(spark):
    row = salting.with_salt(spark.createDataFrame([("u",)], "u string"), "u").select("salt", salting.salted_key("u")).first()
    assert row[1] == f"u#{row[0]}"


@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_keys_are_split_and_the_join_is_the_same(spark, null_safe):
    left = spark.range(0, 30_000, 1, 8).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 500 END").cast("bigint").alias("k"), "id")
    right = spark.range(400).select(F.expr("nullif(id, 399)").alias("k2"), (F.col("id") * 3).alias("v"))
    hot = skew.find(left, {"k": ["k"]}, hot_rows=500)["k"]
    assert len(hot.pieces) == 2 and max(hot.pieces.values()) == 21
    plain = skew.left_join(left, right, [("k", "k2")], skew.HotKeys({}), ["id"], null_safe)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = skew.left_join(left, right, [("k", "k2")], hot, ["id"], null_safe)
        assert split.columns == plain.columns
        tasks = split.filter("k = 7").select(F.spark_partition_id()).distinct().count()
        assert tasks > 4
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_keys_of_different_types_are_refused(spark):
    left, right = spark.range(3).selectExpr("cast(id as int) AS k"), spark.range(3).selectExpr("id AS k2")
    with pytest.raises(TypeError, match="k and k2"):
        skew.left_join(left, right, [("k", "k2")], skew.HotKeys({}), ["k"])


def test_late_feedback_counts_each_type_in_its_own_hour(spark):
    same = spark.createDataFrame([("same_hour",), ("same_hour",), ("late_n_plus_1",)], "t string")
    late = spark.createDataFrame([("late_n_plus_1",), ("same_hour",)], "t string")
    found = {r["name"]: r["value"] for r in quality.late_feedback(same, late, "t").collect()}
    assert found == {"same_hour_rows": 2, "late_n_plus_1_rows": 1}


def test_the_last_merge_reads_a_fixed_number_of_sketches(spark):
    many = spark.range(0, 3000, 1, 300).withColumn("k", F.col("id") % 3)
    assert skew.group_sketches(many, {"k": ["k"]}).count() == skew.GROUPS
    assert len(skew.find(many, {"k": ["k"]}, hot_rows=500)["k"].pieces) == 3
    assert skew.find(many, {"k": ["k"]}, hot_rows=1001)["k"].pieces == {}
    assert skew.find(many.limit(0), {"k": ["k"]})["k"].pieces == {}


def test_latest_within_against_brute_force(spark):
    rng = random.Random(8)
    left = [(i, rng.randrange(3), rng.randrange(0, 40_000_000, 500_000)) for i in range(120)]
    right = [(rng.randrange(3), rng.randrange(0, 40_000_000, 500_000), rng.randrange(5)) for _ in range(60)] + [(None, 1, 1)]
    want = {i: max(((t2, v) for u2, t2, v in right if u2 == u and t - 2_000_000 <= t2 <= t), default=(None, None))
            for i, u, t in left}
    got = intervals.latest_within(
        spark.createDataFrame(left, "i int, u int, at bigint"), spark.createDataFrame(right, "u int, at2 bigint, v int"),
        ["u"], "at", "at2", 2, ["i"])
    assert {r["i"]: (r["at2"], r["v"]) for r in got.collect()} == want


@pytest.mark.parametrize("buckets", [2, 16, 1024])
def test_quantiles_are_those_of_the_written_out_rows(spark, buckets):
    """Narrow, wide, hot and equal values; nulls and copies of zero are skipped."""
    rng = random.Random(buckets)
    for values in ([(7, 1)], [(3, 2), (3, 5)], [(0, 900), (10**15, 3), (10**15 + 1, 2)],
                   [(rng.randrange(10 ** rng.randrange(1, 12)), rng.randrange(4)) for _ in range(200)] + [(None, 5)]):
        df = spark.createDataFrame(values, "v bigint, n bigint")
        want = df.filter("v IS NOT NULL AND n > 0").agg(*[F.percentile(F.col("v").cast("double"), F.lit(p), F.col("n"))
                                                         for p in (0.0, 0.5, 0.75, 0.95, 1.0)]).first()
        got = quantiles.exact_quantiles(df, "v", "n", (0.0, 0.5, 0.75, 0.95, 1.0), buckets)
        assert got == pytest.approx(list(want), rel=1e-12)
    assert quantiles.exact_quantiles(spark.createDataFrame([], "v bigint, n bigint"), "v", "n", (0.5,)) == [None]


def test_an_output_is_audited_before_it_is_published(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, v string")
    assert quality.audited(rows, "out", ["k"]).count() == 2
    assert tuple(quality.audit(rows, "out", ["k"]).first()) == ("out", 2, 0, 1)
    with pytest.raises(quality.AuditError, match="empty"):
        quality.audited(rows.limit(0), "out", ["k"])
    with pytest.raises(quality.AuditError, match="1 keys more than once"):
        quality.audited(rows.unionByName(rows.filter("k IS NULL")), "out", ["k"])


def test_a_refused_output_leaves_the_target_alone(spark, tmp_path, tiny):
    target = str(tmp_path / "features")
    converters.run_features(tiny["feature_log"], target)
    before = spark.read.parquet(target).count()
    with pytest.raises(quality.AuditError):
        converters.run_features(tiny["feature_log"].limit(0), target)
    assert spark.read.parquet(target).count() == before > 0


def test_a_large_dimension_spreads_hot_keys(spark):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)] + [(None, -1)], "k bigint, id bigint")
    dimension = spark.createDataFrame([(i, f"d{i}") for i in range(100)], "k bigint, name string")
    small = skew.lookup(left, dimension, ["k"], None, ["id"])
    spread = skew.lookup(left, dimension, ["k"], None, ["id"], limit=0, hot_rows=10)
    assert "_piece" in spread._jdf.queryExecution().toString() and small.columns == spread.columns
    assert as_set(small) == as_set(spread)


def test_overlap_estimates_hold(spark):
    left = spark.range(40_000).selectExpr("id AS a", "id % 7 AS b").unionByName(spark.createDataFrame([(None, 1)], "a bigint, b bigint"))
    right = spark.range(30_000, 60_000).selectExpr("CAST(id AS int) AS x", "id % 7 AS y")
    checks = [("one", right, [("a", "x")]), ("two", right, [("a", "x"), ("b", "y")])]
    exact = {r["name"]: r["value"] for r in quality.key_overlaps(left, checks).collect()}
    assert exact == {"one": 10_000, "two": 10_000}
    assert "Expand" not in quality.key_overlaps(left, checks)._jdf.queryExecution().toString()
    for r in quality.overlap_estimates(left, checks).collect():
        assert abs(r["estimate"] - exact[r["name"]]) <= r["error"] < 3000


def test_joins_on_one_key_shuffle_the_left_rows_once_and_without_the_computed_key(spark):
    left = spark.range(0, 6000, 1, 4).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'u7' WHEN id % 10 = 1 THEN NULL ELSE concat('u', id % 90) END").alias("u"), "id")
    users = spark.range(80).select(F.sha2(F.concat(F.lit("u"), "id"), 256).alias("h"), (F.col("id") * 3).alias("v"))
    sides = [(users, [("hash", "h")]), (users.toDF("h2", "w"), [("hash", "h2")])]
    hashed = left.withColumn("hash", F.sha2("u", 256))
    wanted = hashed.join(users, hashed["hash"] == users["h"], "left").selectExpr("u", "id", "v", "v AS w")
    computed = {"hash": F.sha2("u", 256)}
    for hot in (skew.HotKeys({}), skew.find(hashed, {"k": ["hash"]}, hot_rows=500)["k"]):
        several = skew.left_joins(left, sides, hot, ["id"], computed)
        one = skew.left_join(left, users, [("hash", "h")], hot, ["id"], computed=computed)
        assert as_set(several.select("u", "id", "v", "w")) == as_set(wanted)
        assert as_set(one.select("u", "id", "v")) == as_set(wanted.drop("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = skew.left_joins(left, sides, skew.HotKeys({}), ["id"], computed)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="same left keys"):
        skew.left_joins(left, [sides[0], (users, [("id", "v")])], skew.HotKeys({}), ["id"], computed)


def test_needed_columns_leave_out_only_later_tie_breakers(spark):
    df = spark.createDataFrame([(1, 5, "a", 9, "z"), (1, 5, "b", 1, "x"), (1, 5, "b", 1, "y"), (2, None, "c", 2, "w")],
                               "k int, o int, v string, n int, last string")
    whole, part = dedup.keep_extreme(df, ["k"], ["o"]), dedup.keep_extreme(df, ["k"], ["o"], needed=["k", "v", "n"])
    assert as_set(part) == as_set(whole.select("k", "v", "n"))
    assert "last" not in part._jdf.queryExecution().optimizedPlan().toString().partition("LogicalRDD")[0]
