import datetime as dt
import hashlib
import uuid
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bidloom.functions import fixed_point, scalars as s

TEXTS = st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=20)


@settings(max_examples=8, deadline=None)
@given(texts=TEXTS)
def test_hashes(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", s.sha256_hex("t").alias("h"), s.stable_uuid("t").alias("u")).collect():
        if r["t"] is None:
            assert r["h"] is None and r["u"] is None
        else:
            data = r["t"].encode()
            assert r["h"] == hashlib.sha256(data).hexdigest()
            assert r["u"] == str(uuid.UUID(bytes=hashlib.md5(data).digest()))


@settings(max_examples=8, deadline=None)
@given(seconds=st.lists(st.integers(-10**9, 4 * 10**9), min_size=1, max_size=20), minutes=st.sampled_from([1, 5, 15]))
def test_floor_minutes(spark, seconds, minutes):
    df = spark.createDataFrame([(x,) for x in seconds], "x bigint").withColumn("t", F.timestamp_seconds("x"))
    for r in df.select("x", F.unix_seconds(s.floor_minutes("t", minutes)).alias("f")).collect():
        assert r["f"] == r["x"] // (minutes * 60) * (minutes * 60)


def test_calendar_date_ignores_the_zone(spark):
    df = spark.createDataFrame([("2021-01-15T03:00:00Z",), ("nonsense",), (None,)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert [r[0] for r in df.select(s.calendar_date("t")).collect()] == [dt.date(2021, 1, 15), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bands_and_flags(spark):
    df = spark.createDataFrame([(0.75, True), (0.5, False), (0.25, None), (0.1, True), (None, True)], "v double, f boolean")
    rows = df.select(s.unit_score_band("v"), s.flag("f")).collect()
    assert [tuple(r) for r in rows] == [("very_high", 1), ("high", 0), ("medium", 0), ("low", 1), ("low", 1)]


def test_quality_and_price_bucket(spark):
    df = spark.createDataFrame([(True, 9.0), (False, 4.0), (None, 3.99), (False, 1.0)], "t boolean, p double")
    rows = df.select(s.quality_score("t", "p"), s.price_bucket("p")).collect()
    assert [tuple(r) for r in rows] == [(0.1, "premium"), (0.95, "premium"), (0.7, "standard"), (0.7, "low")]


def test_surrogate_keys_do_not_collide(spark):
    rows = [("a", "bc"), ("ab", "c"), ("a", None), (None, "a"), (None, None), ("", None), ("n", None), ("v1:a", None)]
    keys = spark.createDataFrame(rows, "a string, b string").select(s.surrogate_key("a", "b")).collect()
    assert len({r[0] for r in keys}) == len(rows)


def test_salt_survives_the_smallest_hash(spark):
    salts = spark.range(200_000).select(s.murmur_salt("id").alias("s"), s.portable_salt("id").alias("p"))
    r = salts.agg(F.min("s"), F.max("s"), F.min("p"), F.max("p")).first()
    assert tuple(r) == (0, 15, 0, 15)


def test_fixed_sums(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (-0.3,), (10.005,)], "v double")
    r = df.agg(fixed_point.money_sum(F.col("v")).alias("s"), fixed_point.mean(F.col("v")).alias("m")).first()
    assert r["s"] == 10.01 and abs(r["m"] - 10.005 / 4) < 1e-12


def test_sums_keep_every_place(spark):
    """More than four places: cut rows would sum to another value."""
    df = spark.createDataFrame([(0.00004999,)] * 1000 + [(0.0000000001,)], "v double")
    r = df.agg(fixed_point.money_sum(F.col("v")).alias("s"), fixed_point.mean(F.col("v")).alias("m")).first()
    assert r["s"] == 0.05 and abs(r["m"] - (0.04999 + 1e-10) / 1001) < 1e-17


@pytest.mark.parametrize("values, weights", [
    ([2e7, 2e7], [1, 1]), ([1e8, 3.0], [1, 1]), ([-5e7], [2]), ([1e9 + 0.5, -0.25, None], [3, 1, 4]), ([4e-9] * 7, [9] * 7),
])
def test_means_and_sums_are_exact_at_any_size(spark, values, weights):
    df = spark.createDataFrame(list(zip(values, weights)), "v double, w bigint")
    kept = [(Fraction(v), w) for v, w in zip(values, weights) if v is not None]
    total = sum(v * w for v, w in kept)
    r = df.agg(fixed_point.mean(F.col("v"), F.col("w")).alias("m"), fixed_point.money_sum(F.col("v") * F.col("w")).alias("s"),
               fixed_point.money_sum(F.col("v") * F.col("w"), 9).alias("s9"),
               F.expr(fixed_point.money_sum_sql("v * w", 9)).alias("q9")).first()
    assert r["m"] == pytest.approx(float(total / sum(w for _, w in kept)), rel=1e-15)
    assert r["s"] == float(round(total, 2)) and r["s9"] == r["q9"] == float(round(total, 9))


def test_a_million_small_rows(spark):
    df = spark.range(1_000_000).select(F.lit(4e-9).alias("v"))
    assert df.agg(fixed_point.money_sum(F.col("v"), 3)).first()[0] == 0.004


@pytest.mark.parametrize("value", [1e19, float("nan"), float("-inf")])
def test_values_without_an_exact_sum_raise(spark, value):
    with pytest.raises(Exception, match="exact sum"):
        spark.createDataFrame([(value,)], "v double").agg(fixed_point.mean(F.col("v"))).collect()
