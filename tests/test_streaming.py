import datetime as dt

from pyspark.sql import functions as F

from bidloom.streaming import late_feedback

T0 = dt.datetime(2026, 5, 21, 10)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_feedback_stream_gives_the_batch_result(spark, tmp_path):
    bid_ddl = "bid_request_id string, bid_timestamp timestamp"
    feedback_ddl = ("impression_id string, bid_request_id string, feedback_timestamp timestamp, clearing_price double, "
                    "feedback_type string")
    bids, feedback = str(tmp_path / "bids"), str(tmp_path / "feedback")

    def arrive(bid_rows, feedback_rows):
        spark.createDataFrame(bid_rows, bid_ddl).coalesce(1).write.mode("append").parquet(bids)
        spark.createDataFrame(feedback_rows, feedback_ddl).coalesce(1).write.mode("append").parquet(feedback)

    def run():
        joined = late_feedback.join_feedback(
            spark.readStream.schema(bid_ddl).parquet(bids), spark.readStream.schema(feedback_ddl).parquet(feedback))
        late_feedback.run_available(joined, str(tmp_path / "out"), str(tmp_path / "state"))

    arrive([("a", minutes(0)), ("b", minutes(1)), ("c", minutes(2))],
           [("i1", "a", minutes(5), 1.0, "same_hour"), ("i1", "a", minutes(5), 1.0, "same_hour")])
    run()
    # The late hour, and a bid far ahead that closes the window of the first ones.
    arrive([("z", minutes(60 * 24))], [("i2", "b", minutes(70), 2.0, "late_n_plus_1"),
                                       ("i9", "z", minutes(60 * 24), 3.0, "same_hour")])
    run()
    arrive([("y", minutes(60 * 48))], [("i8", "y", minutes(60 * 48), 3.0, "same_hour")])
    run()
    out = spark.read.parquet(str(tmp_path / "out")).filter(F.col("bid_request_id").isin("a", "b", "c"))
    got = {r["bid_request_id"]: r["impression_id"] for r in out.collect()}
    assert out.count() == 3 and got == {"a": "i1", "b": "i2", "c": None}


def test_latest_feedback_is_the_batch_survivor(spark, tmp_path):
    """Feedback in several runs, ties, repeats, feedback out of bounds, a bid without id: the batch rows come out once."""
    bid_ddl = "bid_request_id string, bid_timestamp timestamp"
    feedback_ddl = ("impression_id string, bid_request_id string, feedback_timestamp timestamp, clearing_price double, "
                    "feedback_type string")
    folders = {"bids": bid_ddl, "feedback": feedback_ddl}

    def arrive(**rows):
        for name, ddl in folders.items():
            df = rows[name] if hasattr(rows[name], "write") else spark.createDataFrame(rows[name], ddl)
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def run():
        streams = [spark.readStream.schema(ddl).parquet(str(tmp_path / name)) for name, ddl in folders.items()]
        late_feedback.run_available(late_feedback.latest_feedback(*streams, bound="2 hours"), str(tmp_path / "out"),
                                    str(tmp_path / "state"))

    bids = [("a", minutes(0)), ("b", minutes(1)), ("c", minutes(2)), (None, minutes(3)), ("d", minutes(4))]
    first = [("i1", "a", minutes(5), 1.0, "same_hour"), ("i1", "a", minutes(5), 1.0, "same_hour"),
             ("i0", "a", minutes(5), 9.0, "same_hour"), ("i3", "d", minutes(3), 1.0, "before the bid"),
             ("i4", None, minutes(9), 1.0, "same_hour")]
    late = [("i2", "a", minutes(45), 2.0, "late_n_plus_1"), ("i5", "b", minutes(119), None, "late_n_plus_1"),
            ("i6", "b", minutes(200), 2.0, "out of bounds")]
    arrive(bids=bids, feedback=first)
    run()
    arrive(bids=[("e", minutes(60))], feedback=late)
    run()
    before = spark.read.parquet(str(tmp_path / "out")).count()
    bid_rows, feedback_rows = (spark.read.schema(ddl).parquet(str(tmp_path / name)) for name, ddl in folders.items())
    want = late_feedback.latest_feedback(bid_rows, feedback_rows, bound="2 hours").collect()
    for at in ("9000-01-01", "9500-01-01"):
        arrive(bids=late_feedback.closing_rows(bid_rows, "bid_timestamp", at, "bid_request_id", "end"),
               feedback=late_feedback.closing_rows(feedback_rows, "feedback_timestamp", at, "bid_request_id", "end"))
        run()
    got = spark.read.parquet(str(tmp_path / "out")).filter("bid_timestamp < '9000-01-01'").collect()
    assert before < len(got)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {r["bid_request_id"]: r["impression_id"] for r in got} == {
        "a": "i2", "b": "i5", "c": None, None: None, "d": None, "e": None}
