"""Streams: intake in calls, matching with expiry, daily counts."""

import datetime as dt

from pyspark.sql import functions as F

from lodestack.streaming.correlate import match_requests, match_stream
from lodestack.streaming.intake import daily_counts, take_in
from lodestack.streaming.sessions import connection_counts, polled, session_stream


def test_second_call_adds_nothing(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("s", "t", "c"))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id long, v string")
    rows.write.parquet(source)
    for _ in range(2):
        take_in(spark, source, rows.schema, target, check, "id")
    assert spark.read.parquet(target).count() == 2
    spark.createDataFrame([(2, "x"), (3, "c")], "id long, v string").write.mode("append").parquet(source)
    take_in(spark, source, rows.schema, target, check, "id")
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(target).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_match_requests(spark):
    at = dt.datetime(2024, 1, 1)
    s = lambda n: at + dt.timedelta(seconds=n)
    q = spark.createDataFrame([(1, 1, s(0)), (2, 1, s(50)), (3, 2, s(0))], "id long, k long, asked timestamp")
    a = spark.createDataFrame([(1, s(10)), (1, s(100)), (9, s(1))], "k long, answered timestamp")
    got = {r["id"]: r["status"] for r in match_requests(q, a, ["k"], "id", "asked", "answered", "30 seconds").collect()}
    assert got == {1: "answered", 2: "timeout", 3: "timeout"}


def test_match_stream(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    s = lambda n: at + dt.timedelta(seconds=n)
    schema = "id long, kind string, at timestamp"
    source = str(tmp_path / "m")
    for part in ([(1, "request", s(0)), (2, "request", s(1)), (1, "response", s(5))], [(3, "request", s(200))], [(4, "request", s(400))]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source).withWatermark("at", "1 second")
        q = match_stream(stream).writeStream.outputMode("append").foreachBatch(lambda df, n: df.write.mode("append").parquet(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {(r["id"], r["status"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert {(1, "answered"), (2, "timeout")} <= got
    assert (1, "timeout") not in got


def test_daily_counts_takes_zoneless_times(spark, tmp_path):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d, 12), "view") for d in (1, 1, 2, 5, 9)], "ts timestamp, event_type string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rows.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = daily_counts(stream, "ts").writeStream.outputMode("append").format("memory").queryName("days").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["n"] for r in spark.sql("SELECT n FROM days ORDER BY day").collect()][:2] == [2, 1]


EVENTS = [(1, 0, "attach", "a"), (1, 1, "attach", "b"), (1, 2, "request", "q"), (1, 3, "detach", "a"), (2, 0, "attach", "a"), (2, 1, "request", "q"), (2, 2, "disconnect", None), (2, 3, "attach", "c"), (3, 0, "request", "q"), (3, 500, "response", "z"), (4, 5, "disconnect", None)]


def _events(spark):
    at = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(c, at + dt.timedelta(seconds=n), n, k, i) for c, n, k, i in EVENTS], "connection long, at timestamp, number int, kind string, item string")


def test_disconnect_clears_sessions_but_not_requests(spark):
    got = {r["connection"]: (r["sessions"], r["pending"]) for r in connection_counts(_events(spark), "connection", "at", "number", "30 seconds").collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 0), 4: (0, 0)}


def test_session_stream_ends_where_the_table_does(spark, tmp_path):
    source, out = str(tmp_path / "e"), str(tmp_path / "out")
    events = _events(spark)
    for number, part in enumerate((events.where("number < 2"), events.where("number >= 2"))):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source).withWatermark("at", "1 hour")
        put = lambda df, n, number=number: df.withColumn("call", F.lit(number)).write.mode("append").parquet(out)
        session_stream(stream).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(out).groupBy("connection").agg(F.max_by("sessions", "call").alias("n"))
    batch = connection_counts(events, "connection", "at", "number", "30 seconds")
    assert {r["connection"]: r["n"] for r in last.collect()} == {r["connection"]: r["sessions"] for r in batch.collect()}


def test_polled(spark):
    at = dt.datetime(2024, 1, 1)
    s = lambda n: at + dt.timedelta(seconds=n)
    waits = spark.createDataFrame([(1, 1, s(0)), (2, 2, s(0)), (3, 3, s(0)), (4, 4, s(0))], "id long, k long, asked timestamp")
    ready = spark.createDataFrame([(1, s(1.2)), (2, s(0)), (3, s(14.9))], "k long, done timestamp")
    got = {r["id"]: (r["status"], r["polls"]) for r in polled(waits, ready, ["k"], "id", "asked", "done").collect()}
    assert got == {1: ("complete", 3), 2: ("complete", 1), 3: ("timeout", 29), 4: ("timeout", 29)}
