"""The watcher over restarts and from given states, sessions and windows of event time with late rows."""

import datetime as dt

from pyspark.sql import functions as F

from tempora.streaming import watch

KIND = "channel string, k long, live boolean, active boolean"


def put(spark, path, rows, kind):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(path))


def run(spark, tmp_path, initial=None):
    """All that has come since the last run, by one checkpoint."""
    read = spark.readStream.schema(KIND).parquet(str(tmp_path / "in"))
    checks = read.select("channel", F.timestamp_seconds("k").alias("ts"), F.col("k").alias("order"), "live", "active")
    found = watch.watch(checks, initial=initial)
    found.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return {c: [(r.action, r.offline) for r in sorted((r for r in rows if r.channel == c), key=lambda r: r.ts)] for c in {r.channel for r in rows}}


def test_watcher_goes_on_after_a_restart_and_from_given_states(spark, tmp_path):
    initial = spark.createDataFrame([("m", True, "manual", 0), ("a", True, "auto", 2)], "channel string, recording boolean, started_by string, offline long")
    off = (False, True)
    # rows of a file come in any order
    put(spark, tmp_path / "in", [("m", 2, *off), ("a", 1, *off), ("m", 1, *off), ("n", 3, *off), ("n", 1, True, False), ("n", 2, None, True)], KIND)
    assert run(spark, tmp_path, initial) == {"m": [("manual", 0)] * 2, "a": [("stop", 0)], "n": [("start", 0), ("unknown", 0), ("wait", 1)]}
    put(spark, tmp_path / "in", [("n", 5, *off), ("n", 4, *off), ("a", 5, *off)], KIND)
    assert run(spark, tmp_path, initial) == {"m": [("manual", 0)] * 2, "a": [("stop", 0), ("manual", 0)], "n": [("start", 0), ("unknown", 0), ("wait", 1), ("wait", 2), ("stop", 0)]}
    # a check of earlier time that comes later is the newest of its channel
    put(spark, tmp_path / "in", [("n", 0, True, True)], KIND)
    assert ("recording", 0) in run(spark, tmp_path, initial)["n"]


def at(second, micro=0):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second, microseconds=micro)


def events(spark, tmp_path, files):
    kind = "src string, ts timestamp, x double"
    for rows in files:
        put(spark, tmp_path / "in", [(s, t, 1.0) for s, t in rows], kind)
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_a_pause_of_the_gap_does_not_end_a_session(spark, tmp_path):
    first = [("s", at(0)), ("s", at(10)), ("s", at(20, 1)), ("t", at(5))]
    closing, more = [("u", at(5000))], [("u", at(5001))]
    late = [("s", at(11)), ("u", at(5002))]  # what comes late is told by the watermark of the batch before
    found = watch.run_to_end(watch.sessions(events(spark, tmp_path, [first, closing, more, late]), 10_000_000, "60 seconds")).collect()
    assert sorted((r.src, round(r.a.timestamp() - at(0).timestamp(), 6), round(r.b.timestamp() - at(0).timestamp(), 6), r.n) for r in found) == [("s", 0.0, 10.0, 2), ("s", 20.000001, 20.000001, 1), ("t", 5.0, 5.0, 1)]


def test_windows_are_given_once_when_they_are_over(spark, tmp_path):
    files = [[("s", at(10)), ("s", at(3599)), ("s", at(3600))], [("s", at(20)), ("s", at(3600 * 4))], [("s", at(3600 * 4 + 5))], [("s", at(30)), ("s", at(3600 * 4 + 6))]]
    found = watch.run_to_end(watch.loudness(events(spark, tmp_path, files))).collect()
    # the third row of the first hour comes before its end is passed, the fourth after; the last hour is still open
    assert sorted((r.start.timestamp() - at(0).timestamp(), r.n) for r in found) == [(0.0, 3), (3600.0, 1)]


def test_a_source_that_has_ended_gives_its_last_windows_too(spark, tmp_path):
    rows = [("s", at(10)), ("s", at(3599)), ("s", at(3600 * 5)), ("t", at(3600 * 5 + 1)), ("s", at(-7200)), (None, at(20))]
    put(spark, tmp_path / "in", [(s, t, 1.0) for s, t in rows], "src string, ts timestamp, x double")
    stream = spark.readStream.schema("src string, ts timestamp, x double").parquet(str(tmp_path / "in"))
    found = watch.whole_loudness(stream).collect()
    assert sorted((r.src or "", (r.start.timestamp() - at(0).timestamp()) // 3600, r.n) for r in found) == [("", 0, 1), ("s", -2, 1), ("s", 0, 2), ("s", 5, 1), ("t", 5, 1)]


def test_loudness_stream_holds_every_window_of_the_events(spark):
    from tempora.plans import queries, schedules

    d = "/root/testdata/sf0.001"
    key = lambda df: sorted((r.src, r.t, r.raw_db, r.n) for r in df.collect())
    assert key(schedules.loudness_stream(spark, d)) == key(queries.rms_per_bucket(spark, d))
