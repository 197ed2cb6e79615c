"""Listings, lookups of files by name, settings, reports, logs and model windows on small literal files and rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.sources import catalog, reports


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_listing_names_files_below_the_folder(spark, tmp_path):
    (tmp_path / "a b" / "deep").mkdir(parents=True)
    (tmp_path / "a b" / "deep" / "x.mov").write_bytes(b"123")
    (tmp_path / "y.mp4").write_bytes(b"1")
    (tmp_path / "empty.mp4").write_bytes(b"")
    found = {r.path: r.bytes for r in catalog.listing(spark, str(tmp_path)).collect()}
    assert found == {"a b/deep/x.mov": 3, "y.mp4": 1}


def test_sources_come_from_the_root_by_extension_then_from_one_folder(spark):
    files = paths(spark, "a.mp4", "a.mov", "d/a.mov", "d/b.mkv", "e/c.mov", "d/c.mp4", "_x/f.mov", "ClipsOld/f.mov", "d/e/g.mov", "h.x.webm", "b.txt")
    names = spark.createDataFrame([(n,) for n in ["a", "b", "c", "f", "g", "h.x", "a"]], "name string")
    found = catalog.find_sources(files, names)
    assert {r.name: (r.path, r.n_below) for r in found.collect()} == {"a": ("a.mov", 1), "b": ("d/b.mkv", 1), "c": (None, 2), "f": (None, 0), "g": (None, 0), "h.x": ("h.x.webm", 0)}
    assert catalog.required(found.filter("name = 'b'")).first().path == "d/b.mkv"
    with pytest.raises(Exception, match="files found for c: 2"):
        catalog.required(found.filter("name = 'c'")).collect()
    assert catalog.find_sources(files.limit(0), names).filter("path is null and n_below = 0").count() == 6


def test_edit_list_lookup_takes_the_first_that_names_the_source(spark):
    rows = [("s1.json", "other", None), ("s1/edl.json", None, None), ("s1/b_edit/s_edit.json", "s1", None), ("s1/b_edit/zs.json", "s1", None), ("s1/a_edit/mys.json", None, "/v/s1.mov"), ("s1/none/edl.json", "s1", None), ("q.json", "q", None), ("q/edl.json", "q", None), ("q/tt/deep/edl.json", "q", None)]
    found = catalog.edit_list_of(spark.createDataFrame(rows, "path string, src string, source string"))
    assert {r.name: r.path for r in found.collect()} == {"s1": "s1/a_edit/mys.json", "q": "q.json"}


def test_a_sidecar_without_words_replaces_the_transcript(spark):
    edits = spark.createDataFrame([(1, "e1", "n1", "s"), (2, "e2", "n2", "s"), (3, "e3", "n3", "s"), (4, "e4", "e4", "s"), (5, "e5", None, "gone")], "edit int, stem string, name string, src string")
    files = spark.createDataFrame([("e1",), ("n1",), ("n2",), ("e4",)], "stem string")
    sidecars = spark.createDataFrame([("e1", "one"), ("n1", "no"), ("n2", "two")], "stem string, w string")
    transcripts = spark.createDataFrame([("s", "spoken")], "src string, w string")
    assert sorted(map(tuple, catalog.words_for(edits, files, sidecars, transcripts).collect())) == [(1, "sidecar", "one"), (2, "sidecar", "two"), (3, "transcript", "spoken")]


def test_optional_files_and_settings(spark, tmp_path):
    assert catalog.hooks(spark, str(tmp_path / "none.json")).count() == 0 and catalog.visual(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "hooks.json").write_text('{"e": [1.5, 2], "f": [3]}')
    (tmp_path / "visual.json").write_text('["a", "a", "b"]')
    (tmp_path / "null.json").write_text("null")
    assert sorted(map(tuple, catalog.hooks(spark, str(tmp_path / "hooks.json")).collect())) == [("e", 1.5, 2.0), ("f", 3.0, None)]
    assert sorted(r.edl for r in catalog.visual(spark, str(tmp_path / "visual.json")).collect()) == ["a", "b"]
    assert catalog.hooks(spark, str(tmp_path / "null.json")).count() == 0
    (tmp_path / "env").write_text("# A=1\nB = \"two=2\" \n\nno\nC='x'\nC=y\nD=\n")
    assert {r.key: r.value for r in catalog.key_values(spark, str(tmp_path / "env")).collect()} == {"B": "two=2", "C": "y", "D": ""}
    (tmp_path / "words.json").write_text(json.dumps([{"w": "ein", "start": 0.5, "end": 1}, {"w": "zwei", "start": 1, "end": 2, "prob": 0.5}]))
    assert sorted((r.w, r.start, r.prob) for r in catalog.word_list(spark, str(tmp_path / "words.json")).collect()) == [("ein", 0.5, None), ("zwei", 1.0, 0.5)]


def test_clips_and_features(spark):
    files = paths(spark, "b/x.MOV", "a/y/z.mov", "a/q.mp4", "top.mov", "s/features.csv", "s/t/features.csv")
    assert sorted(map(tuple, catalog.clips(files).collect())) == [("a/y/z.mov", "a", "a/y/z.mp4"), ("b/x.MOV", "b", "b/x.mp4"), ("top.mov", "top.mov", "top.mp4")]
    assert [r.path for r in catalog.clips(files, limit=1).collect()] == ["a/y/z.mov"] and catalog.clips(files, "c").count() == 0
    assert [r.src for r in catalog.with_features(files).collect()] == ["s"]


def test_segment_lines_keep_the_order_and_leave_out_missing_words(spark):
    rows = [(1, 0, 0.5, 2.0, 1, "b", None, "rep"), (1, 0, 0.5, 2.0, 0, "a", "a", "eq"), (1, 0, 0.5, 2.0, 2, None, "c", "ins"), (1, 1, 2.0, 3.0, 3, "d", None, "del")]
    out = reports.segment_lines(spark.createDataFrame(rows, "src int, id int, a double, b double, o int, giga string, w string, op string")).orderBy("id").collect()
    assert [(r.head, r.giga, r.final) for r in out] == [("# сегмент 0  [0.500..2.000)  eq 1, ins 1", "GIGA: a b", "ИТОГ: a c"), ("# сегмент 1  [2.000..3.000)  ", "GIGA: d", "ИТОГ: ")]


def test_only_what_changed_is_written_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    path = str(tmp_path / "out")
    assert reports.write_changed(df, path) and not reports.write_changed(df.orderBy("i", ascending=False), path)
    assert reports.write_changed(df.distinct(), path) and spark.read.parquet(path).count() == 2


def test_a_log_grows_by_the_lines_of_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for message in ("on", None):
        spark.createDataFrame([(message,)], "m string").write.mode("append").parquet(source)
        at = F.lit("2024-05-06 07:08:09").cast("timestamp")
        stream = spark.readStream.schema("m string").parquet(source).select(reports.log_line(at, F.col("m")).alias("line"))
        reports.append_log(stream, out, str(tmp_path / "check"), None).awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["2024-05-06 07:08:09+0000 ", "2024-05-06 07:08:09+0000 on"]


def test_the_newest_file_is_fresh_for_less_than_the_time(spark):
    files = spark.createDataFrame([("a.mp4", "2024-01-01 00:00:00"), ("b.mp4", "2024-01-01 00:01:00"), ("c.txt", "2024-01-01 00:02:00")], "path string, modified string").withColumn("modified", F.col("modified").cast("timestamp"))
    at = lambda s: F.lit(s).cast("timestamp")
    assert [r.path for r in reports.fresh(files, at("2024-01-01 00:01:29")).collect()] == ["b.mp4"]
    assert reports.fresh(files, at("2024-01-01 00:01:30")).count() == 0 and reports.fresh(files.limit(0), at("2024-01-01 00:00:00")).count() == 0


def test_model_gets_whole_windows_in_batches(spark):
    seen = spark.range(10).select("id", F.array(*(F.col("id") * 1.0 + k for k in range(3))).cast("array<float>").alias("x"))
    out = reports.with_model(seen.coalesce(1), "x", lambda m: np.stack([m.sum(1), np.full(len(m), len(m))], 1), ["total", "rows"], batch=4).collect()
    assert {r.id: r.total for r in out} == {i: 3.0 * i + 3 for i in range(10)} and sorted(r.rows for r in out) == [2.0] * 2 + [4.0] * 8
    assert reports.with_model(seen.limit(0), "x", lambda m: m, ["a", "b", "c"]).count() == 0
