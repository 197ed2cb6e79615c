"""Sources and writers on small files."""

import json

from tempora.sources import files


def test_stems_after_the_last_section(spark, tmp_path):
    path = tmp_path / "stems.txt"
    path.write_text("zero\n# --- one\nfirst\n# --- one more\n Sécond # note\nТёмный\n\n", encoding="utf-8")
    assert [r.stem for r in files.stems(spark, str(path), "# --- one").orderBy("ord").collect()] == ["sécond", "темный"]
    assert [r.stem for r in files.stems(spark, str(path), "# none").orderBy("ord").collect()] == ["zero", "first", "sécond", "темный"]


def test_numbers_and_packets_skip_bad_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text("t,voice_db,more\n1,-20.5,x\n2,oops,y\n3,,z\n")
    assert [tuple(r) for r in files.numbers(spark, str(tmp_path / "f.csv"), ["t", "voice_db"]).collect()] == [(1.0, -20.5)]
    (tmp_path / "p.csv").write_text("v,oops,1\nv,3.0,0.25\nv,1.0,0.5\nv,2.0,N/A\nv,N/A,1\na,0.5,0.1\n")
    spans = files.stream_spans(files.packets(spark, str(tmp_path / "p.csv")))
    assert sorted(map(tuple, spans.collect())) == [("a", 0.5, 0.5, 0.6), ("v", 3.0, 1.0, 3.25)]


def test_upsert_of_mutes_leaves_the_rest(spark, tmp_path):
    path = tmp_path / "edit.json"
    path.write_text(json.dumps({"name": "n", "source": "s", "source_duration": 10.0, "keep_segments_source_time": [[0, 5]], "mutes_source_time": [{"a": 8, "b": 9, "word": "old", "kind": "letter"}]}, indent=1))
    edits = files.edit_lists(spark, str(path), files.LONG).drop("file")
    rows = [("n", 1.0, 2.0, "one", "letter"), ("n", 2.0, 3.0, "two", "word"), ("n", 9.5, 11.0, "three", "letter"), ("n", 10.0, 12.0, "past", "letter")]
    out = files.with_mutes(edits, spark.createDataFrame(rows, "name string, a double, b double, word string, kind string")).collect()[0]
    assert [tuple(m) for m in out.mutes_source_time] == [(1.0, 3.0, "one,two", "word"), (9.5, 10.0, "three", "letter")]
    assert (out.source, out.keep_segments_source_time) == ("s", [[0.0, 5.0]])
    files.write_documents(edits, str(tmp_path / "out"))
    assert files.edit_lists(spark, str(tmp_path / "out"), files.LONG).count() == 1


def test_features_have_six_places(spark, tmp_path):
    df = spark.createDataFrame([("s", 1, 0.12345678, None), ("t", 2, -2.0, 1.5)], "src string, t long, x double, y double").coalesce(1)
    files.write_features(df, str(tmp_path / "f"))
    text = "".join(p.read_text() for p in (tmp_path / "f").glob("part-*"))
    assert text.splitlines() == ["src,t,x,y", "s,1,0.123457,", "t,2,-2.0,1.5"]
    assert files.numbers(spark, str(tmp_path / "f"), ["t", "x"]).count() == 2


def test_references_of_a_table(spark, tmp_path):
    from tempora.sources import catalog

    (tmp_path / "refs.json").write_text('{"key": "a/b", "num": 1, "start": "0:01:05", "end": "00:02:00", "name": "x"}\n{"key": "c", "num": 2, "start": "01:00:00", "end": "01:00:12"}\n')
    assert sorted(map(tuple, catalog.read_references(spark, str(tmp_path / "refs.json")).collect())) == [("a", "a/b", 1, "x", 65, 120), ("c", "", 2, None, 3600, 3612)]
    assert catalog.read_references(spark, str(tmp_path / "none.json")).count() == 0
