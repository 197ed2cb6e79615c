"""Mute windows, chunks, WAV blocks and faults of edit lists on small literal rows."""

import wave

import numpy as np

from tempora.functions import text as T
from tempora.operators import audio, mutes, schedule
from tempora.sources import media

W = "src long, o long, w string, giga string, start_us long, end_us long"


def test_windows_take_the_first_bad_text_and_whole_words(spark):
    rows = [(1, 0, "nation", "nature", 0, 1_000_000), (1, 1, "nature", "stationery", 2_000_000, 3_000_000), (1, 2, "fine", "good", 0, 1), (1, 3, None, "ration", 5, 5), (1, 4, "nation", "stationery", 7_000_000, 8_000_000)]
    words = spark.createDataFrame(rows, W)
    letter, clip = ({r.o: r for r in mutes.windows(words, ["tion"], [], ["station"], rule).collect()} for rule in ("letter", "clip"))
    assert (letter[0].word, letter[0].kind, letter[0].a, letter[0].b) == ("nation", "letter", 383_333, 783_333)
    assert (letter[1].word, letter[1].kind, letter[1].a, letter[1].b) == ("stationery", "word", 1_970_000, 3_030_000)
    assert 3 in letter and 3 not in clip and 2 not in letter
    assert letter[4].kind == "letter" and (clip[4].a, clip[4].b, clip[4].kind) == (6_970_000, 8_030_000, "letter")


def test_merged_windows_keep_the_order_of_words(spark):
    rows = [(1, 0, 10, "b", "letter"), (1, 10, 20, "a", "word"), (1, 12, 15, "b", "letter"), (1, 21, 30, "c", "letter"), (1, 40, 40, "d", "letter")]
    out = mutes.merged(spark.createDataFrame(rows, "src long, a long, b long, word string, kind string")).orderBy("a").collect()
    assert [(r.a, r.b, r.n, r.word, r.kind) for r in out] == [(0, 20, 3, "b,a", "word"), (21, 30, 1, "c", "letter")]


def test_quiet_chunks_equal_a_plain_walk(spark):
    rng = np.random.default_rng(1)
    series = {src: [int(x) for x in rng.integers(0, 5, n)] for src, n in enumerate((1, 17, 18, 19, 100, 313))}
    rows = [(src, i, float(x)) for src, xs in series.items() for i, x in enumerate(xs)]
    got = {}
    for r in audio.quiet_chunks(spark.createDataFrame(rows, "src long, i long, x double")).orderBy("src", "k").collect():
        got.setdefault(r.src, []).append((r.a, r.b))
    for src, xs in series.items():
        want, pos = [], 0
        while pos < len(xs):
            end = len(xs) if len(xs) - pos <= 18 else min(range(pos + 12, pos + 18), key=lambda i: (xs[i], i))
            want.append((pos, end))
            pos = end
        assert got[src] == want


def test_wav_blocks(spark, tmp_path):
    x = (np.arange(-500, 500) * 30).astype("<i2")
    for name, data in (("one", x), ("none", x[:0])):
        with wave.open(f"{tmp_path}/{name}.wav", "wb") as f:
            f.setnchannels(1), f.setsampwidth(2), f.setframerate(16_000)
            f.writeframes(data.tobytes())
    rows = media.wav_blocks(spark, str(tmp_path), block=300).orderBy("pos").collect()
    assert [(r.src, r.rate, r.pos, len(r.x)) for r in rows] == [("one", 16_000, p, n) for p, n in ((0, 300), (300, 300), (600, 300), (900, 100))]
    assert np.allclose(np.concatenate([r.x for r in rows]), x / 32768)


def test_faults_of_edit_lists(spark):
    crop = "struct<x:long,y:long,w:long,h:long>"
    rows = [(1, 0, 0, 5, 1.0, None, "cam", None), (1, 1, 5, 5, 2.5, 1.0, "face", (0, 0, 0, 5)), (1, 2, 0, 5, 1.5, None, None, (1900, 0, 30, 5))]
    out = schedule.violations(spark.createDataFrame(rows, f"src long, id long, a long, b long, speed double, broll double, focus string, crop {crop}"))
    assert sorted((r.id, r.rule) for r in out.collect()) == sorted([(1, "empty segment"), (1, "speed"), (1, "b-roll at another speed"), (1, "focus"), (1, "empty crop"), (2, "crop outside")])


def test_made_up_segments_and_parsers(spark):
    rows = [("Субтитры сделал X", 0.0, 0.0, True), ("Корректор А.Иванова", 0.0, 0.0, True), ("корректор", 0.0, 0.0, False), ("корректор", 0.6, 0.0, True), ("hello", 0.8, -0.7, True), ("hello", 0.8, -0.5, False), ("Thanks for watching", 0.1, -0.8, True), (None, 0.1, 0.0, False)]
    df = spark.createDataFrame(rows, "text string, n double, l double, want boolean")
    assert [r.got for r in df.select(audio.not_said(df.text, df.n, df.l).alias("got")).collect()] == [r[3] for r in rows]
    one = spark.createDataFrame([("peak: -inf dB I: -3 LUFS", "@Some_One", "1:02.5", "*|warn@yellow| x|@#12ab9F|y@#12ab9F")], "a string, b string, c string, d string")
    (r,) = one.select(T.decibels(one.a, "peak").alias("p"), T.last_loudness(one.a).alias("l"), T.last_block(one.a, "x").alias("n"), T.channel_name(one.b).alias("b"), T.whole_seconds(one.c).alias("c"), T.rich_line(one.d).alias("d")).collect()
    assert (r.p, r.l, r.n, r.b, r.c) == (-999.0, -3.0, None, "some_one", "1:02")
    assert [(x.text, x.colour) for x in r.d] == [("*", "WHITE"), ("warn", "YELLOW"), (" x", "WHITE"), ("y", "#12ab9F")]
