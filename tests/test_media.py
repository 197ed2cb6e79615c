"""Headers and byte ranges of sound and video files."""

import math
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.operators import audio
from tempora.sources import media


def write_wav(path, x, rate=16_000, channels=1, width=2):
    with wave.open(str(path), "wb") as f:
        f.setnchannels(channels), f.setsampwidth(width), f.setframerate(rate)
        f.writeframes(x.tobytes())


def box(name, *parts):
    data = b"".join(parts)
    return struct.pack(">I4s", len(data) + 8, name) + data


def video(scale=1000, length=2500, width=1920, height=1080, wide=False):
    clock = lambda s, n: struct.pack(">B3xQQIQ", 1, 0, 0, s, n) if wide else struct.pack(">B3xIIII", 0, 0, 0, s, n)
    track = lambda kind, s, w, h: box(b"trak", box(b"tkhd", bytes(76), struct.pack(">II", w << 16, h << 16)), box(b"mdia", box(b"mdhd", clock(s, 1), bytes(4)), box(b"hdlr", bytes(8), kind, bytes(12))))
    return box(b"moov", box(b"mvhd", clock(scale, length), bytes(80)), track(b"vide", 90_000, width, height), track(b"soun", 48_000, 0, 0))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    x = (np.sin(np.arange(100_003) / 9) * np.linspace(0, 30_000, 100_003)).astype("<i2")
    write_wav(tmp_path / "one.wav", x)
    write_wav(tmp_path / "none.wav", x[:0])
    rows = media.wav_blocks(spark, str(tmp_path), block=1000, window=800, split=16_000)
    assert rows.rdd.getNumPartitions() == math.ceil(100_003 / 8000)
    parts = rows.withColumn("p", F.spark_partition_id()).select("p", "src", (F.posexplode("x")).alias("k", "v"), "pos").select("p", "src", (F.col("pos") + F.col("k")).alias("pos"), F.col("v").alias("x"))
    assert parts.groupBy(F.floor(F.col("pos") / 800)).agg(F.countDistinct("p").alias("n")).filter("n > 1").count() == 0  # no window is cut
    got = {r.k: r.db for r in audio.window_loudness(parts, 800).collect()}
    whole = (x[: len(x) // 800 * 800] / 32768).reshape(-1, 800)
    want = [max(-200.0, 10 * math.log10(m)) if (m := float((w.astype(np.float32).astype(float) ** 2).mean())) > 0 else -200.0 for w in whole]
    assert sorted(got) == list(range(len(want))) and max(abs(got[k] - v) for k, v in enumerate(want)) < 1e-3


def test_other_formats_are_errors(spark, tmp_path):
    write_wav(tmp_path / "two.wav", np.zeros(8, "<i2"), channels=2)
    with pytest.raises(Exception, match="not 16-bit mono"):
        media.wav_blocks(spark, str(tmp_path)).count()


def test_headers(spark, tmp_path):
    write_wav(tmp_path / "a.wav", np.zeros(16_000, "<i2"), rate=8000)
    write_wav(tmp_path / "b.wav", np.zeros(0, "<i2"))
    ftyp, mdat = box(b"ftyp", b"isom", bytes(4)), box(b"mdat", bytes(5000))
    (tmp_path / "c.mp4").write_bytes(ftyp + mdat + video())
    (tmp_path / "d.MOV").write_bytes(ftyp + video(wide=True, width=720, height=1280) + struct.pack(">I4sQ", 1, b"mdat", 5016) + bytes(5000))
    cut = (tmp_path / "a.wav").read_bytes()
    bad = {"cut.wav": cut[:20], "late.wav": cut[:44] + bytes(100), "junk.mp4": b"no video at all, but long enough", "empty.mp4": b"", "half.mp4": ftyp + video()[:60], "wrong.wav": b"RIFF\0\0\0\0AVI LIST"}
    for name, data in bad.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "notes.txt").write_text("x")
    found = {r.path.rsplit("/", 1)[-1]: r for r in media.headers(spark, str(tmp_path)).collect()}
    assert len(found) == 4 + len(bad)
    assert (found["a.wav"].duration, found["a.wav"].rate, found["a.wav"].channels, found["a.wav"].data_at, found["a.wav"].data_bytes) == (2.0, 8000, 1, 44, 32_000)
    assert (found["b.wav"].duration, found["b.wav"].fault) == (0.0, None)
    assert [(r.duration, r.width, r.height, r.rate, r.fault) for r in (found["c.mp4"], found["d.MOV"])] == [(2.5, 1920, 1080, 48_000, None), (2.5, 720, 1280, 48_000, None)]
    assert all(found[n].fault and found[n].duration is None for n in bad if n != "late.wav")
    assert (found["late.wav"].data_bytes, found["late.wav"].fault) == (100, None)
    assert media.headers(spark, str(tmp_path), ends=".none").count() == 0
