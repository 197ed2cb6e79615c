"""Operators on small fixtures, at their boundaries."""

from pyspark.sql import functions as F

from tempora.functions import text as T
from tempora.operators import intervals, series, sessions


def test_union_joins_touching_and_nested(spark):
    df = spark.createDataFrame([("s", 0, 10), ("s", 10, 20), ("s", 12, 15), ("s", 21, 30), ("s", 5, 5)], "src string, a long, b long")
    assert sorted(map(tuple, intervals.union(df).select("a", "b").collect())) == [(0, 20), (21, 30)]
    again = intervals.union(intervals.union(df))
    assert sorted(map(tuple, again.select("a", "b").collect())) == [(0, 20), (21, 30)]


def test_complement_has_head_and_tail(spark):
    df = spark.createDataFrame([("s", 5, 10)], "src string, a long, b long")
    total = spark.createDataFrame([("s", 20)], "src string, total long")
    assert sorted(map(tuple, intervals.complement(df, total).select("a", "b").collect())) == [(0, 5), (10, 20)]


def test_range_join_equals_nested_loop(spark):
    a = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("i"), (F.col("id") * 7).alias("la"), (F.col("id") * 7 + F.col("id") % 30).alias("lb"))
    b = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("j"), (F.col("id") * 9).alias("ra"), (F.col("id") * 9 + F.col("id") % 25).alias("rb"))
    got = sorted(map(tuple, intervals.range_join(a, b, "k", 10, F.lit(True)).select("i", "j").collect()))
    want = sorted((i, j) for i in range(40) for j in range(40) if i * 7 <= j * 9 + j % 25 and j * 9 <= i * 7 + i % 30)
    assert got == want


def test_robust_z_of_constant_series_is_zero(spark):
    df = spark.createDataFrame([("s", t, 5.0) for t in range(4)] + [("s", 4, None)], "src string, t long, v double")
    assert {r.z for r in series.robust_z(df, "v").collect()} == {0.0}
    assert series.local_maxima(df.fillna(5.0), "v").count() == 5


def test_nms_keeps_the_gap(spark):
    df = spark.createDataFrame([("s", 0, 3.0), ("s", 44, 2.0), ("s", 45, 1.0)], "src string, t long, v double")
    assert [r.t for r in series.nms_top_n(df, "v").orderBy("rank").collect()] == [0, 45]


def test_gap_at_the_threshold_does_not_break(spark):
    df = spark.createDataFrame([("s", 0, 0, 100, "a"), ("s", 1, 400, 500, "b"), ("s", 2, 801, 900, "c")], "src string, o long, start_us long, end_us long, w string")
    assert [r.island for r in sessions.gap_islands(df, 300).orderBy("o").collect()] == [1, 1, 2]


def test_words(spark):
    df = spark.createDataFrame([("Ёжик!",), ("ab",), ("",)], "w string")
    assert [r[0] for r in df.select(T.norm_word(F.col("w"))).collect()] == ["ежик", "ab", ""]
    assert [r[0] for r in df.select(T.censor(F.col("w"))).collect()] == ["Ёж*к!", "a*", ""]


def test_queries_have_oracles():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_more_timecodes(spark):
    df = spark.createDataFrame([(3661.5, "a|b\nc"), (0.5, ""), (-2.0, None), (59.999, "x")], "s double, t string")
    out = df.select(T.clock_rounded(F.col("s")), T.clock_hundredths(F.col("s")), T.table_cell(F.col("t")), T.frame_number(F.col("s"))).collect()
    assert [r[0] for r in out] == ["01:01:02", "00:00:00", "00:00:00", "00:01:00"]
    assert [r[1] for r in out] == ["1:01:01.50", "0:00:00.50", "0:00:00.00", "0:01:00.00"]
    assert [r[2] for r in out] == ["a\\|b c", "—", "—", "x"]
    assert [r[3] for r in out] == [219690, 30, -120, 3600]
