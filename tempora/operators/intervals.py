"""Interval algebra on integer microseconds: union, complement, subtraction, range and as-of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import scans

#: Levels of the interval index: the widest cells are so many doublings of a bucket.
LEVELS = 62
#: Most parts into which the rows of a wide cell are dealt.
PARTS = 64


def union(intervals: DataFrame, by: str = "src", gap: int = 0, label: str | None = None, more: list[Column] | None = None, slice_us: int = scans.SLICE_US) -> DataFrame:
    """Disjoint intervals that cover the same points; those at most `gap` apart are joined. by, a, b, n.

    With `label`, also `labels`: the distinct labels of the joined intervals in alphabetical
    order, linked by a plus sign; `more` are other aggregates of the joined intervals.
    """
    more = (more or []) + ([F.array_join(F.array_sort(F.collect_set(label)), "+").alias("labels")] if label else [])
    dealt = scans.deal(intervals.filter("b > a"), [by], "a", slice_us)
    reached = scans.running(dealt, [by], ["a", "b"], {"_reach": ("max", F.col("b"))})
    new = F.coalesce(F.col("a") > F.col("_reach") + gap, F.lit(True)).cast("long")
    marked = scans.running(reached.withColumn("_new", new), [by], ["a", "b"], {"_g": ("sum", F.col("_new"))}, inclusive=True)
    return marked.groupBy(by, "_g").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n"), *more).drop("_g")


def complement(disjoint: DataFrame, total: DataFrame, by: str = "src", least: int = 0, slice_us: int = scans.SLICE_US) -> DataFrame:
    """Gaps longer than `least` inside [0, total), head and tail included. by, a, b."""
    edges = total.select(by, F.col("total").alias("a"), F.col("total").alias("b")).unionByName(disjoint.select(by, "a", "b"))
    before = scans.running(scans.deal(edges, [by], "a", slice_us), [by], ["a", "b"], {"_b": ("last", F.col("b"))})
    gaps = before.select(by, F.coalesce("_b", F.lit(0).cast("long")).alias("_a"), F.col("a").alias("b"))
    return gaps.select(by, F.col("_a").alias("a"), "b").filter(F.col("b") - F.col("a") > least)


def cells(rows: DataFrame, a: str, b: str, bucket: int, other_levels: DataFrame, own_salts: int, their_salts: int) -> DataFrame:
    """Adds `_k` (level, cell, part) and `_f`, the first cell at that level, for each cell where a row may meet others.

    A range's level is the first whose cells are as wide as it is, so it lies in two cells at most there;
    it also looks in the cells of each wider level that the other side has. In a wide cell the narrow
    rows are dealt to parts and the wide ones are in all of them.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    level = F.greatest(F.lit(0), F.ceil(F.log2((high - low + 1) / bucket))).cast("int")
    parts = lambda m: F.least(F.lit(PARTS), F.pow(F.lit(2.0), m - 1)).cast("int")
    seen = rows.withColumn("_l", level).join(other_levels)  # one row
    wider = F.filter("_levels", lambda m: m > F.col("_l"))
    narrow = F.transform(wider, lambda m: F.struct(m.alias("m"), F.lit(own_salts).alias("kind"), F.pmod(F.xxhash64(a, b), parts(m)).cast("int").alias("part")))
    wide = F.when(F.exists("_levels", lambda m: m < F.col("_l")), F.transform(F.sequence(F.lit(0), parts(F.col("_l")) - 1), lambda p: F.struct(F.col("_l").alias("m"), F.lit(their_salts).alias("kind"), p.alias("part"))))
    same = F.when(F.array_contains("_levels", F.col("_l")), F.array(F.struct(F.col("_l").alias("m"), F.lit(0).alias("kind"), F.lit(0).alias("part"))))
    none = F.expr("cast(array() as array<struct<m:int,kind:int,part:int>>)")
    found = seen.select(*rows.columns, F.explode(F.concat(F.coalesce(same, none), narrow, F.coalesce(wide, none))).alias("_p"))
    size = F.pow(F.lit(2.0), F.col("_p.m")) * bucket
    found = found.withColumns({"_f": F.floor(low / size), "_e": F.floor(high / size)})
    return found.select(*rows.columns, "_f", F.explode(F.sequence("_f", "_e")).alias("_c"), "_p").withColumn("_k", F.struct(F.col("_p.m").alias("m"), F.col("_p.kind").alias("kind"), F.col("_p.part").alias("part"), F.col("_c").alias("c"))).drop("_c", "_p")


def levels_of(rows: DataFrame, a: str, b: str, bucket: int) -> DataFrame:
    """One row: the levels of the index that these ranges have, at most `LEVELS`."""
    return rows.agg(F.collect_set(F.greatest(F.lit(0), F.ceil(F.log2((F.abs(F.col(b) - F.col(a)) + 1) / bucket))).cast("int")).alias("_levels"))


def range_join(left: DataFrame, right: DataFrame, by: str, bucket: int, on: Column, la: str = "la", lb: str = "lb", ra: str = "ra", rb: str = "rb") -> DataFrame:
    """Pairs of overlapping closed ranges [la, lb] and [ra, rb] of the same key that meet `on`.

    An index of cells that double in width from level to level: a range of any length lies in at most
    two cells of its level, and two ranges meet in a cell of the wider one's level, by equality. A pair
    is told by the first cell that both are in, so it comes once. No nested loop, a key is spread
    over its cells, and a wide cell over parts.
    """
    one = cells(left, la, lb, bucket, levels_of(right, ra, rb, bucket), 1, 2)
    two = cells(right, ra, rb, bucket, levels_of(left, la, lb, bucket), 2, 1)
    met = one.withColumnRenamed("_f", "_f1").join(two.withColumnRenamed("_f", "_f2"), [by, "_k"])
    return met.filter((F.col("_k.c") == F.greatest("_f1", "_f2")) & (F.col(la) <= F.col(rb)) & (F.col(ra) <= F.col(lb)) & on).drop("_k", "_f1", "_f2")


def stabbings(points: DataFrame, ranges: DataFrame, by: str = "src", slice_us: int = scans.SLICE_US) -> DataFrame:
    """by, t, n, on: each time that points (by, t) have, how many have it, and how many closed ranges (by, a, b) hold it.

    A time is held by the ranges that begin up to it less those that end before it, so no pair is built:
    the work grows with points and ranges. Times that no range holds are left out, as by a join.
    """
    edge = lambda c, on, off: F.struct(F.col(c).alias("t"), F.lit(on).alias("n_on"), F.lit(off).alias("n_off"))
    edges = ranges.filter("a <= b").select(by, F.explode(F.array(edge("a", 1, 0), edge("b", 0, 1))).alias("e")).select(by, "e.t", F.lit(0).alias("n"), "e.n_on", "e.n_off")
    marks = points.select(by, "t", F.lit(1).alias("n"), F.lit(0).alias("n_on"), F.lit(0).alias("n_off")).unionByName(edges)
    times = marks.filter(F.col(by).isNotNull() & F.col("t").isNotNull()).groupBy(by, "t").agg(*(F.sum(c).alias(c) for c in ("n", "n_on", "n_off")))
    held = scans.running(scans.deal(times, [by], "t", slice_us), [by], ["t"], {"on": ("sum", F.col("n_on") - F.col("n_off"))}, inclusive=True)
    return held.select(by, "t", "n", (F.col("on") + F.col("n_off")).alias("on")).filter("n > 0 and on > 0")


def not_touching(left: DataFrame, right: DataFrame, by: str, row: list[str], bucket: int, on: Column | None = None) -> DataFrame:
    """Left ranges (rows told apart by `row`) that no right range of the key overlaps so that `on` holds."""
    hit = range_join(left, right, by, bucket, F.lit(True) if on is None else on).select(by, *row).distinct()
    return left.join(hit, [by, *row], "left_anti")


def subtract(keeps: DataFrame, cuts: DataFrame, by: str = "src") -> DataFrame:
    """Parts of disjoint `keeps` (by, id, a, b) outside disjoint `cuts` (by, id, a, b clipped to the keep)."""
    edges = cuts.select(by, "id", F.col("a").alias("x"), F.col("b").alias("y")).unionByName(keeps.select(by, "id", F.col("b").alias("x"), F.col("b").alias("y")))
    starts = keeps.select(by, "id", F.col("a").alias("keep_a"))
    w = Window.partitionBy(by, "id").orderBy("x", "y")
    pieces = edges.join(starts, [by, "id"]).select(by, "id", F.coalesce(F.lag("y").over(w), F.col("keep_a")).alias("a"), F.col("x").alias("b"))
    return pieces.filter("b > a")


def as_of(left: DataFrame, right: DataFrame, by: str, time: str, values: list[str], slice_us: int = scans.SLICE_US) -> DataFrame:
    """Each left row with the values of the last right row of the key at or before its time."""
    cols = [c for c in left.columns if c not in (by, time)]
    a = left.select(by, time, F.lit(1).alias("_side"), *cols, *(F.lit(None).cast(right.schema[v].dataType).alias(f"_v_{v}") for v in values))
    b = right.select(by, time, F.lit(0).alias("_side"), *(F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols), *(F.col(v).alias(f"_v_{v}") for v in values))
    dealt = scans.deal(a.unionByName(b), [by], time, slice_us)
    found = scans.running(dealt, [by], [time, "_side"], {v: ("last", F.col(f"_v_{v}")) for v in values}, inclusive=True)
    return found.filter("_side = 1").select(by, time, *cols, *values)
