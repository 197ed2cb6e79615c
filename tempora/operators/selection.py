"""Exact medians of long keys: histograms narrow down to the values in the middle, no task holds a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.sources.shared import stored

#: Bins of a value's logarithm (by e), the magnitude below which bins are even, and bins of one bin.
PER_E, SMALL, FINE = 200, 1e-6, 1 << 16
#: Distinct values of a key that one task may hold.
WHOLE = 100_000


def coarse(v: Column) -> Column:
    """A whole number that never falls as v grows: bins of half a percent. NaN is above all."""
    return F.when(F.isnan(v), F.lit(1 << 62)).otherwise(F.floor(F.signum(v) * F.log1p(F.abs(v) / SMALL) * PER_E))


def fine(v: Column, lo: Column, hi: Column) -> Column:
    """The bin of v among `FINE` even ones from lo to hi; it never falls as v grows."""
    share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    return F.when(F.isnan(v) | F.isnan(share), F.lit(FINE)).otherwise(F.floor(share * FINE)).cast("long")


def narrowed(rows: DataFrame, by: list[str]) -> DataFrame:
    """Of each key, from rows (by, v, n, bin, r1, r2: the places that are sought, null for the two in the middle):
    by, bin, lo, hi, r1, r2 of the bin that holds both places, counted from its start, or `done` with the
    values lo and hi at them."""
    bins = rows.groupBy(*by, "bin").agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.first("r1").alias("r1"), F.first("r2").alias("r2"))
    w = Window.partitionBy(*by)
    before = F.coalesce(F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("n").over(w)
    placed = bins.withColumns({"r1": F.coalesce("r1", F.floor((whole - 1) / 2)), "r2": F.coalesce("r2", F.floor(whole / 2)), "before": before})
    hit = placed.filter((F.col("before") <= F.col("r2")) & (F.col("r1") < F.col("before") + F.col("n")))
    # the two places follow each other: in two bins, they are the last value of one and the first of the next
    one = hit.groupBy(*by).agg(
        F.count("*").alias("c"), F.min("bin").alias("bin"), F.min("lo").alias("first"), F.min_by("hi", "bin").alias("a"), F.max_by("lo", "bin").alias("b"), F.max("hi").alias("last"),
        F.min(F.col("r1") - F.col("before")).alias("q1"), F.min(F.col("r2") - F.col("before")).alias("q2"),
    )
    done = (F.col("c") == 2) | F.col("first").eqNullSafe(F.col("last"))
    return one.select(*by, "bin", F.when(done, F.col("a")).otherwise(F.col("first")).alias("lo"), F.when(done, F.col("b")).otherwise(F.col("last")).alias("hi"), F.col("q1").alias("r1"), F.col("q2").alias("r2"), done.alias("done"))


def median(rows: DataFrame, by: list[str], value: str, out: str, whole: int = WHOLE) -> DataFrame:
    """by, out: the exact median of a key's values that are not null, as `median` gives it; keys without one are left out.

    Equal values are counted first, each key's spread over all tasks. A histogram of their coarse bins
    finds the bin with the middle, one of even bins in there a narrower one, and only its values are
    put in order. Keys that are decided early (one value, or a middle between two bins) go no further.
    Where no key has more than `whole` distinct values, they are put in order at once: the same result.
    """
    valued = rows.select(*by, F.col(value).cast("double").alias("v")).filter("v is not null")
    left = stored(valued.groupBy(*by, "v").agg(F.count("*").alias("n")), "values")
    most = left.groupBy(*by).count().agg(F.max("count")).first()[0]
    if (most or 0) <= whole:
        return left.groupBy(*by).agg(F.percentile("v", 0.5, F.col("n")).alias(out))
    left = left.withColumns({"r1": F.lit(None).cast("long"), "r2": F.lit(None).cast("long"), "bin": coarse(F.col("v"))})
    steps = [lambda v, lo, hi: fine(v, lo, hi), lambda v, lo, hi: v]
    found = []
    for step in [*steps, None]:
        at = narrowed(left, by)
        found.append(at.filter("done").select(*by, "lo", "hi"))
        if step:
            inside = at.filter(~F.col("done")).select(*by, "bin", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("r1").alias("_r1"), F.col("r2").alias("_r2"))
            left = left.drop("r1", "r2").join(inside, [*by, "bin"]).select(*by, "v", "n", F.col("_r1").alias("r1"), F.col("_r2").alias("r2"), step(F.col("v"), F.col("_lo"), F.col("_hi")).alias("bin"))
    middle = found[0].unionByName(found[1]).unionByName(found[2])
    same = F.col("lo") == F.col("hi")
    # a row a key, kept so that what is joined with it doesn't find it anew
    return stored(middle.select(*by, F.when(same, F.col("lo")).otherwise(0.5 * F.col("lo") + 0.5 * F.col("hi")).alias(out)), "medians")
