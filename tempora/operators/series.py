"""Time series: loudness buckets, dense grids, robust scores, peaks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tempora.operators import scans, selection
from tempora.sources.shared import stored


def rms_db(x: Column) -> Column:
    return F.lit(20.0) * F.log10(F.greatest(F.sqrt(F.avg(x * x)), F.lit(1e-10)))


def rms_per_bucket(samples: DataFrame) -> DataFrame:
    """src, t, raw_db, n of non-empty buckets; partial sums before the shuffle."""
    return samples.groupBy("src", "t").agg(F.round(rms_db(F.col("x")), 4).alias("raw_db"), F.count("*").alias("n"))


def dense_grid(sparse: DataFrame, grid_of: DataFrame) -> DataFrame:
    """Every src of `sparse` with every t between the overall bounds of `grid_of`; absent values are null."""
    bounds = grid_of.agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    grid = sparse.select("src").distinct().join(F.broadcast(bounds)).select("src", F.explode(F.sequence("lo", "hi")).alias("t"))
    return grid.join(sparse, ["src", "t"], "left")


def voice_masked(features: DataFrame, names: list[str], level: float = -50.0, voice: str = "voice_db") -> DataFrame:
    """Features with those of `names` null where the voice is not over `level`, or unknown."""
    return features.withColumns({n: F.when(F.col(voice) > level, F.col(n)) for n in names})


def robust_z(series: DataFrame, value: str, out: str = "z", by: tuple[str, ...] = ("src",)) -> DataFrame:
    """Median/MAD score per key: scale 1.4826 MAD; 0 where the scale is 0 or the value is missing; within [-3, 6]."""
    centre = series.select(*by).distinct().join(selection.median(series, list(by), value, "_m"), list(by), "left")
    dev = series.join(centre, list(by))
    mad = selection.median(dev.withColumn("_a", F.abs(F.col(value) - F.col("_m"))), list(by), "_a", "_d")
    z = (F.col(value) - F.col("_m")) / (F.lit(1.4826) * F.col("_d"))
    z = F.when(F.col("_d") > 0, F.coalesce(z, F.lit(0.0))).otherwise(0.0)
    return dev.join(mad, list(by), "left").withColumn(out, F.greatest(F.lit(-3.0), F.least(F.lit(6.0), z))).drop("_m", "_d")


def placed(series: DataFrame, place: str | None, by: list[str]) -> tuple[DataFrame, str]:
    """The series and the column that numbers its rows in order of t without gaps; one is made where none is named."""
    return (series, place) if place else (scans.numbered(series, by, ["t"], scans.SLICE_ROWS), "_i")


def rolling_mean(series: DataFrame, value: str, out: str, reach: int = 2, place: str | None = None, slice_rows: int = scans.SLICE_ROWS) -> DataFrame:
    """Centred mean over 2 * reach + 1 rows; edges average what exists. `place`: see `placed`."""
    rows, at = placed(series, place, ["src"])
    mean = scans.beside(rows, ["src"], at, reach, {"_mean": (F.avg(value), -reach, reach)}, slice_rows)
    return mean.withColumn(out, F.round("_mean", 6)).select(*series.columns, *([] if out in series.columns else [out]))


def local_maxima(series: DataFrame, value: str, place: str | None = None, slice_rows: int = scans.SLICE_ROWS) -> DataFrame:
    """Rows not below their neighbours and above one; every row of a src that has none. `place`: see `placed`."""
    rows, at = placed(series, place, ["src"])
    near = scans.beside(rows, ["src"], at, 1, {"_b": (F.first(value), -1, -1), "_a": (F.first(value), 1, 1)}, slice_rows)
    here, before, after = F.col(value), F.col("_b"), F.col("_a")
    peak = (here >= F.coalesce(before, here)) & (here >= F.coalesce(after, here)) & (F.coalesce(here > before, F.lit(False)) | F.coalesce(here > after, F.lit(False)))
    flagged = near.withColumn("_p", peak)
    some = flagged.groupBy("src").agg(F.coalesce(F.max("_p"), F.lit(False)).alias("_any"))
    return flagged.join(some, "src").filter(F.col("_p") | ~F.col("_any")).select(*series.columns)


def nms_top_n(peaks: DataFrame, value: str, gap: int = 45, top: int = 20) -> DataFrame:
    """Greedy choice by value, then time: keep if at least `gap` from all kept, up to `top`. src, rank, t, value.

    A kept peak suppresses at most 2 * gap - 2 others (t is whole, and a src has each t once), so the
    choice is made among the first top * (2 * gap - 1) peaks of a src; only those meet in one task.
    """
    w = Window.partitionBy("src").orderBy(F.desc(value), "t")
    first = peaks.select("src", "t", value).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= top * (2 * gap - 1))
    order = F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("s"), F.col("t").alias("t"))))
    kept = F.aggregate(
        order,
        F.expr("cast(array() as array<struct<s:double,t:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) < top) & ~F.exists(acc, lambda y: F.abs(y["t"] - x["t"]) < gap), F.concat(acc, F.array(x))).otherwise(acc),
    )
    out = first.groupBy("src").agg(kept.alias("kept")).select("src", F.posexplode("kept").alias("p", "k"))
    return out.select("src", (F.col("p") + 1).cast("long").alias("rank"), F.col("k.t").alias("t"), (-F.col("k.s")).alias(value))


def decide(t: np.ndarray, v: np.ndarray, known: np.ndarray, gap: int, low: int, high: int) -> np.ndarray:
    """Of peaks in order of t, of which those from `low` to `high` are at hand: 1 kept, 0 suppressed, -1 open.

    A peak is kept if all that are before it in rank and near it are at hand and suppressed. `known` are kept.
    """
    first, end = np.searchsorted(t, t - gap, side="right"), np.searchsorted(t, t + gap, side="left")
    whole = (t - gap >= low) & (t + gap <= high)
    gone, unsure, out = np.zeros(len(t), bool), np.zeros(len(t), bool), np.where(known, 1, -1)
    for i in np.flatnonzero(known):
        gone[first[i] : end[i]] = True
    for i in np.lexsort((t, -v)).tolist():
        if known[i]:
            continue
        if gone[i]:
            out[i] = 0
        elif whole[i] and not unsure[i]:
            out[i] = 1
            gone[first[i] : end[i]] = True
        else:
            unsure[first[i] : end[i]] = True
    return out


def suppress(peaks: DataFrame, value: str, gap: int = 45, slice_width: int = 1 << 20, rounds: list[int] | None = None) -> DataFrame:
    """src, t, value: the whole greedy choice, without an end: highest value first (the earlier of equals), each kept
    peak suppresses those less than `gap` away. A src has each whole t once; values are not null.

    In rounds: each slice of time, with what lies `gap` around it, decides all peaks that don't hang on
    one outside, and the peaks that it keeps suppress those of its neighbours in the next round, until
    none is open. So a chain of peaks that each hang on the next takes a round a slice, most are
    decided in the first. `rounds` gets how many peaks were left open after each.
    """
    if slice_width < gap:
        raise ValueError("a slice is at least a gap long")
    ddl = f"src {peaks.schema['src'].dataType.simpleString()}, t long, v double, kept boolean, done boolean"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("t")
        t, v, known = (rows.column(c).to_numpy() for c in ("t", "v", "kept"))
        low = key[1].as_py() * slice_width
        found = decide(t, v, known, gap, low - gap, low + slice_width - 1 + gap)
        own = (t >= low) & (t < low + slice_width)
        out = pa.table([rows.column("src"), t, v, found == 1, known | (found == 0)], names=schema.names).cast(schema)
        return out.filter(pa.array(own))

    left = stored(peaks.select("src", F.col("t").cast("long").alias("t"), F.col(value).cast("double").alias("v"), F.lit(False).alias("kept")), "peaks")
    chosen = []
    while True:
        own = F.floor(F.col("t") / slice_width)
        off = F.col("t") - own * slice_width
        slices = F.array_compact(F.array(own, F.when(off < gap, own - 1), F.when(off >= slice_width - gap, own + 1)))
        seen = stored(left.select("*", F.explode(slices).alias("_s")).groupBy("src", "_s").applyInArrow(run, ddl), "decided")
        chosen.append(seen.filter("kept and not done").select("src", "t", F.col("v").alias(value)))
        left = seen.filter("not done").select("src", "t", "v", "kept")  # what is newly kept stays for a round
        n = left.filter("not kept").count()
        if rounds is not None:
            rounds.append(n)
        if not n:
            break
    whole = chosen[0]
    for more in chosen[1:]:
        whole = whole.unionByName(more)
    return whole


def threshold_islands(series: DataFrame, value: str, above: float, gap: int, slice_rows: int = scans.SLICE_ROWS) -> DataFrame:
    """Runs of rows at least `above` over the src's median, joined where they are less than `gap` apart."""
    high = series.join(selection.median(series, ["src"], value, "m"), "src").filter(F.col(value) >= F.col("m") + above)
    before = scans.running(scans.deal(high, ["src"], "t", slice_rows), ["src"], ["t"], {"_t": ("last", F.col("t"))})
    new = F.coalesce(F.col("t") - F.col("_t") >= gap, F.lit(True)).cast("long")
    marked = scans.running(before.withColumn("_n", new), ["src"], ["t"], {"island": ("sum", F.col("_n"))}, inclusive=True)
    return marked.groupBy("src", "island").agg(F.min("t").alias("t_from"), (F.max("t") + 1).alias("t_to"), F.round(F.max(value), 4).alias("peak_db"), F.round(F.max(F.col(value) - F.col("m")), 6).alias("delta_db"))
