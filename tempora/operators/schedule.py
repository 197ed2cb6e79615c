"""Clip schedules: pieces that stay, time remapping, captions' ends, rails, envelopes and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import intervals, scans
from tempora.operators.sessions import gap_islands
from tempora.sources.shared import stored

#: A time before all others.
HEAD = -(1 << 62)


def gap_policy(islands: DataFrame, cut_us: int = 450_000, half_us: int = 125_000, by: str = "src") -> DataFrame:
    """Pieces over disjoint islands: pauses up to `cut_us` stay, of longer ones `half_us` on each side. by, a, b, n."""
    before = scans.running(scans.deal(islands, [by], "a", scans.SLICE_US), [by], ["a"], {"_b": ("last", F.col("b"))})
    new = F.coalesce(F.col("a") - F.col("_b") > cut_us, F.lit(False)).cast("long")
    marked = scans.running(before.withColumn("_new", new), [by], ["a"], {"_g": ("sum", F.col("_new"))}, inclusive=True)
    runs = marked.groupBy(by, "_g").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n"))
    last = F.col("_g") == F.col("_last")
    ended = runs.join(runs.groupBy(by).agg(F.max("_g").alias("_last")), by)
    return ended.select(by, F.when(F.col("_g") > 0, F.col("a") - half_us).otherwise(F.col("a")).alias("a"), F.when(last, F.col("b")).otherwise(F.col("b") + half_us).alias("b"), "n")


def merge_short(pieces: DataFrame, least_us: int = 250_000, by: str = "src", slice_us: int = scans.SLICE_US) -> DataFrame:
    """Disjoint pieces shorter than `least_us` join the piece before them, or the one after if they are first. by, a, b.

    What the fixpoint comes to: the first piece takes in all that follow until it is long enough
    itself; after that, each long piece begins a new one and short ones belong to it.
    """
    pieces = stored(pieces.select(by, "a", "b"), "pieces")
    start = pieces.groupBy(by).agg(F.min("a").alias("_a0"))
    enough = pieces.join(start, by).filter(F.col("b") - F.col("_a0") >= least_us).groupBy(by).agg(F.min("b").alias("_b0"))
    new = F.coalesce((F.col("b") > F.col("_b0")) & (F.col("b") - F.col("a") >= least_us), F.lit(False)).cast("long")
    marked = pieces.join(enough, by, "left").withColumn("_new", new)
    placed = scans.running(scans.deal(marked, [by], "a", slice_us), [by], ["a", "b"], {"_g": ("sum", F.col("_new"))}, inclusive=True)
    return placed.groupBy(by, "_g").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("_g")


def caption_ends(groups: DataFrame, tail_us: int = 150_000, by: str = "src", limit: str | None = None) -> DataFrame:
    """Adds `shown_to`: `tail_us` after the last word, not past the next group's start nor the column `limit`
    (the segment's end), never before the last word's end."""
    nxt = F.lead("a").over(Window.partitionBy(by).orderBy("a", "b"))
    return groups.withColumn("shown_to", F.greatest(F.col("b"), F.least(F.col("b") + tail_us, F.coalesce(nxt, F.col("b") + tail_us), *([F.col(limit)] if limit else []))))


def rails(words: DataFrame, fillers: list[str], first_fillers: list[str], gap_us: int = 300_000, count: int = 5, longest_us: int = 2_200_000, lead_us: int = 80_000, tail_us: int = 500_000, by: str = "src") -> DataFrame:
    """Lines of words: by, a, b, n, text, shown_from, shown_to.

    A line breaks at pauses over `gap_us`, at `count` words or where it would last over `longest_us`.
    A single word stays only if both pauses around it are over `gap_us`. Fillers are dropped
    everywhere, `first_fillers` only in front of other words; empty lines go.
    """
    one = gap_islands(words, gap_us, by).groupBy(by, "island").agg(F.array_sort(F.collect_list(F.struct("start_us", "o", "end_us", "w"))).alias("ws"))
    zero = F.expr("named_struct('g', 0L, 'n', 0L, 's', 0L, 'out', cast(array() as array<bigint>))")

    def step(s, x):
        new = (s["n"] == 0) | (s["n"] >= count) | (x["end_us"] - s["s"] > longest_us)
        g = s["g"] + new.cast("long")
        return F.struct(g.alias("g"), F.when(new, F.lit(1).cast("long")).otherwise(s["n"] + 1).alias("n"), F.when(new, x["start_us"]).otherwise(s["s"]).alias("s"), F.concat(s["out"], F.array(g)).alias("out"))

    flat = one.withColumn("gs", F.aggregate("ws", zero, step)["out"]).select(by, "island", F.explode(F.arrays_zip("ws", "gs")).alias("z"))
    lines = flat.groupBy(by, "island", F.col("z.gs").alias("grp")).agg(F.array_sort(F.collect_list("z.ws")).alias("ws")).withColumn("a", F.col("ws")[0]["start_us"]).withColumn("b", F.element_at("ws", -1)["end_us"])
    w = Window.partitionBy(by).orderBy("island", "grp")
    alone = F.coalesce(F.col("a") - F.lag("b").over(w) > gap_us, F.lit(True)) & F.coalesce(F.lead("a").over(w) - F.col("b") > gap_us, F.lit(True))
    lines = lines.withColumn("_ok", (F.size("ws") > 1) | alone).filter("_ok")
    said = lambda x: F.lower(F.trim(x["w"]))
    words_left = F.filter("ws", lambda x, i: ~said(x).isin(fillers) & ~((i == 0) & (F.size("ws") > 1) & said(x).isin(first_fillers)))
    left = lines.withColumn("ws", words_left).filter("size(ws) > 0")
    left = left.select(by, "island", "grp", F.col("ws")[0]["start_us"].alias("a"), F.element_at("ws", -1)["end_us"].alias("b"), F.element_at("ws", -1)["start_us"].alias("last"), F.size("ws").cast("long").alias("n"), F.array_join(F.transform("ws", lambda x: x["w"]), " ").alias("text"))
    nxt = F.lead("a").over(w) - lead_us
    out = F.greatest(F.least(F.col("b") + tail_us, F.coalesce(nxt, F.col("b") + tail_us)), F.col("last"))
    return left.select(by, "a", "b", "n", "text", F.greatest(F.lit(0).cast("long"), F.col("a") - lead_us).alias("shown_from"), out.alias("shown_to"))


def with_offsets(keeps: DataFrame, by: str = "src", speed: str | None = None) -> DataFrame:
    """Adds `off`: the length of the keeps before this one, as they are shown (divided by the column `speed`)."""
    length = F.col("b") - F.col("a")
    shown = F.bround(length / F.col(speed)).cast("long") if speed else length
    return scans.running(scans.deal(keeps, [by], "id", scans.SLICE_ROWS), [by], ["id"], {"off": ("sum", shown)}).select(*keeps.columns, "off")


def remap(points: DataFrame, keeps: DataFrame, row: list[str], bucket: int = 10_000_000, by: str = "src") -> DataFrame:
    """Points (by, row, t) with `out`: their time after the cuts; the first keep counts, both ends are in; null if cut."""
    left = points.select(by, *row, "t", F.col("t").alias("la"), F.col("t").alias("lb"))
    right = with_offsets(keeps, by).select(by, "id", "off", F.col("a").alias("ra"), F.col("b").alias("rb"))
    met = intervals.range_join(left, right, by, bucket, F.lit(True))
    out = met.groupBy(by, *row).agg(F.min_by(F.col("off") + F.col("t") - F.col("ra"), "id").alias("out"))
    return points.join(out, [by, *row], "left")


def nearest(points: DataFrame, keeps: DataFrame, row: list[str], by: str = "src", slice_us: int = scans.SLICE_US) -> DataFrame:
    """Points (by, row, t) with the nearest of disjoint keeps [a, b): near_id, dist, snapped.

    Only the last keep that starts at or before a point and the first after it can be nearest; the
    earlier wins a tie. A point at or past an end is 1 ms farther, and snaps to 1 ms before it.
    A keep brings the next one with it, and a row before all times the first, so points are put in
    order once, slice by slice.
    """
    kind = "struct<id:bigint,a:bigint,b:bigint,next:struct<id:bigint,a:bigint,b:bigint>>"
    keep = F.struct("id", "a", "b")
    # keeps in falling order: what came before is the next one
    back = scans.running(scans.deal(keeps.select(by, "id", "a", "b", (-F.col("a")).alias("_a")), [by], "_a", slice_us), [by], ["_a"], {"next": ("last", keep)})
    begun = back.select(by, F.col("a").alias("t"), F.struct("id", "a", "b", "next").cast(kind).alias("k"))
    none = F.lit(None).cast("long")
    head = keeps.groupBy(by).agg(F.min_by(keep, "a").alias("next")).select(by, F.lit(HEAD).alias("t"), F.struct(none.alias("id"), none.alias("a"), none.alias("b"), F.col("next")).cast(kind).alias("k"))
    both = points.select(by, *row, "t", F.lit(None).cast(kind).alias("k"), F.lit(1).alias("_side")).unionByName(begun.unionByName(head).select(by, *(F.lit(None).cast(points.schema[c].dataType).alias(c) for c in row), "t", "k", F.lit(0).alias("_side")))
    near = scans.running(scans.deal(both, [by], "t", slice_us), [by], ["t", "_side"], {"p": ("last", F.col("k"))}).filter("_side = 1")
    p, q = F.col("p"), F.col("p.next")
    dp = F.when(F.col("t") < p["b"], F.lit(0).cast("long")).otherwise(F.col("t") - p["b"] + 1000)
    dq = q["a"] - F.col("t")
    first = p["id"].isNotNull() & (q["id"].isNull() | (dp <= dq))
    near = near.select(by, *row, "t", F.when(first, p["id"]).otherwise(q["id"]).alias("near_id"), F.when(first, p["a"]).otherwise(q["a"]).alias("_a"), F.when(first, p["b"]).otherwise(q["b"]).alias("_b"), F.when(first, dp).otherwise(dq).alias("dist"))
    snap = F.when(F.col("t") < F.col("_a"), F.col("_a")).when(F.col("t") >= F.col("_b"), F.col("_b") - 1000).otherwise(F.col("t"))
    return near.select(by, *row, "t", "near_id", "dist", snap.alias("snapped"))


def envelope(points: DataFrame, punches: DataFrame, row: list[str], scale: float = 1.3, dur_us: int = 1_000_000, attack_us: int = 70_000, release_us: int = 250_000, by: str = "src") -> DataFrame:
    """Points (by, row, t) with `zoom`: 1 plus the greatest ramp of the punches (by, t0) that are on."""
    left = points.select(by, *row, "t", F.col("t").alias("la"), F.col("t").alias("lb"))
    right = punches.select(by, "t0", F.col("t0").alias("ra"), (F.col("t0") + dur_us).alias("rb"))
    ramp = F.least((F.col("t") - F.col("t0")) / attack_us, (F.col("t0") + dur_us - F.col("t")) / release_us, F.lit(1.0))
    on = intervals.range_join(left, right, by, dur_us, F.lit(True)).groupBy(by, *row).agg((1 + F.max(F.greatest(ramp, F.lit(0.0)) * (scale - 1))).alias("zoom"))
    return points.join(on, [by, *row], "left").withColumn("zoom", F.coalesce("zoom", F.lit(1.0)))


def tighten_report(before: DataFrame, after: DataFrame, by: str = "src") -> DataFrame:
    """by (null: all), before_us, after_us, pieces, cut_pct (0 if there was nothing)."""
    both = before.select(by, (F.col("b") - F.col("a")).alias("x"), F.lit(0).cast("long").alias("y"), F.lit(0).alias("p")).unionByName(after.select(by, F.lit(0).cast("long").alias("x"), (F.col("b") - F.col("a")).alias("y"), F.lit(1).alias("p")))
    total = both.rollup(by).agg(F.sum("x").alias("before_us"), F.sum("y").alias("after_us"), F.sum("p").alias("pieces"))
    return total.withColumn("cut_pct", F.when(F.col("before_us") != 0, F.round(100 * (1 - F.col("after_us") / F.col("before_us")), 4)).otherwise(0.0))


def to_output(points: DataFrame, keeps: DataFrame, row: list[str], by: str = "src", bucket: int = 10_000_000) -> DataFrame:
    """by, row, id, t, local_us, out_us of points (by, row, t) in each keep [a, b) that holds them, in its three clocks."""
    left = points.select(by, *row, "t", F.col("t").alias("la"), F.col("t").alias("lb"))
    right = with_offsets(keeps, by, "speed").select(by, "id", "off", "speed", F.col("a").alias("ra"), F.col("b").alias("rb"))
    local = F.bround((F.col("t") - F.col("ra")) / F.col("speed")).cast("long")
    return intervals.range_join(left, right, by, bucket, F.col("la") < F.col("rb")).select(by, *row, "id", "t", local.alias("local_us"), (F.col("off") + local).alias("out_us"))


def near_times(words: DataFrame, times: DataFrame, row: list[str], flag: str, within_us: int = 50_000, by: str = "src") -> DataFrame:
    """Adds the boolean `flag`: whether one of `times` (by, t) is at most `within_us` from the word's start."""
    left = words.select(by, *row, (F.col("start_us") - within_us).alias("la"), (F.col("start_us") + within_us).alias("lb"))
    right = times.select(by, F.col("t").alias("ra"), F.col("t").alias("rb"))
    hit = intervals.range_join(left, right, by, 10_000_000, F.lit(True)).select(by, *row).distinct().withColumn(flag, F.lit(True))
    return words.join(hit, [by, *row], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def hero_windows(heroes: DataFrame, keeps: DataFrame, by: str = "src") -> DataFrame:
    """by, id, a, b: windows (by, id, from_us, to_us) of source time in output time, cut to their segment; empty ones go."""
    seg = with_offsets(keeps, by, "speed").withColumn("dur", F.bround((F.col("b") - F.col("a")) / F.col("speed")).cast("long"))
    at = lambda c: F.least(F.greatest(F.col("off") + F.bround((F.col(c) - F.col("a")) / F.col("speed")).cast("long"), F.col("off")), F.col("off") + F.col("dur"))
    return heroes.join(seg, [by, "id"]).select(by, "id", at("from_us").alias("_a"), at("to_us").alias("b")).withColumnRenamed("_a", "a").filter("b > a")


def violations(edits: DataFrame, width: int = 1920, height: int = 1080) -> DataFrame:
    """src, id, rule: what is wrong with segments (a, b, speed, broll, focus, crop as x, y, w, h; null: none), one row a fault."""
    crop = F.col("crop")
    fault = lambda bad, name: F.when(F.coalesce(bad, F.lit(False)), F.lit(name))
    faults = [
        fault(F.col("b") <= F.col("a"), "empty segment"),
        fault(~F.col("speed").between(1, 2), "speed"),
        fault(F.col("broll").isNotNull() & (F.abs(F.col("speed") - 1) > 1e-9), "b-roll at another speed"),
        fault(~F.col("focus").isin("cam", "game"), "focus"),
        fault((crop["w"] <= 0) | (crop["h"] <= 0), "empty crop"),
        fault((crop["x"] < 0) | (crop["y"] < 0) | (crop["x"] + crop["w"] > width) | (crop["y"] + crop["h"] > height), "crop outside"),
    ]
    return edits.select("src", "id", F.explode(F.array_compact(F.array(*faults))).alias("rule"))


def loud_islands(words: DataFrame, seconds: DataFrame, keeps: DataFrame, pad_us: int = 120_000, gap_us: int = 450_000, bucket: int = 10_000_000) -> DataFrame:
    """src, id, a, b, n: in each segment the words wholly in it, padded and cut to it, and the loud seconds
    (src, t) that begin in it or less than a second before; pieces at most `gap_us` apart are one."""
    seg = keeps.select("src", "id", F.col("a").alias("ra"), F.col("b").alias("rb"))
    w = words.select("src", F.col("start_us").alias("la"), F.col("end_us").alias("lb"))
    spoken = intervals.range_join(w, seg, "src", bucket, (F.col("la") >= F.col("ra")) & (F.col("lb") <= F.col("rb")))
    loud = seconds.select("src", (F.col("t") * 1_000_000).alias("la"), (F.col("t") * 1_000_000 + 1_000_000).alias("lb"))
    heard = intervals.range_join(loud, seg, "src", bucket, (F.col("la") > F.col("ra") - 1_000_000) & (F.col("la") < F.col("rb")))
    cut = lambda df, pad: df.select("src", "id", F.greatest("ra", F.col("la") - pad).alias("a"), F.least("rb", F.col("lb") + pad).alias("b"))
    both = cut(spoken, pad_us).unionByName(cut(heard, 0)).withColumn("key", F.struct("src", "id"))
    return intervals.union(both, "key", gap_us).select("key.src", "key.id", "a", "b", "n")
