"""Ranking: weighted scores of features in long form, candidates with their surroundings, recall."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import intervals
from tempora.sources.shared import stored


def to_long(series: DataFrame, features: list[str]) -> DataFrame:
    """src, t, feature, x: one row for each feature."""
    return series.unpivot(["src", "t"], [F.col(f).cast("double").alias(f) for f in features], "feature", "x")


def weighted_scores(scored: DataFrame, config: DataFrame) -> DataFrame:
    """cfg, src, t, score, top: the sum of weight * z of each configuration, and its two greatest parts."""
    part = scored.join(config, "feature").select("cfg", "src", "t", "feature", (F.col("weight") * F.col("z")).alias("v"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("v")).alias("m"), F.col("feature").alias("f"))))
    return part.groupBy("cfg", "src", "t").agg(F.sum("v").alias("score"), F.array_join(F.transform(F.slice(order, 1, 2), lambda x: x["f"]), ",").alias("top"))


def with_band_max(points: DataFrame, series: DataFrame, value: str, reach: int) -> DataFrame:
    """Adds `around`: the greatest value at most `reach` from each point (src, t)."""
    left = points.select("src", "t", (F.col("t") - reach).alias("la"), (F.col("t") + reach).alias("lb")).distinct()
    right = series.select("src", F.col("t").alias("ra"), F.col("t").alias("rb"), F.col(value).alias("_v"))
    found = intervals.range_join(left, right, "src", 2 * reach + 1, F.lit(True)).groupBy("src", "t").agg(F.max("_v").alias("around"))
    return points.join(found, ["src", "t"], "left")


def hits(points: DataFrame, refs: DataFrame, pad: int) -> DataFrame:
    """src, t, rank, ord: references (src, ord, a, b), padded on both sides, that hold a point."""
    left = points.select("src", "t", "rank", F.col("t").alias("la"), F.col("t").alias("lb"))
    right = refs.select("src", "ord", (F.col("a") - pad).alias("ra"), (F.col("b") + pad).alias("rb"))
    return intervals.range_join(left, right, "src", 64, F.lit(True)).select("src", "t", "rank", "ord")


def with_reference(points: DataFrame, refs: DataFrame, pad: int = 5) -> DataFrame:
    """Adds `ref`: the first reference in its own order that holds the point; null if none does."""
    return points.join(hits(points, refs, pad).groupBy("src", "t").agg(F.min("ord").alias("ref")), ["src", "t"], "left")


def recall_at(points: DataFrame, refs: DataFrame, ks: list[int], pad: int = 5) -> DataFrame:
    """src (null: all), k, refs, found: references that one of the first k points hits."""
    first = hits(points, refs, pad).groupBy("src", "ord").agg(F.min("rank").alias("first"))
    all_ = refs.select("src", "ord").join(first, ["src", "ord"], "left").select("src", "first", F.explode(F.array(*(F.lit(k) for k in ks))).alias("k"))
    out = all_.groupBy("k", "src").agg(F.count("*").alias("refs"), F.count_if(F.col("first") <= F.col("k")).alias("found"))
    total = out.groupBy("k").agg(F.lit(None).cast("string").alias("src"), F.sum("refs").alias("refs"), F.sum("found").alias("found"))
    return out.unionByName(total).select("src", F.col("k").cast("long").alias("k"), "refs", "found")


def dedupe_in_time(words: DataFrame, word: str, within_us: int = 250_000) -> DataFrame:
    """src, word, start_us, end_us, o without words that start at most `within_us` after the last kept one of the same
    src and word.

    Kept words of a key are ordered in time, so the last one decides. A word with a longer pause before
    it is kept anyway and begins a run, and what starts within the time of that goes: both are told in
    one pass in order. Only the rest, which runs that last longer have, is folded, run by run.
    """
    w = Window.partitionBy("src", word).orderBy("start_us", "end_us", "o")
    narrow = words.select("src", word, "start_us", "end_us", "o").repartition("src", word)
    begins = F.coalesce(F.col("start_us") - F.lag("start_us").over(w) > within_us, F.lit(True))
    runs = narrow.withColumn("_new", begins).withColumn("_run", F.last(F.when(F.col("_new"), F.col("start_us")), True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # half of the words or fewer where they come twice; both parts below are read from it
    left = stored(runs.filter(F.col("_new") | (F.col("start_us") - F.col("_run") > within_us)), "runs")
    row = F.struct("start_us", "end_us", "o")
    kept = F.aggregate(
        F.array_sort(F.collect_list(row)),
        F.expr("cast(array() as array<struct<start_us:bigint,end_us:bigint,o:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) == 0) | (x["start_us"] - F.try_element_at(acc, F.lit(-1))["start_us"] > within_us), F.concat(acc, F.array(x))).otherwise(acc),
    )
    folded = left.filter("not _new").groupBy("src", word, "_run").agg(kept.alias("_k")).select("src", word, F.explode("_k").alias("x")).select("src", word, "x.*")
    return left.filter("_new").select("src", word, "start_us", "end_us", "o").unionByName(folded)


#: The score presets, as weights of features.
PRESETS = {
    "A_raw": {"raw_db": 1.0},
    "B_voice": {"voice_db": 1.0},
    "C_voice_arousal": {"voice_db": 1.0, "arousal": 1.0},
    "D_laugh_scream": {"voice_db": 1.0, "laugh": 1.0, "scream": 1.0},
    "E_all": {"voice_db": 1.0, "arousal": 1.0, "laugh": 1.0, "scream": 1.0, "emo_positive": 0.5, "emo_angry": 0.5, "markers": 0.5},
    "F_all_novalence": {"voice_db": 1.0, "arousal": 1.0, "laugh": 1.0, "scream": 1.0, "markers": 0.5},
    "G_voice_arousal_laugh_scream_pos": {"voice_db": 1.0, "arousal": 1.0, "scream": 1.0, "laugh": 1.0, "markers": 0.5, "emo_positive": 0.5},
}


def preset_rows(presets: dict[str, dict[str, float]] = PRESETS) -> list[tuple[str, str, float]]:
    """(cfg, feature, weight) rows of a configuration table."""
    return [(cfg, feature, weight) for cfg, own in presets.items() for feature, weight in own.items()]


def contributions(scored: DataFrame, config: DataFrame, top: int = 5) -> DataFrame:
    """cfg, src, t, score, contrib: the score and its `top` greatest parts as array<struct<k, v>>, greatest first."""
    part = scored.join(F.broadcast(config), "feature").select("cfg", "src", "t", "feature", (F.col("weight") * F.col("z")).alias("v"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("v")).alias("m"), F.col("feature").alias("f"))))
    pairs = F.transform(F.slice(order, 1, top), lambda x: F.struct(x["f"].alias("k"), F.round(-x["m"], 4).alias("v")))
    return part.groupBy("cfg", "src", "t").agg(F.round(F.sum("v"), 6).alias("score"), pairs.alias("contrib"))


def with_text(points: DataFrame, words: DataFrame, row: list[str], reach_us: int) -> DataFrame:
    """Adds `text`: the words (src, o, w, start_us) that start at most `reach_us` from the point (src, row, t), in order."""
    left = points.select("src", *row, (F.col("t") - reach_us).alias("la"), (F.col("t") + reach_us).alias("lb"))
    right = words.select("src", F.struct("start_us", "o", "w").alias("x"), F.col("start_us").alias("ra"), F.col("start_us").alias("rb"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["w"]), " ").alias("text")
    found = intervals.range_join(left, right, "src", 2 * reach_us + 1, F.lit(True)).groupBy("src", *row).agg(said)
    return points.join(found, ["src", *row], "left")
