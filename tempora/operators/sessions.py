"""Sessions over ordered words: gap islands, stateful folds for captions and phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import scans


def gap_islands(words: DataFrame, gap_us: int, by: str = "src", slice_us: int = scans.SLICE_US) -> DataFrame:
    """Adds `island`: a new one starts where the pause is longer than `gap_us`."""
    order = ["start_us", "o"]
    before = scans.running(scans.deal(words, [by], "start_us", slice_us), [by], order, {"_end": ("last", F.col("end_us"))})
    new = F.coalesce(F.col("start_us") - F.col("_end") > gap_us, F.lit(True)).cast("long")
    return scans.running(before.withColumn("_new", new), [by], order, {"island": ("sum", F.col("_new"))}, inclusive=True).select(*words.columns, "island")


def phrases(words: DataFrame, gap_us: int = 800_000, longest_us: int = 15_000_000, by: str = "src") -> DataFrame:
    """Phrases break at pauses over `gap_us`, or where a word would end later than `longest_us` after the phrase's start.

    The second rule needs the phrase's start, so it is a fold inside each island of the first.
    """
    one = gap_islands(words, gap_us, by).groupBy(by, "island").agg(F.array_sort(F.collect_list(F.struct("start_us", "o", "end_us", "w"))).alias("ws"))
    starts = F.aggregate("ws", F.expr("cast(array() as array<struct<a:bigint,o:bigint>>)"), lambda acc, x: F.when((F.size(acc) == 0) | (x["end_us"] - F.coalesce(F.try_element_at(acc, F.lit(-1))["a"], F.lit(0)) > longest_us), F.concat(acc, F.array(F.struct(x["start_us"].alias("a"), x["o"].cast("long").alias("o"))))).otherwise(acc))
    one = one.withColumn("starts", starts).select(by, "ws", F.posexplode("starts").alias("p", "s"), "starts")
    nxt = F.coalesce(F.try_element_at("starts", F.col("p") + 2)["o"], F.lit(1 << 62))
    own = F.filter("ws", lambda x: (x["o"] >= F.col("s.o")) & (x["o"] < nxt))
    return one.select(by, F.col("s.a").alias("a"), F.array_max(F.transform(own, lambda x: x["end_us"])).alias("b"), F.size(own).cast("long").alias("n"), F.array_join(F.transform(own, lambda x: x["w"]), " ").alias("text"))


def caption_words(words: DataFrame, count: int = 3, chars: int = 18, gap_us: int = 300_000, by: str = "src") -> DataFrame:
    """by, island, grp, start_us, o, end_us, w: the group of each word within its island of close words; a new
    one begins at `count` words or over `chars` characters with blanks."""
    one = gap_islands(words, gap_us, by).groupBy(by, "island").agg(F.array_sort(F.collect_list(F.struct("start_us", "o", "end_us", "w"))).alias("ws"))
    zero = F.expr("named_struct('g', 0L, 'n', 0L, 'c', 0L, 'out', cast(array() as array<bigint>))")

    def step(s, x):
        size = F.length(x["w"]).cast("long")
        new = (s["n"] == 0) | (s["n"] >= count) | (s["c"] + 1 + size > chars)
        g = s["g"] + new.cast("long")
        return F.struct(g.alias("g"), F.when(new, F.lit(1).cast("long")).otherwise(s["n"] + 1).alias("n"), F.when(new, size).otherwise(s["c"] + 1 + size).alias("c"), F.concat(s["out"], F.array(g)).alias("out"))

    folded = one.withColumn("gs", F.aggregate("ws", zero, step)["out"]).select(by, "island", F.explode(F.arrays_zip("ws", "gs")).alias("z"))
    return folded.select(by, "island", F.col("z.gs").alias("grp"), "z.ws.*")


def caption_groups(words: DataFrame, count: int = 3, chars: int = 18, gap_us: int = 300_000, by: str = "src") -> DataFrame:
    """by, island, grp, a, b, n, text of the groups of `caption_words`."""
    row = F.struct("start_us", "o", "end_us", "w")
    return caption_words(words, count, chars, gap_us, by).groupBy(by, "island", "grp").agg(F.min("start_us").alias("a"), F.max("end_us").alias("b"), F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["w"]), " ").alias("text"))


def subtitle_events(words: DataFrame, ends: DataFrame, least_us: int = 50_000, by: str = "src") -> DataFrame:
    """Words (of `caption_words`) with `event_end`: the next word's start in the group, else the group's
    `shown_to` of `ends` (by, island, grp); at least `least_us` after the start."""
    nxt = F.lead("start_us").over(Window.partitionBy(by, "island", "grp").orderBy("start_us", "o"))
    both = words.withColumn("_n", nxt).join(ends.select(by, "island", "grp", "shown_to"), [by, "island", "grp"])
    end = F.coalesce("_n", "shown_to")
    return both.withColumn("event_end", F.when(end <= F.col("start_us"), F.col("start_us") + least_us).otherwise(end)).drop("_n", "shown_to")
