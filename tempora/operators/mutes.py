"""Mute windows of reconciled words: rules, kinds, merged windows, their sources and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions import text as T
from tempora.operators import intervals
from tempora.sources.shared import stored

BUCKET = 10_000_000


def first_bad(words: DataFrame, bad: list[str], ok: list[str]) -> Column:
    """The first bad text of a reconciled word: its text, else the other transcript's; null if none is."""
    pick = lambda c: F.when(T.is_bad(F.coalesce(c, F.lit("")), bad, ok), c)
    return F.coalesce(pick(words["w"]), pick(words["giga"]))


def windows(words: DataFrame, bad: list[str], ok: list[str], whole_stems: list[str], rule: str = "letter", pad_us: int = 30_000) -> DataFrame:
    """src, o, a, b, word, kind of the windows of reconciled words (src, o, w, giga, start_us, end_us).

    A word is muted if either text is bad. The window lies around the middle letter of the first bad
    text (kind `letter`), or is the whole word with `pad_us` on both sides where a stem of `whole_stems`
    is contained (kind `word`): under the rule `letter` in the first bad text, under `clip` in any bad
    text, and windows of at most 1 microsecond go.
    """
    marked = words.withColumn("word", first_bad(words, bad, ok)).filter("word is not null and word <> ''")
    whole = lambda c: F.exists(F.array(*map(F.lit, whole_stems)), lambda s: F.contains(T.norm_word(c), s))
    kind = F.when(whole(F.col("word")), F.lit("word")).otherwise(F.lit("letter"))
    wide = kind == "word"
    if rule == "clip":
        wide = F.exists(F.array("w", "giga"), lambda c: T.is_bad(F.coalesce(c, F.lit("")), bad, ok) & whole(F.coalesce(c, F.lit(""))))
    a, b = T.mute_bounds(F.col("start_us"), F.col("end_us"), F.col("word"))
    out = marked.select("src", "o", F.when(wide, F.col("start_us") - pad_us).otherwise(a).alias("a"), F.when(wide, F.col("end_us") + pad_us).otherwise(b).alias("b"), "word", kind.alias("kind"))
    return out.filter(F.col("b") - F.col("a") > 1) if rule == "clip" else out


def merged(found: DataFrame, by: str = "src") -> DataFrame:
    """by, a, b, n, word, kind: windows that touch become one, with their distinct words in the order in
    which they come, and the kind `word` if one of them has it."""
    order = F.array_sort(F.collect_list(F.struct("a", "b", "word")))
    words = F.array_join(F.array_distinct(F.transform(order, lambda x: x["word"])), ",").alias("word")
    kind = F.when(F.max(F.col("kind") == "word"), F.lit("word")).otherwise(F.min("kind")).alias("kind")
    return intervals.union(found, by, more=[words, kind])


def overlapping(rows: DataFrame, others: DataFrame, row: list[str], flag: str) -> DataFrame:
    """Adds the boolean `flag`: whether an interval of `others` overlaps the row's, ends included."""
    left = rows.select("src", *row, F.col("a").alias("la"), F.col("b").alias("lb"))
    right = others.select("src", F.col("a").alias("ra"), F.col("b").alias("rb"))
    hit = intervals.range_join(left, right, "src", BUCKET, F.lit(True)).select("src", *row).distinct().withColumn(flag, F.lit(True))
    return rows.join(hit, ["src", *row], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def with_sources(whole: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """Merged windows with `source`: `1`, `2` or `1+2`, by the windows of two transcripts that they overlap."""
    whole, one, two = stored(whole, "windows"), stored(one.select("src", "a", "b"), "one"), stored(two.select("src", "a", "b"), "two")
    both = overlapping(stored(overlapping(whole, one, ["a", "b"], "_1"), "flagged"), two, ["a", "b"], "_2")
    return both.withColumn("source", F.when(F.col("_1") & F.col("_2"), "1+2").when(F.col("_1"), "1").otherwise("2")).drop("_1", "_2")


def in_ranges(whole: DataFrame, ranges: DataFrame) -> DataFrame:
    """src, ra, rb, n: windows that overlap each of the few given ranges (ra, rb), ends included; 0 where none does."""
    left = whole.select(F.lit(0).alias("_all"), "src", F.col("a").alias("la"), F.col("b").alias("lb"))
    counts = intervals.range_join(left, ranges.withColumn("_all", F.lit(0)), "_all", BUCKET, F.lit(True)).groupBy("src", "ra", "rb").agg(F.count("*").alias("n"))
    # the result has a row for each source and range
    return whole.select("src").distinct().crossJoin(ranges).join(counts, ["src", "ra", "rb"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def free_starts(words: DataFrame, key: list[str], row: list[str], step_us: int = 1_000) -> DataFrame:
    """Adds `free_us`: words of the same start and key move on by a millisecond each, not past their end."""
    w = Window.partitionBy("src", "start_us", *key).orderBy(*row)
    return words.withColumn("free_us", F.least(F.col("start_us") + (F.row_number().over(w) - 1) * step_us, F.greatest("start_us", "end_us")))


def first_and_whole(inside: DataFrame, first: int = 5) -> DataFrame:
    """tag, src, a, b: the first windows of each source in time, and all of kind `word` once more."""
    w = Window.partitionBy("src").orderBy("a", "b")
    head = inside.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= first).select(F.lit("first").alias("tag"), "src", "a", "b")
    return head.unionByName(inside.filter("kind = 'word'").select(F.lit("word").alias("tag"), "src", "a", "b"))


def sample(rows: DataFrame, key: list[str], n: int = 10, seed: int = 1) -> DataFrame:
    """`n` rows without replacement: those of the smallest md5 of seed and key, the same in every run."""
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in key)))
    return rows.withColumn("_d", draw).orderBy("_d", *key).limit(n).drop("_d").orderBy(*key)


def first_match(texts: DataFrame, words: DataFrame) -> DataFrame:
    """Texts (src, word) with `o`: the first reconciled word that has the text in either transcript."""
    either = words.select("src", "o", F.explode(F.array_distinct(F.array("w", "giga"))).alias("word"))
    return texts.join(either.groupBy("src", "word").agg(F.min("o").alias("o")), ["src", "word"], "left")
