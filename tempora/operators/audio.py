"""Sound: loudness of whole windows and of intervals, quiet seams, transcript segments that no one said."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import intervals, scans
from tempora.sources.shared import stored

def window_loudness(samples: DataFrame, size: int, floor_db: float = -200.0) -> DataFrame:
    """src, k, db of whole windows of `size` samples (src, pos, x); a window that is not full is left out."""
    mean = F.avg(F.col("x") * F.col("x"))
    db = F.when(mean > 0, F.greatest(F.lit(floor_db), 10 * F.log10(mean))).otherwise(floor_db)
    whole = samples.groupBy("src", F.floor(F.col("pos") / size).cast("long").alias("k")).agg(F.round(db, 4).alias("db"), F.count("*").alias("n"))
    return whole.filter(F.col("n") == size).select("src", "k", "db")


def interval_loudness(samples: DataFrame, spans: DataFrame, bucket: int) -> DataFrame:
    """src, ord, db: loudness of the samples (src, t, x) in each span [a, b) (src, ord, a, b); spans without one are left out."""
    left = samples.select("src", "x", F.col("t").alias("la"), F.col("t").alias("lb"))
    right = spans.select("src", "ord", F.col("a").alias("ra"), F.col("b").alias("rb"))
    met = intervals.range_join(left, right, "src", bucket, F.col("la") < F.col("rb"))
    return met.groupBy("src", "ord").agg(F.round(20 * F.log10(F.sqrt(F.avg(F.col("x") * F.col("x"))) + 1e-12), 4).alias("db"))


def quiet_chunks(levels: DataFrame, step: int = 18, search: int = 6, least: int = 1, slice_rows: int = 4096) -> DataFrame:
    """src, k, a, b: each series (src, i from 0 without gaps, x) cut into chunks of at most `step` rows.

    A chunk ends at the quietest row (the first of equals) of the last `search` rows that it may have;
    the last one ends with the series, and one shorter than `least` is dropped. Where a chunk ends
    follows from where it begins, so a series is a chain of seams. Slices of rows are walked
    from each of the `step` rows at which the chain can enter them; the entries that it takes are found
    by pointer doubling, and each slice is walked once more from its own.
    """
    if not 0 < search <= step - least or slice_rows < step:
        raise ValueError("search is at most step - least, and slice_rows at least step")
    total = levels.groupBy("src").agg((F.max("i") + 1).alias("n"))
    seam = scans.beside(levels.select("src", "i", "x"), ["src"], "i", step - 1, {"s": (F.min(F.struct("x", "i")), step - search, step - 1)}, slice_rows)
    ends = seam.join(total, "src").select("src", "i", "n", F.when(F.col("n") - F.col("i") > step, F.col("s.i")).otherwise(F.col("n")).alias("e"))
    width = F.lit(slice_rows)
    slices = ends.groupBy("src", F.floor(F.col("i") / width).alias("p")).agg(F.array_sort(F.collect_list(F.struct("i", "e"))).alias("r"), F.max("n").alias("n"))
    slices = stored(slices.select("src", "p", "n", F.transform("r", lambda r: r["e"]).alias("e")), "seams")
    first, last = F.col("p") * width, F.least(F.col("n"), (F.col("p") + 1) * width)
    turns = F.sequence(F.lit(0), F.ceil(width / (step - search)).cast("int"))

    def leaves(entry):
        """Where the chain that enters at row `entry` is once it has left the slice."""
        return F.aggregate(turns, entry, lambda at, _: F.when(at < last, F.get("e", (at - first).cast("int"))).otherwise(at))

    entries = slices.select("src", F.explode(F.transform(F.sequence(first, F.least(first + step, last) - 1), lambda i: F.struct(i.alias("at"), leaves(i).alias("to")))).alias("x")).select("src", "x.*")
    most = slices.agg(F.max("p").alias("p")).first().p or 0
    taken, jump = slices.filter("p = 0").select("src", F.lit(0).cast("long").alias("at")), entries
    for k in range(int(most).bit_length()):
        step_to = jump.select("src", F.col("at").alias("from"), "to")
        if k:
            jump = stored(jump.join(step_to.select("src", F.col("from").alias("to"), F.col("to").alias("then")), ["src", "to"]).select("src", "at", F.col("then").alias("to")), "jumps")
            step_to = jump.select("src", F.col("at").alias("from"), "to")
        onward = taken.select("src", F.col("at").alias("from")).join(step_to, ["src", "from"]).select("src", F.col("to").alias("at"))
        taken = stored(taken.unionByName(onward), "entries")
    # a chain enters each slice once; what it reaches past the end of the series is in no slice
    at = taken.select("src", "at", F.floor(F.col("at") / width).alias("p"))
    walk = lambda acc, _: F.when(F.element_at(acc, -1) < last, F.concat(acc, F.array(F.get("e", (F.element_at(acc, -1) - first).cast("int"))))).otherwise(acc)
    chain = slices.join(at, ["src", "p"]).filter(F.col("at") < F.col("n")).select("src", "p", F.aggregate(turns, F.array("at"), walk).alias("c"))
    done = scans.running(scans.deal(chain.withColumn("m", F.size("c") - 1), ["src"], "p", scans.SLICE_ROWS), ["src"], ["p"], {"before": ("sum", F.col("m").cast("long"))})
    pairs = done.select("src", "before", "c", F.posexplode(F.slice("c", 2, F.size("c"))).alias("j", "b"))
    return pairs.select("src", (F.col("before") + F.col("j")).alias("k"), F.get("c", F.col("j")).alias("a"), "b").filter(F.col("b") - F.col("a") >= least)


#: Credits that speech models put into silence, and phrases that they are fond of there.
CREDITS = ["субтитры делал", "субтитры сделал", "субтитры создавал", "субтитры подготовил"]
NAMED_CREDIT = r"(?iu:редактор\s+субтитров|корректор)\s+[A-ZА-ЯЁ]\.\s*[A-ZА-ЯЁ][\p{L}\p{N}_]*"
BARE_CREDITS = ["редактор субтитров", "корректор"]
FAREWELLS = ["продолжение следует", "спасибо за просмотр", "спасибо за внимание", "подписывайтесь", "ставьте лайки", "до новых встреч", "продолжение в следующей", "subscribe", "thanks for watching"]


def not_said(text: Column, no_speech: Column, logprob: Column, credits: list[str] = CREDITS, named: str = NAMED_CREDIT, bare: list[str] = BARE_CREDITS, farewells: list[str] = FAREWELLS) -> Column:
    """Whether a transcript segment is made up: a credit, likely no speech, or a stock phrase of low confidence."""
    said = F.lower(text)
    holds = lambda phrases: F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(said, p))
    unsure = (no_speech > 0.5) | (logprob < -0.7)
    return F.coalesce(holds(credits) | text.rlike(named) | ((no_speech > 0.7) & (logprob < -0.6)) | ((holds(farewells) | holds(bare)) & unsure), F.lit(False))


def loud_second(voice_db: Column, scream: Column, laugh: Column, level: float = -32.0) -> Column:
    """A second with a loud voice, a scream or a laugh; missing values count as none."""
    return F.coalesce(voice_db > level, F.lit(False)) | F.coalesce(scream > 0.35, F.lit(False)) | F.coalesce(laugh > 0.20, F.lit(False))
