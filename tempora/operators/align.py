"""Reconciling two transcripts of one recording: alignment inside each segment, times from one, text from the other."""

from __future__ import annotations

import difflib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempora.operators import intervals

#: A row of the result, and a stretch of two word lists that is treated alike: words [i, i_end) of one, [j, j_end) of the other.
ROW = "struct<w:string,other:string,start_us:bigint,end_us:bigint,op:string>"
STRETCH = "array<struct<op:string,i:int,i_end:int,j:int,j_end:int>>"
#: Timed words without a counterpart stay if they are no longer than this.
SHORT = 4


def stretches(timed: pa.Array, spoken: pa.Array) -> pa.Array:
    """How each pair of word lists becomes equal: runs that are equal, replaced, deleted or inserted."""
    found = [difflib.SequenceMatcher(None, t, s, autojunk=False).get_opcodes() for t, s in zip(timed.to_pylist(), spoken.to_pylist(), strict=True)]
    fields = ("op", "i", "i_end", "j", "j_end")
    kind = pa.list_(pa.struct([("op", pa.string()), *((f, pa.int32()) for f in fields[1:])]))
    return pa.array([[dict(zip(fields, one, strict=True)) for one in ops] for ops in found], kind)


def row(w: Column, other: Column, start: Column, end: Column, op: str) -> Column:
    return F.struct(w.alias("w"), other.alias("other"), start.cast("long").alias("start_us"), end.cast("long").alias("end_us"), F.lit(op).alias("op")).cast(ROW)


def dropped(old: Column, keep: Callable[[Column], Column]) -> Column:
    """Timed words that no one else heard: short ones and those that `keep` names stay."""
    stay = F.filter(old, lambda x: F.length(x["norm"]).between(1, SHORT) | keep(x["norm"]))
    return F.transform(stay, lambda x: row(x["w"], x["w"], x["start_us"], x["end_us"], "del"))


def added(new: Column) -> Column:
    """Spoken words without a counterpart, at their own time as far as it is inside the segment."""
    inside = lambda x, c: F.least(F.greatest(x[c], x["lo"]), x["hi"])
    return F.transform(new, lambda x: row(x["w"], F.lit(None).cast("string"), inside(x, "start_us"), F.greatest(inside(x, "start_us"), inside(x, "end_us")), "ins"))


def paired(old: Column, new: Column, op: str) -> Column:
    """As many words on both sides: the spoken text at the timed times, one by one."""
    other = (lambda x: x["s"]["w"]) if op == "eq" else (lambda x: x["t"]["w"])
    return F.transform(F.arrays_zip(old.alias("t"), new.alias("s")), lambda x: row(x["s"]["w"], other(x), x["t"]["start_us"], x["t"]["end_us"], op))


def shared(old: Column, new: Column) -> Column:
    """Spoken words share the time of the timed ones by letters (alike, if there are none)."""
    letters = F.transform(new, lambda x: F.length(x["norm"]).cast("long"))
    letters = F.when(F.exists(letters, lambda n: n > 0), letters).otherwise(F.transform(new, lambda _: F.lit(1).cast("long")))
    sum_ = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    begin, size = F.get(old, F.lit(0))["start_us"], F.size(old).cast("long")
    length, total = F.element_at(old, -1)["end_us"] - begin, sum_(letters)

    def one(x, k):
        before = sum_(F.slice(letters, F.lit(1), k))
        upto = before + F.get(letters, k)
        place = F.least(F.floor(before * size / total), size - 1).cast("int")
        at = lambda n: begin + F.floor(length * n / total)
        return row(x["w"], F.get(old, place)["w"], at(before), at(upto), "rep")

    return F.transform(new, one)


def in_segments(words: DataFrame, segments: DataFrame, whole: bool, bucket: int) -> DataFrame:
    """Words with the segment that holds their start, or (not `whole`) that they overlap."""
    points = words.select("src", "o", "norm", "w", "start_us", "end_us", F.col("start_us").alias("la"), (F.col("start_us") if whole else F.col("end_us")).alias("lb"))
    # a new name for the id: both transcripts meet the same segments, and are grouped by it together
    ends = segments.select("src", F.col("id").alias("id"), F.col("a").alias("ra"), F.col("b").alias("rb"))
    return intervals.range_join(points, ends, "src", bucket, (F.col("la") < F.col("rb")) if whole else (F.col("la") < F.col("rb")) & (F.col("lb") > F.col("ra"))).withColumnsRenamed({"ra": "lo", "rb": "hi"}).drop("la", "lb")


def numbered(words: DataFrame, out: str) -> DataFrame:
    """src, id and the words of each segment in order of time, as an array."""
    fields = [c for c in ("start_us", "end_us", "o", "norm", "w", "lo", "hi") if c in words.columns]
    return words.groupBy("src", "id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def align(timed: DataFrame, spoken: DataFrame, segments: DataFrame, keep: Callable[[Column], Column], bucket: int = 10_000_000) -> DataFrame:
    """src, id, n, w, other, start_us, end_us, op for each segment.

    Words carry src, o, norm, w, start_us, end_us; `keep` says of a norm whether its timed word stays
    without a counterpart. One row is one segment of one recording: only the norms of its words leave
    the JVM, to be compared, and what becomes of each stretch are expressions. A segment without spoken
    words keeps the timed ones (`only`), one without words has no rows.
    """
    one, two = numbered(in_segments(timed, segments, True, bucket), "t"), numbered(in_segments(spoken, segments, False, bucket), "s")
    met = one.join(two, ["src", "id"], "full")
    met = met.withColumns({c: F.coalesce(F.col(c), F.array().cast(met.schema[c].dataType)) for c in ("t", "s")})
    norms = lambda c: F.transform(F.col(c), lambda x: x["norm"])
    met = met.withColumn("ops", F.arrow_udf(stretches, STRETCH)(norms("t"), norms("s")))

    def rows(x):
        old, new = F.slice("t", x["i"] + 1, x["i_end"] - x["i"]), F.slice("s", x["j"] + 1, x["j_end"] - x["j"])
        same_size = F.size(old) == F.size(new)
        return F.when(x["op"] == "delete", dropped(old, keep)).when(x["op"] == "insert", added(new)).when(x["op"] == "equal", paired(old, new, "eq")).when(same_size, paired(old, new, "rep")).otherwise(shared(old, new))

    only = F.transform("t", lambda x: row(x["w"], x["w"], x["start_us"], x["end_us"], "only"))
    made = F.when(F.size("s") == 0, only).otherwise(F.flatten(F.transform("ops", rows)))
    return met.select("src", "id", F.posexplode(made).alias("n", "x")).select("src", "id", F.col("n").cast("long").alias("n"), "x.*")


def primary_if_bad(aligned: DataFrame, bad: Callable[[Column], Column]) -> DataFrame:
    """Where the timed word is bad and the spoken one is not, the text becomes the timed word."""
    return aligned.withColumn("w", F.when(bad(F.col("other")) & ~bad(F.col("w")), F.col("other")).otherwise(F.col("w")))


def proportional_split(words: DataFrame, block: list[str], weight: Column) -> DataFrame:
    """Adds from_us, to_us: the block's time [block_a, block_b) shared by weight (equal shares if all are 0)."""
    all_ = Window.partitionBy(*block)
    so_far = all_.orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.sum(weight).over(all_) > 0, weight).otherwise(1)
    with_own = words.withColumn("_x", own)
    total, upto, length = F.sum("_x").over(all_), F.sum("_x").over(so_far), F.col("block_b") - F.col("block_a")
    at = lambda n: F.col("block_a") + F.floor(length * n / total).cast("long")
    return with_own.withColumns({"from_us": at(upto - F.col("_x")), "to_us": at(upto)}).drop("_x")
