"""Files of the engine: stem dictionaries, edit lists, feature and packet tables, and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators import mutes

SEGMENT = "struct<a:double,b:double,speed:double>"
#: An edit list of a clip, and one of a long video.
CLIP = f"name string, src string, title string, layout string, segments array<{SEGMENT}>, punch array<struct<t:double,dur:double,scale:double,focus:string,boom:boolean>>, cam_alt boolean, caption_y int, caption_off array<array<double>>, extra_mute array<array<double>>"
LONG = "name string, source string, source_duration double, intro string, output string, mutes_source_time array<struct<a:double,b:double,word:string,kind:string>>, keep_segments_source_time array<array<double>>"


def edit_lists(spark: SparkSession, path: str, schema: str = CLIP) -> DataFrame:
    """One row for each JSON document, with the file that it came from."""
    return spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_path"))


def stems(spark: SparkSession, path: str, section: str | None = None) -> DataFrame:
    """ord, stem: lines after the last one that begins with `section` (all, if none does), without `#` comments."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("ord", "line"))
    if section is not None:
        start = lines.agg(F.coalesce(F.max(F.when(F.startswith(F.trim("line"), F.lit(section)), F.col("ord"))), F.lit(-1)).alias("_at"))
        lines = lines.join(F.broadcast(start)).filter(F.col("ord") > F.col("_at")).drop("_at")  # one row
    stem = F.replace(F.lower(F.trim(F.split_part("line", F.lit("#"), F.lit(1)))), F.lit("ё"), F.lit("е"))
    return lines.select("ord", stem.alias("stem")).filter("stem <> ''")


def numbers(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of CSV files with a header, as numbers; a row in which one of them is none is dropped."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(*(F.expr(f"try_cast(`{c}` as double)").alias(c) for c in columns)).dropna()


def packets(spark: SparkSession, path: str) -> DataFrame:
    """stream, pts, dur, ord: lines `stream,pts,dur`; without a time a line is dropped, without a duration it is 0.
    `ord` puts them in the order of files, places in the file, and lines."""
    rows = spark.read.schema("stream string, pts string, dur string").csv(path)
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line"))
    return rows.select("stream", F.expr("try_cast(pts as double)").alias("pts"), F.coalesce(F.expr("try_cast(dur as double)"), F.lit(0.0)).alias("dur"), order.alias("ord")).filter("pts is not null")


def stream_spans(packets: DataFrame) -> DataFrame:
    """stream, first, least, last: the time of the first packet in order, the smallest time, and the greatest end."""
    return packets.groupBy("stream").agg(F.min_by("pts", "ord").alias("first"), F.min("pts").alias("least"), F.max(F.col("pts") + F.col("dur")).alias("last"))


def with_mutes(edits: DataFrame, windows: DataFrame) -> DataFrame:
    """Edit lists with `mutes_source_time` set from windows (name, a, b, word, kind), all else as it was.

    Windows that start at or past the source's end go, others end there at the latest; windows that
    touch become one, with their words in order and kind `word` if one of them has it.
    """
    ends = edits.select("name", F.col("source_duration").alias("_end"))
    cut = windows.join(ends, "name").filter(F.col("_end").isNull() | (F.col("a") < F.col("_end"))).withColumn("b", F.coalesce(F.least("b", "_end"), F.col("b"))).drop("_end")
    joined = mutes.merged(cut, by="name")
    lists = joined.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("a", "b", "word", "kind"))).alias("_m"))
    empty = F.expr("cast(array() as array<struct<a:double,b:double,word:string,kind:string>>)")
    return edits.join(lists, "name", "left").withColumn("mutes_source_time", F.coalesce("_m", empty)).drop("_m")


def write_features(df: DataFrame, path: str) -> None:
    """CSV with a header; numbers with a fraction at six places."""
    cols = [F.round(c, 6).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes]
    df.select(*cols).write.option("header", True).mode("overwrite").csv(path)


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON document a line, in UTF-8, with nulls left out."""
    df.write.mode("overwrite").json(path)
