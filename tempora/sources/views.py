"""The engine's inputs, derived from the star-schema tables: series, words, segments, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, us, t (hour), x, user_id, marker key of each event."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("src"), us.alias("us"), F.floor(us / HOUR_US).cast("long").alias("t"), F.col("value").alias("x"), "user_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, o, w, start_us, end_us: whitespace tokens of conversations, numbered within the conversation."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("src"), "turn", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("ws"))
    # running totals over turns number the tokens without a window over all tokens
    before = F.sum(F.size("ws")).over(Window.partitionBy("src").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.withColumn("before", F.coalesce(before, F.lit(0)))
    token = turns.select("src", "turn", "before", F.posexplode("ws").alias("pos", "w"))
    o = F.col("before") + F.col("pos")
    start = o * 350_000 + F.col("turn") * 1_500_000
    return token.select("src", o.alias("o"), "w", start.alias("start_us"), (start + F.least(F.length("w"), F.lit(8)) * 40_000).alias("end_us"))
