"""Sharding by extendible hashing, with DataFrame operations only.

A row's hash is the first 60 bits of md5 of its id. The directory is indexed by hash-prefix bits.
It starts as one bucket; only buckets over the byte limit split on one more bit, until each fits.
Rows are first summed into cells of a fixed number of bits (map-side sums, so a hot id or source
costs nothing); the splitting then runs on the cells: a cell's bucket is its shortest prefix whose
bytes fit. Where a whole cell is too large, its rows alone go on with more bits. Rows of one hash
(the same id again and again) cannot part by hash; those over the limit are dealt by the hash of
the text, and equal texts by running number, so each shard still fits.

Defined results: a null id hashes as the empty string; null texts have 0 bytes; a row larger than
the limit is a shard of its own; repeated rows each give a row; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tempora.llm.common import stored

HASH_BITS = 60
#: Bits that one pass over the rows adds to the directory.
CELL_BITS = 20
LIMIT_BYTES = 1 << 20


def hash60(col: Column) -> Column:
    """The first 60 bits of md5 of a value as text."""
    return F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def prefix(hash_col: Column, bits: int | Column) -> Column:
    """The first bits of a 60-bit hash, as a string of 0 and 1."""
    return F.substring(F.lpad(F.conv(hash_col.cast("string"), 10, 2), HASH_BITS, "0"), F.lit(1), F.lit(bits) if isinstance(bits, int) else bits)


def directory(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """cell, shard, depth, shard_bytes for rows (h, n_bytes): the splitting from `low` to `high` bits."""
    cells = rows.groupBy(prefix(F.col("h"), high).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"))
    cells = stored(cells, "cells")
    levels = cells.select("cell", "n_bytes", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    levels = levels.withColumn("shard", F.substring("cell", F.lit(1), F.col("depth")))
    fits = levels.groupBy("depth", "shard").agg(F.sum("n_bytes").alias("shard_bytes")).filter(F.col("shard_bytes") <= limit)
    # of a cell's prefixes that fit, the shortest is its bucket: its parent was split as too large
    found = levels.join(fits, ["depth", "shard"]).groupBy("cell").agg(F.min(F.struct("depth", "shard", "shard_bytes")).alias("m")).select("cell", "m.*")
    return cells.select("cell").join(found, "cell", "left")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """id, n_bytes, shard (hash prefix, and a running number after `-` where one hash overflows), depth, shard_bytes."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), hash60(F.col(id_col)).alias("h"), F.xxhash64(text_col).alias("t"))
    rows = stored(rows, "rows")
    done, low = None, 0
    while True:
        high = min(HASH_BITS, low + CELL_BITS)
        book = stored(directory(rows, limit, low, high), "directory")
        placed = rows.withColumn("cell", prefix(F.col("h"), high)).join(book, "cell")
        good = placed.filter("shard is not null").select("id", "n_bytes", "shard", "depth", "shard_bytes")
        done = good if done is None else done.unionByName(good)
        if book.filter("shard is null").limit(1).count() == 0:
            break
        rows = stored(placed.filter("shard is null").select("id", "n_bytes", "h", "t"), "rows")
        low = high + 1
        if high == HASH_BITS:
            done = done.unionByName(_one_hash(rows, limit))
            break
    return done.select(F.col("id").alias(id_col), "n_bytes", "shard", F.col("depth").cast("long").alias("depth"), "shard_bytes")


def _one_hash(rows: DataFrame, limit: int) -> DataFrame:
    """Rows whose hash alone is over the limit, dealt in runs of at most the limit.

    Rows of a hash are numbered inside parts that a range exchange makes even, however many share
    the hash; equal rows may fall into any part, which changes no shard's size.
    """
    parted = rows.repartitionByRange("h", "t", F.rand(7)).withColumn("part", F.spark_partition_id())
    parted = stored(parted, "parted")
    run = Window.partitionBy("part", "h").orderBy("t", "n_bytes").rowsBetween(Window.unboundedPreceding, 0)
    # a part's bins hold rows of at most half the limit together, larger rows stand alone
    big = F.col("n_bytes") * 2 > limit
    light = F.sum(F.when(big, 0).otherwise(F.col("n_bytes"))).over(run)
    bin_ = F.when(big, F.concat(F.lit("b"), F.row_number().over(run).cast("string"))).otherwise(F.concat(F.lit("s"), F.floor((light - F.col("n_bytes")) * 2 / limit).cast("string")))
    named = parted.withColumn("bin", F.concat_ws("-", prefix(F.col("h"), HASH_BITS), F.col("part").cast("string"), bin_))
    size = named.groupBy("bin").agg(F.sum("n_bytes").alias("shard_bytes"))
    return named.join(size, "bin").select("id", "n_bytes", F.col("bin").alias("shard"), F.lit(HASH_BITS).alias("depth"), "shard_bytes")
