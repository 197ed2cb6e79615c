"""Reports as lines of text, logs of streams, writing of what has changed, and hooks for models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora.functions import text as T


def peak_line(start: Column, delta_db: Column, seconds: Column) -> Column:
    """A peak's line of the report: clock in brackets, gain and length to a tenth."""
    return F.format_string("%s +%.1f dB (длительность %.1f с)", T.clock(start, brackets=True), delta_db.cast("double"), seconds.cast("double"))


def table_line(*cells: Column) -> Column:
    """A row of a Markdown table; an empty cell is a dash."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *map(T.table_cell, cells)), F.lit(" |"))


def segment_lines(words: DataFrame) -> DataFrame:
    """src, id, head, giga, final: the readable text of each segment of reconciled words.

    words: src, id, a, b (seconds) of the segment, o, giga (first transcript), w (second), op. The head counts the
    operations. A segment's words are collected; its length bounds them.
    """
    counts = words.groupBy("src", "id", "op").agg(F.count("w").alias("n")).filter("n > 0").groupBy("src", "id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "op", F.col("n").cast("string")))), ", ").alias("ops"))
    joined = lambda c: F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("o", c))), lambda x: x[c]))
    lines = words.groupBy("src", "id", "a", "b").agg(joined("giga").alias("giga"), joined("w").alias("final"))
    head = F.format_string("# сегмент %d  [%.3f..%.3f)  %s", F.col("id"), F.col("a").cast("double"), F.col("b").cast("double"), F.coalesce("ops", F.lit("")))
    return lines.join(counts, ["src", "id"], "left").select("src", "id", head.alias("head"), F.concat(F.lit("GIGA: "), "giga").alias("giga"), F.concat(F.lit("ИТОГ: "), "final").alias("final"))


def log_line(at: Column, message: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss+zone message` in the session's time zone; without a message, nothing follows."""
    return F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ssZ"), F.lit(" "), F.coalesce(message, F.lit("")))


def write_lines(df: DataFrame, path: str, order: list[str], line: str = "line") -> None:
    """The lines as text files, in order within and across the files."""
    df.orderBy(*order).select(line).write.mode("overwrite").text(path)


def append_log(stream: DataFrame, path: str, checkpoint: str, seconds: int | None = 60) -> StreamingQuery:
    """Append the stream's `line` column to text files every `seconds`; with none, what there is now and no more."""
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return stream.select("line").writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_changed(df: DataFrame, path: str) -> bool:
    """Write the rows as Parquet unless the folder holds the same columns and rows; tells whether it wrote."""
    try:
        old = df.sparkSession.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        old = None
    if old is not None and old.dtypes == df.dtypes and old.exceptAll(df).isEmpty() and df.exceptAll(old).isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def fresh(files: DataFrame, now: Column, seconds: int = 30, ext: str = ".mp4") -> DataFrame:
    """path, modified of the newest file (path, modified) if it changed less than `seconds` before now; else no row."""
    newest = files.filter(F.endswith("path", F.lit(ext))).agg(F.max(F.struct("modified", "path")).alias("m"))
    return newest.select("m.path", "m.modified").filter(F.col("modified") > now - F.expr(f"interval {seconds} seconds"))


def with_model(windows: DataFrame, x: str, model: Callable[[np.ndarray], np.ndarray], outputs: list[str], batch: int = 64) -> DataFrame:
    """The columns of `windows` and one double for each output of a model.

    The model gets `batch` windows (arrays of one length, without nulls) as a float32 matrix and returns a
    matrix with a column for each output. It is called in the tasks; load weights inside of it.
    """
    names = windows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                flat = part.column(names.index(x)).flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                found = np.asarray(model(flat.reshape(part.num_rows, -1)), np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(found[:, k]) for k in range(len(outputs)))], names=[*names, *outputs])

    schema = ", ".join([*(f"`{c}` {kind}" for c, kind in windows.dtypes), *(f"`{c}` double" for c in outputs)])
    return windows.mapInArrow(run, schema)
