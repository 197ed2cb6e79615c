"""Small helpers shared by the operators: batches of rows, shared storage, word regexes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch: bounds what a task holds as Python objects at once.
BATCH_ROWS = 500
#: Bytes of text that one vectorised step inside a task handles; a longer text is a step of its own.
SLICE_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tempora-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Cut lineage: write a table into the shared folder, with `options` of the writer, and read it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(texts: Iterable[str], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a run of texts into (first, end) ranges of at most about `limit` characters, one text at least."""
    first, size, end = 0, 0, 0
    for end, text in enumerate(texts):  # noqa: B007
        size += len(text) + 1
        if size >= limit:
            yield first, end + 1
            first, size = end + 1, 0
    if size and first <= end:
        yield first, end + 1


def release() -> None:
    """Give freed memory back to the system: a Python worker outlives its task and would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def with_batches_of(spark: SparkSession, rows: int) -> None:
    """Rows of the Arrow batches of the plans made next."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def map_batches(df: DataFrame, columns: list[str], fn: Callable[[list[list]], Iterable[list[list]]], schema: str) -> DataFrame:
    """Run `fn` on each Arrow batch of `columns` (as Python lists) inside the tasks; no shuffle.

    `fn` yields columns as lists, in the order of `schema`. Columns that are not named are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    # the Arrow types come from the same DDL that Spark gets
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in fn([batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(out, arrow, strict=True)], schema=arrow)
        batch = out = None  # nothing of the last batch is held while memory is given back
        release()

    with_batches_of(df.sparkSession, BATCH_ROWS)
    return df.select(*columns).mapInArrow(run, schema)
