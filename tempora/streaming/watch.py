"""Streams: the stateful watcher of a channel, sessions and loudness in windows of event time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tempora.operators.series import rms_db
from tempora.sources.shared import shared_dir

#: Checks in a row without the channel that end an automatic recording.
LIMIT = 3
STATE = "recording boolean, started_by string, offline long"
IDLE = (False, None, 0)
#: A time that no row of a source that has ended is past.
END = "9999-01-01 00:00:00"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def step(state: tuple, live: bool | None, active: bool, limit: int = LIMIT) -> tuple[tuple, str]:
    """(new state, action) of one check. Unknown (None) leaves the state; manual recordings are never stopped."""
    recording, by, offline = state
    if live is None:
        return state, "unknown"
    if live:
        return ((recording, by, 0), "recording") if active else ((True, "auto", 0), "start")
    if not active:
        return (IDLE, "gone") if recording else ((recording, by, 0), "idle")
    if by != "auto":
        return (recording, by, 0), "manual"
    return (IDLE, "stop") if offline + 1 >= limit else ((recording, by, offline + 1), "wait")


class Watcher(StatefulProcessor):
    """The state machine of one channel; its state is typed and kept in the state store."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("watch", STATE)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        self.state.update((initialState.recording, initialState.started_by, initialState.offline))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = tuple(self.state.get()) if self.state.exists() else IDLE
        for ts, _, live, active in sorted(((r.ts, r.order, r.live, r.active) for r in rows), key=lambda r: r[:2]):
            now, action = step(now, live, bool(active), self.limit)
            yield Row(channel=key[0], ts=ts, action=action, offline=now[2])
        self.state.update(now)

    def close(self) -> None:
        pass


def watch(checks: DataFrame, limit: int = LIMIT, initial: DataFrame | None = None) -> DataFrame:
    """channel, ts, action, offline of every check (channel, ts, order, live, active), in order of time in each micro-batch.

    The state of a channel is kept in the state store and survives restarts by the query's checkpoint;
    `initial` (channel, recording, started_by, offline) is what channels begin with. Checks of an
    earlier micro-batch are done: one that comes late is taken as the newest. A channel's checks of a
    micro-batch are sorted in one task, so the source should limit its files for each trigger.
    """
    spark = checks.sparkSession
    # typed state needs this store; it is set for the queries that are started from now on
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    kind = checks.schema["channel"].dataType.simpleString()
    begun = initial.groupBy("channel") if initial is not None else None
    return checks.groupBy("channel").transformWithState(Watcher(limit), f"channel {kind}, ts timestamp, action string, offline long", "append", "none", begun)


def sessions(events: DataFrame, gap_us: int, late: str = "1 hour") -> DataFrame:
    """src, a, b, n of each run of events (src, ts) of event time in which no pause is longer than `gap_us`.

    A pause of just `gap_us` does not end a run, as session windows that touch are one. A run is given
    once, when the watermark has passed its last event by the gap; events later than `late` are dropped.
    """
    runs = events.withWatermark("ts", late).groupBy("src", F.session_window("ts", f"{gap_us} microseconds").alias("w"))
    found = runs.agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    return found.select("src", "a", "b", "n")


def loudness(samples: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """src, start, raw_db, n of windows of event time (src, ts, x), each given once, when the watermark has passed its
    end; rows later than `late` are dropped."""
    return samples.withWatermark("ts", late).groupBy("src", F.window("ts", size).alias("w")).agg(F.round(rms_db(F.col("x")), 4).alias("raw_db"), F.count("*").alias("n")).select("src", F.col("w.start").alias("start"), "raw_db", "n")


def run_to_end(stream: DataFrame, close: Callable[[], None] | None = None) -> DataFrame:
    """Reads all that the source holds now, and gives the rows that the query appends as a table in the shared folder.

    With `close`, the query then goes on from its checkpoint over what that has put into the source.
    """
    spark: SparkSession = stream.sparkSession
    root = shared_dir(spark)
    out, mark = f"{root}/stream-{uuid.uuid4().hex}", f"{root}/mark-{uuid.uuid4().hex}"
    run = lambda: stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    run()
    if close:
        close()
        run()
    return spark.read.schema(stream.schema).parquet(out)


def whole_loudness(samples: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """`loudness` of a source that has ended: all that it holds now is read, then a closing row far ahead, alone in a
    second source, moves the watermark past the last windows, so those come too. The closing row's own stays open."""
    spark: SparkSession = samples.sparkSession
    end = f"{shared_dir(spark)}/end-{uuid.uuid4().hex}"
    closing = spark.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) if f.name != "ts" else F.lit(END).cast("timestamp").alias("ts") for f in samples.schema))
    closing.limit(0).write.parquet(end)
    both = loudness(samples.unionByName(spark.readStream.schema(closing.schema).parquet(end)), size, late)
    return run_to_end(both, lambda: closing.write.mode("append").parquet(end))
