"""Incremental ingest of quote files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from tidewell.functions.scalars import calendar_columns
from tidewell.operators import clean
from tidewell.sources.published import PublishedTable


def quote_stream(spark: SparkSession, root: str, schema: StructType, bytes_per_batch: int | None = None) -> DataFrame:
    """New CSV files below ``root`` as a stream, in micro-batches of about ``bytes_per_batch``."""
    reader = spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.csv(root)


#: State of running queries in RocksDB, of which an executor holds only a cache; checkpoints get the changes.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what starts inside; a streaming query keeps those it started with."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def append_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet folder, exactly once, and stop."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with _settings(stream.sparkSession, DISK_STATE):
        return writer.start()


def first_of_each(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whatever the order of arrival and the size of the micro-batches; null keys are keys too.

    No row counts as late, so the keys seen so far are kept as state, dealt out by key: a micro-batch costs its own rows,
    and the state is as large as the keys of the result. It fits a backlog, whose files are in no order of time.
    """
    return stream.dropDuplicates(list(keys))


def first_within(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str) -> DataFrame:
    """One row per key as long as repeats arrive within ``lateness`` of event time; older state is dropped.

    For a live feed in order of time only: rows that arrive later than that are discarded; ``first_or_late`` hands them on. A backlog
    needs ``first_of_each``.
    """
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))


class _FirstOrLate(StatefulProcessor):
    """Keeps, per key, until when repeats are known; a timer drops the key once the watermark has passed that."""

    def __init__(self, lateness_ms: int, names: Sequence[str]):
        self.lateness, self.names = lateness_ms, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        known = self.seen.exists()
        until = self.seen.get()[0] if known else None
        before = until
        for frame in rows:
            frame = frame.set_axis([*self.names, None], axis=1)  # names with an underscore in front do not arrive as they are
            place = frame.iloc[:, -1].astype("float64")
            late = (place < watermark).to_numpy()
            verdict = np.where(late, "late", "repeat").astype(object)
            timely = np.flatnonzero(~late)
            if len(timely):
                if not known:
                    verdict[timely[np.argmin(place.fillna(np.inf).to_numpy()[timely])]] = "first"
                    known = True
                ends = place.iloc[timely].max()
                end = int(ends) + self.lateness if ends == ends else watermark + self.lateness
                until = end if until is None else max(until, end)
            yield frame[self.names].assign(verdict=verdict)
        if until != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.seen.update((until,))
            self.handle.registerTimer(until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_or_late(stream: DataFrame, keys: Sequence[str], event_time: str, lateness: str) -> DataFrame:
    """Every row of the stream with a ``verdict``: "first" of its key, "repeat" of a known key, or "late".

    A row is late if its event time lies before the watermark, which is ``lateness`` behind the greatest event time of the micro-batches
    before; it is handed on, not dropped, so what a job keeps and what it sets aside add up to what arrived. A key is known until the
    watermark has passed its last row by ``lateness``; then a timer drops its state, so state is as large as that span of the stream. Rows
    without event time are never late. Keys may be null. Of rows of a key in one micro-batch, the earliest is the first one.
    """
    kinds = dict(stream.dtypes)
    if "verdict" in kinds:
        raise ValueError("the stream has a column named verdict")
    marked = stream.withColumn("_at", F.col(event_time).cast("timestamp")).withWatermark("_at", lateness)
    # The copy of the event time carries no watermark, so late rows reach the processor.
    rows = marked.select(*stream.columns, F.unix_millis("_at").alias("_ms"))
    schema = ", ".join(f"`{n}` {kind}" for n, kind in kinds.items()) + ", verdict string"
    span = stream.sparkSession.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {lateness})").first()[0]
    processor = _FirstOrLate(span, stream.columns)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")


def for_each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: After more added batches than this the next run starts with rewriting the months they touch.
COMPACT_AFTER = 8


def upsert_available(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: str, day: str = "date"
) -> StreamingQuery:
    """Upsert everything that has arrived into a published table by year and month; read it by ``upsert.read``.

    Each micro-batch is written once, reduced to the row with the greatest ``order`` per key, as a further folder, so it costs its own rows
    and not those stored. The same rule decides between folders on reading, so a micro-batch that is repeated after a failure, or
    arrives late, changes nothing it should not. A run starts with one compaction if there are more than COMPACT_AFTER such folders.
    """
    table = PublishedTable(stream.sparkSession, target)
    table.compact(keys, order, COMPACT_AFTER)

    def apply(batch: DataFrame, batch_id: int) -> None:
        PublishedTable(batch.sparkSession, target).append(calendar_columns(clean.latest_per_key(batch, keys, order), day))

    return for_each_batch(stream, apply, checkpoint)
