"""Streams of samples: new files in, done ids out, idempotent upserts, events once, backoff by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from weft.sources.io import DoneSet


def sample_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """New JSON files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def ingest(stream: DataFrame, done: DoneSet, sink: Callable[[DataFrame, int], None], key: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch: rows whose key isn't done, one a key, into ``sink``, then marked done.

    A batch that runs again after a loss finds its keys done or writes them again by key."""

    def one(batch: DataFrame, number: int) -> None:
        fresh = done.pending(batch.dropDuplicates([key]), key).persist()
        try:
            sink(fresh, number)
            done.add(fresh.select(key))
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """What was pushed since the last run, buffered by the source, into a folder; each row once, however often a batch runs."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)


def once(events: DataFrame, key: str, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """First event of each key within the watermark."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def recent_counts(events: DataFrame, key: str, ts: str = "ts", delay: str = "1 minute") -> DataFrame:
    """Sliding count of the last 60 seconds."""
    windowed = events.withWatermark(ts, delay).groupBy(F.window(ts, "60 seconds", "10 seconds").alias("w"), key)
    return windowed.agg(F.count("*").alias("n")).select(F.col("w.end").alias("at"), key, "n")


def backoff_levels(events: DataFrame, max_delay: float = 4.0, factor: float = 2.0, most: float = 300.0) -> DataFrame:
    """From key, event (success, throttle, ban): level and delay of each key after each micro-batch."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level = state.get[0] if state.exists else 0
        for frame in frames:
            for event in frame["event"]:
                level = max(0, level + {"success": -1, "throttle": 1, "ban": 3}.get(event, 0))
        state.update((level,))
        yield pd.DataFrame({"key": [key[0]], "level": [level], "delay": [min(max_delay * factor**level, most) if level else 0.0]})

    return events.groupBy("key").applyInPandasWithState(step, "key string, level long, delay double", "level long", "update", GroupStateTimeout.NoTimeout)
