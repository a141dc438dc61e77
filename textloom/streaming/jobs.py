"""Incremental forms: file batches, exactly-once registries, event-time counts and a stall detector."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def file_batches(
    spark: SparkSession, folder: str, schema: Any, checkpoint: str, handle: Callable[[DataFrame, int], None], per_batch: int = 16, min_age: str | None = None
) -> None:
    """Hand all new Parquet files to ``handle`` in bounded batches and stop; processed files are remembered by the checkpoint,
    and only after ``handle`` has returned. A batch that is repeated comes with the same number, so ``handle`` can overwrite."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
    if min_age:
        reader = reader.option("modifiedBefore", min_age)
    query = reader.parquet(folder).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def write_batch(folder: str) -> Callable[[DataFrame, int], None]:
    """A sink of one folder per batch number, overwritten if the batch is repeated."""

    def write(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def windowed_counts(events: DataFrame, ts: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per tumbling window and kind; later events than ``late`` are dropped."""
    counted = events.withWatermark(ts, late).groupBy(F.window(ts, width), kind).count()
    return counted.select(F.col("window.start").alias("start"), kind, "count")


STALL_SCHEMA = "key string, stalled_from timestamp, seconds double, open boolean"


def stalls(events: DataFrame, key: str, ts: str, limit_seconds: float, late: str = "0 seconds") -> DataFrame:
    """A row for each silence of more than ``limit_seconds`` of a key: with its length once the key's next event ends it, and before that, without
    a length and ``open``, as soon as the watermark (``late`` behind the newest event of all keys) has passed the limit. One timestamp per
    key is kept as state, in event time."""
    limit = int(limit_seconds * 1e6)

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = []
        if state.hasTimedOut:
            rows.append((k[0], pd.Timestamp(last * 1000), None, True))
            state.update((last,))
        else:
            for t in pd.concat([p[["ts"]] for p in pdfs])["ts"].dropna().sort_values():
                micros = int(t.value // 1000)
                if last is not None and micros - last > limit:
                    rows.append((k[0], pd.Timestamp(last * 1000), (micros - last) / 1e6, False))
                last = micros if last is None else max(last, micros)
            if last is not None:
                state.update((last,))
                state.setTimeoutTimestamp(max((last + limit) // 1000, state.getCurrentWatermarkMs()) + 1)
        out = pd.DataFrame(rows, columns=["key", "stalled_from", "seconds", "open"])
        yield out.astype({"seconds": float, "open": bool})

    picked = events.withWatermark(ts, late).select(F.col(key).cast("string").alias("key"), F.col(ts).alias("ts"))
    return picked.groupBy("key").applyInPandasWithState(step, STALL_SCHEMA, "last long", "append", GroupStateTimeout.EventTimeTimeout)
