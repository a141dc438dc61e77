"""Queries that run as streams over the event table until it is read, and the SQL of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import new_folder, table
from ..streaming import jobs


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark: SparkSession, df: DataFrame, mode: str) -> DataFrame:
    """Run the stream until all input is read; its results as a table (each batch's file replaces the batch's earlier tries)."""
    out, state = new_folder(spark, "stream"), new_folder(spark, "stream-state")
    write: Callable[[DataFrame, int], None] = jobs.write_batch(out)
    df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(df.schema.add("batch", "long")).parquet(out)
    if mode == "complete":  # the last batch holds everything
        got = got.where(F.col("batch") == got.agg(F.max("batch")).first()[0])
    return got.drop("batch")


def stream_hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    return _drained(spark, jobs.windowed_counts(_events(spark, d), "ts", "event_type"), "complete").select("start", "event_type", F.col("count").alias("n"))


def stream_stalls(spark: SparkSession, d: str) -> DataFrame:
    """Silences of users of more than twelve hours, ended ones and those still open at the end."""
    return _drained(spark, jobs.stalls(_events(spark, d), "user_id", "ts", 43_200.0), "append").select("key", "stalled_from", F.round("seconds", 3).alias("seconds"), "open")


SQL = {
    "stream_hourly_counts": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_stalls": """SELECT user_id::VARCHAR AS key, before AS stalled_from, round((epoch_us(ts) - epoch_us(before)) / 1e6, 3) AS seconds, false AS open FROM
(SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events) WHERE epoch_us(ts) - epoch_us(before) > 43200 * 1000000::BIGINT
UNION ALL SELECT user_id::VARCHAR, max(ts), NULL, true FROM events GROUP BY user_id HAVING epoch_us((SELECT max(ts) FROM events)) // 1000 > (epoch_us(max(ts)) + 43200 * 1000000::BIGINT) // 1000 + 1""",
}
QUERIES = {f.__name__: f for f in (stream_hourly_counts, stream_stalls)}
