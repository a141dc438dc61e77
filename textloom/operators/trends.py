"""Snapshots, event logs and trends of long-running jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def rates(df: DataFrame, by: list[str], ts: str, value: str, strictly: bool = False) -> DataFrame:
    """``rate`` per second since the snapshot before; null without one, for no elapsed time, and for a falling value (with
    ``strictly`` also for an equal one)."""
    w = Window.partitionBy(*by).orderBy(ts, *([] if value == ts else [value]))
    dt = seconds(F.col(ts)) - seconds(F.lag(ts).over(w))
    dv = F.col(value) - F.lag(value).over(w)
    rises = dv > 0 if strictly else dv >= 0
    return df.withColumn("rate", F.when((dt > 0) & rises, dv / dt))


def since_change(df: DataFrame, by: list[str], ts: str, value: str, tie: str) -> DataFrame:
    """``stalled``: seconds since the value last differed from the one before (the first row counts as a change)."""
    w = Window.partitionBy(*by).orderBy(ts, tie)
    before = F.lag(value).over(w)
    changed = F.row_number().over(w) == 1
    marks = df.withColumn("_at", F.when(changed | ~F.equal_null(before, F.col(value)), F.col(ts)))
    last = F.last("_at", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marks.withColumn("stalled", seconds(F.col(ts)) - seconds(last)).drop("_at")


def rolling_mean(df: DataFrame, by: list[str], order: list[str], value: str, width: int = 5) -> DataFrame:
    """``rolling``: the mean of the last ``width`` values, without NaN ones."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - width, 0)
    return df.withColumn("rolling", F.avg(F.when(~F.isnan(value), F.col(value))).over(w))


def paired(events: DataFrame, by: list[str], ts: str, kind: str, start: str, done: str, tie: str) -> DataFrame:
    """Each ``done`` event with the latest ``start`` before it that no other end has taken: ``started, ended, elapsed``."""
    w = Window.partitionBy(*by).orderBy(ts, tie)
    e = events.where(F.col(kind).isin(start, done)).withColumn("_before", F.lag(kind).over(w)).withColumn("started", F.lag(ts).over(w))
    # a start is taken by the end right after it; an end right after an end has none
    return e.where((F.col(kind) == done) & (F.col("_before") == start)).select(
        *by, "started", F.col(ts).alias("ended"), (seconds(F.col(ts)) - seconds(F.col("started"))).alias("elapsed")
    )


def throughput(batches: DataFrame, by: list[str], ended: str, items: str, elapsed: str, last: int = 6) -> DataFrame:
    """Items per second over the last ``last`` finished batches."""
    w = Window.partitionBy(*by).orderBy(F.desc(ended))
    recent = batches.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= last)
    return recent.groupBy(*by).agg(F.sum(items).alias("items"), F.sum(elapsed).alias("seconds")).withColumn("per_second", F.when(F.col("seconds") > 0, F.col("items") / F.col("seconds")))


def latest_before(df: DataFrame, by: list[str], ts: str, good: Column, value: str, tie: str) -> DataFrame:
    """``prior``: the value of the latest earlier row that is good (as-of join of a log with itself, as one window)."""
    w = Window.partitionBy(*by).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("prior", F.last(F.when(good, F.col(value)), ignorenulls=True).over(w))


def alerts(status: DataFrame, stall_limit: float) -> DataFrame:
    """``name, alert`` rows of ``name, overlap_inputs, stalled, workers, symlinked``."""
    tests = {
        "duplicate_inputs": F.col("overlap_inputs") > 0,
        "stalled": F.col("stalled") > stall_limit,
        "unmanaged_loops": F.col("workers") > 1,
        "symlinked_manifests": F.col("symlinked") > 0,
    }
    hits = F.filter(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())), lambda x: x.isNotNull())
    return status.select("name", F.explode(hits).alias("alert"))
