"""Evaluation of completions: case checks, summaries, promotion and regression rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

METRICS = ("pass_rate", "check_pass_rate", "avg_case_score")
#: Limits of the two promotion rules.
POLICIES = {
    "v1": {"min_pass_rate": 0.45, "min_check_pass_rate": 0.75, "min_avg_case_score": 0.70},
    "talk_v1": {"min_pass_rate": 0.50, "min_check_pass_rate": 0.80, "min_avg_case_score": 0.74},
}
DROP, GAIN = 0.01, 0.0


def scored(
    cases: DataFrame,
    completion: str = "completion",
    min_chars: int = 1,
    expect: Column | None = None,
    reject: Column | None = None,
    max_urls: int | None = None,
    max_run: int | None = None,
    max_non_ascii: float | None = None,
) -> DataFrame:
    """The cases with ``checks_total, checks_passed, case_score, passed``. ``expect`` and ``reject`` are arrays of strings; an
    empty or null array is no check."""
    c = F.coalesce(F.col(completion), F.lit(""))
    low = F.lower(c)
    # (whether it applies, whether it passes)
    checks: list[tuple[Column, Column]] = [(F.lit(True), F.length(c) >= min_chars)]
    if expect is not None:
        checks.append((F.coalesce(F.size(expect), F.lit(0)) > 0, F.exists(expect, lambda x: low.contains(F.lower(x)))))
    if reject is not None:
        checks.append((F.coalesce(F.size(reject), F.lit(0)) > 0, ~F.exists(reject, lambda x: low.contains(F.lower(x)))))
    if max_urls is not None:
        checks.append((F.lit(True), T.url_count(c) <= max_urls))
    if max_run is not None:
        checks.append((F.lit(True), T.longest_char_run(c) <= max_run))
    if max_non_ascii is not None:
        checks.append((F.lit(True), T.non_ascii_ratio(c) <= max_non_ascii))
    total = sum((a.cast("int") for a, _ in checks), F.lit(0))
    good = sum(((a & F.coalesce(p, F.lit(False))).cast("int") for a, p in checks), F.lit(0))
    out = cases.withColumn("checks_total", total).withColumn("checks_passed", good)
    return out.withColumn("case_score", F.col("checks_passed") / F.col("checks_total")).withColumn("passed", F.col("checks_passed") == F.col("checks_total"))


def summary(cases: DataFrame, by: list[str]) -> DataFrame:
    """Pass rates of scored cases; the average case score is the mean of the cases' own shares."""
    n = F.count(F.lit(1))
    return cases.groupBy(*by).agg(
        n.alias("cases_total"),
        F.count(F.when(F.col("passed"), 1)).alias("cases_passed"),
        F.sum("checks_total").alias("checks_total"),
        F.sum("checks_passed").alias("checks_passed"),
        F.round(F.count(F.when(F.col("passed"), 1)) / n, 6).alias("pass_rate"),
        F.round(F.sum("checks_passed") / F.sum("checks_total"), 6).alias("check_pass_rate"),
        F.round(F.avg("case_score"), 6).alias("avg_case_score"),
    )


def promotion(current: DataFrame, minimum: dict[str, float], drop: float | None = DROP, gain: float | None = GAIN) -> DataFrame:
    """``promoted, failed`` for rows of current metrics and baseline metrics (``base_`` columns, null without a baseline: then
    every rule that needs one fails)."""
    rules: list[tuple[str, Column]] = [(k, F.col(k.removeprefix("min_")) >= v) for k, v in minimum.items()]
    for m in METRICS:
        delta = F.round(F.col(m) - F.col(f"base_{m}"), 9)
        if drop is not None:
            rules.append((f"max_{m}_drop", delta >= -drop))
        if gain is not None:
            rules.append((f"min_{m}_gain", delta >= gain))
    failed = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules)), lambda x: x.isNotNull())
    return current.withColumn("failed", failed).withColumn("promoted", (F.size("failed") == 0) & F.lit(bool(rules)))


def running_best(df: DataFrame, metric: str, order: str, by: list[str], higher: bool = True, tolerance: float = 0.0) -> DataFrame:
    """``best_before`` and ``ok``: whether a row is at least as good as the best before it, within a relative tolerance."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    best = (F.max if higher else F.min)(metric).over(w)
    good = F.col(metric) >= F.col("best_before") if higher else F.col(metric) <= F.col("best_before") * (1 + tolerance)
    return df.withColumn("best_before", best).withColumn("ok", F.coalesce(good, F.lit(True)))


def best_checkpoints(df: DataFrame, metric: str, order: str, by: list[str], policy: Column | None = None) -> DataFrame:
    """``best_before`` and ``promoted``: what the policy says, or, where it says nothing, whether the metric is at least the best before."""
    out = running_best(df, metric, order, by)
    return out.withColumn("promoted", F.col("ok") if policy is None else F.coalesce(policy, F.col("ok"))).drop("ok")


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(20.0)))
