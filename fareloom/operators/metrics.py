"""Rates, latency and throughput figures over result and request logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.dates import epoch_micros
from fareloom.functions.numbers import exact_mean, safe_divide
from fareloom.operators.ranking import top_n
from fareloom.operators.selection import MEDIAN_HIGH, MEDIAN_LOW, exact_percentiles, nearest_rank, rounded_rank


def rate(hits: Column, total: Column, digits: int = 4) -> Column:
    """A share rounded half to even, 0.0 when there is nothing to divide by."""
    return F.coalesce(F.bround(safe_divide(hits, total), digits), F.lit(0.0))


def pass_rates(results: DataFrame, category: str, passed: Column) -> DataFrame:
    return results.groupBy(category).agg(
        F.count("*").alias("total"),
        F.count_if(passed).alias("passed"),
        rate(F.count_if(passed), F.count("*")).alias("pass_rate"),
    )


def block_rates(scanned: DataFrame) -> DataFrame:
    """Blocked and total texts per category and label; a blocked safe text is a false positive."""
    return scanned.groupBy("category", "should_block").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("blocked")).alias("blocked"),
        rate(F.count_if(F.col("blocked")), F.count("*")).alias("block_rate"),
        F.count_if(F.col("blocked") & ~F.col("should_block")).alias("false_positives"),
    )


def accuracy_by(results: DataFrame, group: str, matched: Column) -> DataFrame:
    """Match rate per group, with a row for all of them (group NULL).

    The overall row is summed from the groups, so the results are read once.
    """
    grouped = results.groupBy(group).agg(F.count("*").alias("total"), F.count_if(matched).alias("matched"))
    overall = grouped.agg(F.sum("total").alias("total"), F.sum("matched").alias("matched"))
    both = grouped.withColumn("scope", F.lit("group")).unionByName(
        overall.select(F.lit(None).cast("string").alias(group), "total", "matched", F.lit("overall").alias("scope"))
    )
    return both.withColumn("accuracy", rate(F.col("matched"), F.col("total")))


def latency_percentiles(log: DataFrame, elapsed: str, group_by: list[str] | None = None) -> DataFrame:
    """p50 as the truncated median and p95 by nearest rank, per group."""
    wanted = {"_low": MEDIAN_LOW, "_high": MEDIAN_HIGH, "p95": nearest_rank(95), "_last": "n"}
    found = exact_percentiles(log, elapsed, wanted, group_by)
    return found.select(
        *(group_by or []),
        F.floor((F.col("_low") + F.col("_high")) / 2).cast("long").alias("p50"),
        F.col("p95").cast("long").alias("p95"),
    )


def latency_summary(log: DataFrame, elapsed: str, group_by: list[str]) -> DataFrame:
    """Runs, minimum, median and maximum per case."""
    wanted = {"min_ms": "1", "_low": MEDIAN_LOW, "_high": MEDIAN_HIGH, "max_ms": "n"}
    found = exact_percentiles(log, elapsed, wanted, group_by)
    return found.select(*group_by, "min_ms", ((F.col("_low") + F.col("_high")) / 2).alias("median_ms"), "max_ms")


def throughput(log: DataFrame, level: str, started: str, elapsed: str) -> DataFrame:
    """Queries, wall-clock seconds, queries per second and latency percentiles per load level.

    ``started`` is a zoneless timestamp and ``elapsed`` is in milliseconds.
    """
    start_us = epoch_micros(F.col(started))
    end_us = start_us + F.rint(F.col(elapsed) * 1000).cast("long")
    seconds = (F.max(end_us) - F.min(start_us)) / F.lit(1e6)
    totals = log.groupBy(level).agg(
        F.count("*").alias("queries"),
        F.bround(seconds, 2).alias("elapsed_s"),
        F.coalesce(F.bround(safe_divide(F.count("*"), seconds), 1), F.lit(0.0)).alias("throughput_qps"),
        F.bround(exact_mean(F.col(elapsed)), 1).alias("mean_ms"),
    )
    ranks = {f"p{p}_ms": rounded_rank(p) for p in (50, 95, 99)}
    points = exact_percentiles(log, elapsed, ranks, [level])
    points = points.select(level, *[F.bround(F.col(c), 1).alias(c) for c in ranks])
    return totals.join(points, level)


def reason_histogram(blocked: DataFrame, reason: str, example: str, n: int = 10) -> DataFrame:
    """The most frequent reasons with one example each."""
    counted = blocked.groupBy(reason).agg(F.count("*").alias("occurrences"), F.min(example).alias("example"))
    return top_n(counted, "occurrences", [reason], n)


def source_mix(results: DataFrame, source: str) -> DataFrame:
    """How often each way of answering was used; a missing source counts as an error."""
    return results.groupBy(F.coalesce(F.col(source), F.lit("error")).alias(source)).agg(F.count("*").alias("results"))
