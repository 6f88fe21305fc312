"""Top-n, bounded results and reports read off a ranked result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.numbers import exact_sum, safe_divide

# Bounds of a served result, and the words that mark a metric column.
MAX_ROWS_DEFAULT = 100
MAX_ROWS_LIMIT = 1000
METRIC_WORDS = ("count", "amount", "fare", "distance", "avg", "total")


def rank_metric(metric: str, available: set[str]) -> str:
    """The asked metric if the result has it, else the trip count."""
    return metric if metric in available else "trip_count"


def top_n(df: DataFrame, metric: str, ties: list[str], n: int | None = None) -> DataFrame:
    """Rows ranked by a metric, largest first. ``ties`` makes the order of equal rows definite."""
    ranked = df.orderBy(F.desc(metric), *ties)
    return ranked if n is None else ranked.limit(n)


def bounded(df: DataFrame, max_rows: int, asked: int | None = None, scalar: bool = False) -> DataFrame:
    """At most ``max_rows`` rows; a smaller asked limit stays, a single-row aggregate needs none."""
    if not 1 <= max_rows <= MAX_ROWS_LIMIT:
        raise ValueError(f"max_rows must be between 1 and {MAX_ROWS_LIMIT}")
    if scalar:
        return df
    return df.limit(max_rows if asked is None else min(asked, max_rows))


def metric_columns(names: list[str]) -> list[str]:
    return [n for n in names if any(word in n.lower() for word in METRIC_WORDS)]


def key_finding(result: DataFrame, context: int = 3) -> DataFrame:
    """The row with the highest first metric, with up to three other columns beside it.

    Ties go to the smallest context values, so the answer does not depend on row order.
    """
    types = dict(result.dtypes)
    candidates = metric_columns(result.columns)
    if not candidates or types[candidates[0]] == "string":
        return result.limit(0).select(
            F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("highest")
        )
    metric = candidates[0]
    others = [c for c in result.columns if c != metric][:context]
    best = result.where(F.col(metric).isNotNull()).agg(
        F.min(F.struct((-F.col(metric)).alias("neg"), *others)).alias("best")
    )
    return best.where(F.col("best").isNotNull()).select(
        F.lit(metric).alias("metric"),
        (-F.col("best.neg")).cast("double").alias("highest"),
        *[F.col(f"best.{c}").cast("string").alias(c) for c in others],
    )


def share_of_total(grouped: DataFrame, value: str, name: str = "share_pct", digits: int = 2) -> DataFrame:
    """Percentage of the grand total. ``grouped`` holds one row per label, so the total is cheap."""
    grand_total = grouped.agg(F.sum(value)).scalar()
    share = F.try_divide(F.col(value) * F.lit(100.0), grand_total)
    return grouped.select("*", F.round(share, digits).alias(name))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value x weight over the sum of weights, NULL when the weights sum to zero."""
    return safe_divide(exact_sum(value * weight), F.sum(weight))


def pivot_sum(df: DataFrame, index: str, series: str, value: str, names: list) -> DataFrame:
    """Index by series matrix of sums, sorted by index. Naming the series saves a pass over the data."""
    return df.where(F.col(index).isNotNull()).groupBy(index).pivot(series, names).agg(F.sum(value)).orderBy(index)


def group_sum(df: DataFrame, index: str, value: Column, name: str) -> DataFrame:
    """Sum per index value; the NULL group is kept."""
    return df.groupBy(index).agg(F.sum(value).alias(name)).orderBy(index)
