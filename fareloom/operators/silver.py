"""Cleaning rules for conformed trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.dates import event_date, inside_month

SILVER_COLUMNS = [
    "service_type",
    "source_year",
    "source_month",
    "pickup_date",
    "pickup_at",
    "dropoff_at",
    "vendor_id",
    "pickup_zone_id",
    "dropoff_zone_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "payment_type",
]


def reject_rules() -> dict[str, Column]:
    """Named conditions under which a conformed trip is rejected."""
    return {
        "null_pickup_timestamp": F.col("pickup_at").isNull(),
        "null_dropoff_timestamp": F.col("dropoff_at").isNull(),
        "null_pickup_zone": F.col("pickup_zone_id").isNull(),
        "null_dropoff_zone": F.col("dropoff_zone_id").isNull(),
        "negative_distance": F.col("trip_distance") < 0,
        "negative_fare": F.col("fare_amount") < 0,
        "outside_source_month": ~inside_month(F.col("pickup_at"), F.col("source_year"), F.col("source_month")),
    }


def is_valid() -> Column:
    """A missing distance or fare also fails: the comparison is then unknown, not true."""
    return (
        F.col("pickup_at").isNotNull()
        & F.col("dropoff_at").isNotNull()
        & F.col("pickup_zone_id").isNotNull()
        & F.col("dropoff_zone_id").isNotNull()
        & (F.col("trip_distance") >= 0)
        & (F.col("fare_amount") >= 0)
        & inside_month(F.col("pickup_at"), F.col("source_year"), F.col("source_month"))
    )


def silver_trips(unified: DataFrame) -> DataFrame:
    return unified.where(is_valid()).withColumn("pickup_date", event_date(F.col("pickup_at"))).select(*SILVER_COLUMNS)


def reject_diagnostics(unified: DataFrame) -> DataFrame:
    """One pass over the rows: how many fail each rule (rules may overlap), and how many pass."""
    passed = F.coalesce(is_valid(), F.lit(False))
    counts = [F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"), F.count("*").alias("raw_rows")]
    counts += [F.count_if(rule).alias(name) for name, rule in reject_rules().items()]
    wide = unified.agg(*counts)
    return wide.unpivot([], wide.columns, "check_name", "row_count")


def silver_anomaly() -> dict[str, Column]:
    """Conditions that are warned about while the row stays."""
    return {
        "dropoff_before_pickup": F.col("dropoff_at") < F.col("pickup_at"),
        "distance_over_200": F.col("trip_distance") > 200,
        "negative_total": F.col("total_amount") < 0,
    }


def any_of(rules: dict[str, Column]) -> Column:
    combined = None
    for rule in rules.values():
        combined = rule if combined is None else combined | rule
    return combined


def silver_anomaly_rows(silver: DataFrame) -> DataFrame:
    return silver.where(any_of(silver_anomaly())).select(
        "service_type",
        "pickup_at",
        "dropoff_at",
        "pickup_zone_id",
        "dropoff_zone_id",
        "trip_distance",
        "fare_amount",
        "total_amount",
    )


def anomaly_counts(silver: DataFrame, window_days: Column) -> DataFrame:
    """Anomaly counts over everything and over one window, in a single pass."""
    parts = []
    for name, rule in silver_anomaly().items():
        parts.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.count_if(rule).alias("all_rows"),
                F.count_if(rule & window_days).alias("window_rows"),
            )
        )
    return silver.agg(F.array(*parts).alias("checks")).select(F.inline("checks"))
