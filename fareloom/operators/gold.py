"""Gold star schema and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.dates import day_name, day_of_week, year_month
from fareloom.functions.numbers import exact_mean, exact_sum
from fareloom.operators.silver import SILVER_COLUMNS, any_of
from fareloom.operators.star import Lookup, count, star_rollup, total

# Labels of vendor and payment codes.
VENDOR_NAMES = {"1": "Creative Mobile Technologies, LLC", "2": "VeriFone Inc."}
OTHER_VENDOR = "Unknown vendor"
PAYMENT_NAMES = {
    "1": "Credit card",
    "2": "Cash",
    "3": "No charge",
    "4": "Dispute",
    "5": "Unknown",
    "6": "Voided trip",
}
OTHER_PAYMENT = "Other"


def code_label(col: Column, names: dict[str, str], other: str) -> Column:
    label = None
    for code, name in names.items():
        label = F.when(col == code, name) if label is None else label.when(col == code, name)
    return label.otherwise(other)


def fact_trips(silver: DataFrame) -> DataFrame:
    return silver.select(*SILVER_COLUMNS)


def distinct_keys(silver: DataFrame, column: str) -> DataFrame:
    return silver.where(F.col(column).isNotNull()).select(column).distinct()


def dim_date(silver: DataFrame) -> DataFrame:
    day = F.col("pickup_date")
    return distinct_keys(silver, "pickup_date").select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        day_name(day).alias("day_name"),
        day_of_week(day).alias("day_of_week"),
        year_month(day).alias("year_month"),
    )


def dim_vendor(silver: DataFrame) -> DataFrame:
    return distinct_keys(silver, "vendor_id").withColumn(
        "vendor_name", code_label(F.col("vendor_id"), VENDOR_NAMES, OTHER_VENDOR)
    )


def dim_payment_type(silver: DataFrame) -> DataFrame:
    return distinct_keys(silver, "payment_type").withColumn(
        "payment_type_name", code_label(F.col("payment_type"), PAYMENT_NAMES, OTHER_PAYMENT)
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    return zones.select("zone_id", "borough", "zone_name", "service_zone")


def daily_kpis(fact: DataFrame) -> DataFrame:
    return fact.groupBy("service_type", "pickup_date").agg(
        F.count("*").alias("trip_count"),
        exact_sum(F.col("fare_amount")).alias("total_fare_amount"),
        exact_mean(F.col("trip_distance")).alias("avg_trip_distance"),
    )


def zone_demand(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and revenue by service, day and pickup zone; zones missing from the lookup are NULL."""
    zone = Lookup(
        zones,
        "pickup_zone_id",
        "zone_id",
        {"zone_id": "zone_id", "borough": "borough", "zone_name": "zone_name"},
        how="left",
    )
    return star_rollup(
        fact, [count("trip_count"), total("total_amount", "total_amount")], [zone], ["service_type", "pickup_date"]
    )


def gold_anomaly() -> dict[str, Column]:
    return {
        "non_positive_trip_count": F.col("trip_count") <= 0,
        "negative_total_fare": F.col("total_fare_amount") < 0,
        "average_distance_out_of_range": (F.col("avg_trip_distance") < 0) | (F.col("avg_trip_distance") > 200),
    }


def gold_anomaly_rows(kpis: DataFrame) -> DataFrame:
    return kpis.where(any_of(gold_anomaly()))
