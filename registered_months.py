"""Registered queries over months as files: scans of drifting schemas, landing, full and incremental runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.numbers import exact_sum
from fareloom.plans.medallion import StoredWarehouse, run_medallion
from fareloom.plans.warehouse import Warehouse, warehouse
from fareloom.sources import derived_logs as logs
from fareloom.sources.feeds import FEEDS, GREEN, YELLOW, FeedSpec, conform_feed, feed_folder, register_months, scan_feed
from fareloom.sources.sinks import land_feed
from fareloom.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Source months that a run rebuilds in ``medallion_incremental``: the first and last lose rows, the second all of them.
CHANGED = [(1995, 1), (1995, 2), (1995, 3)]


def _scan(spec: FeedSpec) -> Query:
    """A feed's months as two generations of files: whole codes, and from July 1995 on floating ones with a fee."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = warehouse(spark, sf_dir).bronze[spec].drop("service_type")
        root = scratch_path(spark, "drifting")
        base = feed_folder(root, spec)
        early = F.col("year") * 100 + F.col("month") < 199507
        raw.where(early).write.partitionBy("year", "month").parquet(base)
        codes = {c: F.col(c).cast("double") for c in ("VendorID", "payment_type", "passenger_count", "PULocationID")}
        late = raw.where(~early).withColumns({**codes, "airport_fee": F.col("DOLocationID") * 0.25})
        late.write.mode("append").partitionBy("year", "month").parquet(base)
        register_months(spark, root, spec)
        found = scan_feed(spark, root, spec)
        fee = F.col("airport_fee") if "airport_fee" in found.columns else F.lit(None).cast("double")
        return conform_feed(found, spec).join(
            found.groupBy(F.col("year").alias("source_year"), F.col("month").alias("source_month")).agg(exact_sum(fee).alias("month_fees")),
            ["source_year", "source_month"],
        )

    return run


def _landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by month after three landings: half the months, then all of them over the rest of a failed one, then all again."""
    wh, root = warehouse(spark, sf_dir), scratch_path(spark, "landed_twice")
    both = None
    for spec in FEEDS:
        raw = wh.bronze[spec].drop("service_type")
        first = land_feed(raw.where(F.col("month") <= 6), root, spec)
        # a failed landing leaves files of a month that the register does not have
        raw.where(F.col("month") == 7).limit(5).write.mode("append").partitionBy("year", "month").parquet(feed_folder(root, spec))
        second, third = land_feed(raw, root, spec), land_feed(raw, root, spec)
        counted = scan_feed(spark, root, spec).groupBy("service_type", "year", "month").agg(F.count("*").alias("trips"))
        part = counted.select("*", *(F.lit(n).cast("long").alias(c) for c, n in (("first", first), ("second", second), ("third", third))))
        both = part if both is None else both.unionByName(part)
    return both


def _marts(wh: StoredWarehouse) -> DataFrame:
    days = wh.gold_daily_kpis.select(F.lit("gold_daily_kpis").alias("mart"), "service_type", "pickup_date", "trip_count", F.col("total_fare_amount").alias("amount"))
    zones = wh.gold_zone_demand.groupBy("service_type", "pickup_date").agg(F.sum("trip_count").alias("trip_count"), exact_sum(F.col("total_amount")).alias("amount"))
    return days.unionByName(zones.select(F.lit("gold_zone_demand").alias("mart"), "*"))


def _run(spark: SparkSession, sf_dir: str, source: Warehouse, root: str, run_id: str, months=None) -> StoredWarehouse:
    named = dict(job="monthly", run_mode="manual", logical_date="1998-09-01", created_at_utc="1998-09-01T00:00:00+00:00")
    return run_medallion(spark, source, root, logs.ingestion_results(spark, sf_dir), run_id=run_id, months=months, **named)[0]


def _medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(_run(spark, sf_dir, warehouse(spark, sf_dir), scratch_path(spark, "lake"), "full"))


def _medallion_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run, then one over the changed months of a bronze that lost rows there."""
    wh, root = warehouse(spark, sf_dir), scratch_path(spark, "lake")
    _run(spark, sf_dir, wh, root, "full")
    at = F.col("year") * 100 + F.col("month")
    left = (at != 199502) & (~at.isin(199501, 199503) | (F.col("passenger_count") <= 3))
    changed = Warehouse(spark, {spec: frame.where(left) for spec, frame in wh.bronze.items()}, wh.zones)
    return _marts(_run(spark, sf_dir, changed, root, "changed", CHANGED))


def all_queries() -> dict[str, Query]:
    return {
        "scan_yellow": _scan(YELLOW),
        "scan_green": _scan(GREEN),
        "landed_twice": _landed_twice,
        "medallion_run": _medallion_run,
        "medallion_incremental": _medallion_incremental,
    }
