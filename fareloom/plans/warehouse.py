"""Bronze, silver and gold tables of one data folder, built on first use."""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fareloom.operators import gold
from fareloom.operators.silver import silver_trips
from fareloom.sources import tables
from fareloom.sources.feeds import FEEDS, FeedSpec, bronze_feed, scan_feed, scan_zone_csv, service_labels, unify_feeds
from fareloom.workspace import materialize


class Warehouse:
    """The tables of the lakehouse. Silver, the marts and the derived dimensions are stored."""

    def __init__(self, spark: SparkSession, feeds: dict[FeedSpec, DataFrame], zones: DataFrame):
        self.spark = spark
        self.bronze = feeds
        self.zones = zones

    @classmethod
    def from_landing(cls, spark: SparkSession, root: str, zone_csv: str) -> Warehouse:
        """Over a bronze folder laid out as <service>/year=YYYY/month=MM/."""
        feeds = {spec: scan_feed(spark, root, spec) for spec in FEEDS}
        return cls(spark, feeds, scan_zone_csv(spark, zone_csv))

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        """Over the order tables of a test-data folder."""
        landed = tables.landed_trips(spark, sf_dir)
        feeds = {spec: bronze_feed(tables.feed_view(landed, spec), spec) for spec in FEEDS}
        return cls(spark, feeds, tables.zone_rows(spark, sf_dir))

    @cached_property
    def unified(self) -> DataFrame:
        return unify_feeds(self.bronze)

    @property
    def silver_plan(self) -> DataFrame:
        """Silver as a query over bronze."""
        return silver_trips(self.unified)

    @cached_property
    def silver(self) -> DataFrame:
        """Silver as stored: one directory per source month, sorted by day inside it.

        A task's share of bronze grows with the files, as they are packed ever closer, so rows are dealt out by month
        before they are sorted: each task then sorts one shuffle partition of bounded size in memory.
        """
        return materialize(self.silver_plan, "silver", ("source_year", "source_month"), ("pickup_date",))

    @cached_property
    def fact_trips(self) -> DataFrame:
        return gold.fact_trips(self.silver)

    @cached_property
    def dim_date(self) -> DataFrame:
        return materialize(gold.dim_date(self.silver), "dim_date")

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return materialize(gold.dim_vendor(self.silver), "dim_vendor")

    @cached_property
    def dim_payment_type(self) -> DataFrame:
        return materialize(gold.dim_payment_type(self.silver), "dim_payment_type")

    @cached_property
    def dim_zone(self) -> DataFrame:
        return gold.dim_zone(self.zones)

    @cached_property
    def dim_service_type(self) -> DataFrame:
        return service_labels(self.spark)

    @cached_property
    def gold_daily_kpis(self) -> DataFrame:
        return materialize(gold.daily_kpis(self.fact_trips), "gold_daily_kpis", sort_by=("pickup_date",))

    @cached_property
    def gold_zone_demand(self) -> DataFrame:
        return materialize(
            gold.zone_demand(self.fact_trips, self.dim_zone), "gold_zone_demand", sort_by=("pickup_date",)
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def gold_tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in GOLD_TABLES}

    def register_views(self) -> None:
        """Make the gold tables visible to spark.sql under their names."""
        for name, frame in self.gold_tables().items():
            frame.createOrReplaceTempView(name)


GOLD_TABLES = (
    "gold_daily_kpis",
    "gold_zone_demand",
    "fact_trips",
    "dim_date",
    "dim_zone",
    "dim_service_type",
    "dim_vendor",
    "dim_payment_type",
)

_built: dict[tuple, Warehouse] = {}
_lock = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of a test-data folder, shared by the queries of one application."""
    key = (spark.sparkContext.applicationId, sf_dir, tables.tables_stamp(spark, sf_dir))
    with _lock:
        if key not in _built:
            _built[key] = Warehouse.from_tables(spark, sf_dir)
        return _built[key]
