"""Named analytic queries over the gold tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as RowWindow
from pyspark.sql import functions as F

from fareloom.functions.dates import DateWindow, between_days, year_month
from fareloom.functions.numbers import exact_mean, exact_sum, merged_state, state_value, sum_state
from fareloom.operators.ranking import rank_metric, share_of_total, top_n, weighted_mean
from fareloom.operators.selection import exact_median
from fareloom.operators.star import Lookup, count, mean, star_rollup, total
from fareloom.plans.warehouse import Warehouse

Window = DateWindow | None

TRIPS = count("trip_count")
REVENUE = total("total_amount", "total_amount")
FARE = total("total_fare_amount", "fare_amount")
DISTANCE = mean("avg_trip_distance", "trip_distance")


def narrowed(df: DataFrame, window: Window, service: str | None = None) -> DataFrame:
    """Window and service filters; either may be absent."""
    if window is not None:
        df = window.over(df)
    if service is not None:
        df = df.where(F.col("service_type") == service)
    return df


def _vendor(wh: Warehouse) -> Lookup:
    return Lookup(wh.dim_vendor, "vendor_id", "vendor_id", {"vendor_name": "vendor_name"})


def _payment(wh: Warehouse, **kw) -> Lookup:
    return Lookup(wh.dim_payment_type, "payment_type", "payment_type", {"payment_type_name": "payment_type_name"}, **kw)


def _calendar(wh: Warehouse, *columns: str) -> Lookup:
    return Lookup(wh.dim_date, "pickup_date", "pickup_date", {c: c for c in columns})


def _zone(wh: Warehouse, role: str, labels: dict[str, str], where: Column | None = None) -> Lookup:
    return Lookup(wh.dim_zone, f"{role}_zone_id", "zone_id", labels, where=where)


# Monthly questions


def monthly_service_comparison(wh: Warehouse, window: Window = None) -> DataFrame:
    return monthly_service_kpi(wh, "trip_count", window)


def monthly_service_kpi(wh: Warehouse, metric: str, window: Window = None) -> DataFrame:
    """One metric per month and service; the distance is the mean of the daily means."""
    value = {
        "trip_count": F.sum("trip_count"),
        "avg_trip_distance": exact_mean(F.col("avg_trip_distance")),
        "total_fare_amount": exact_sum(F.col("total_fare_amount")),
    }[metric]
    kpis = narrowed(wh.gold_daily_kpis, window)
    month = year_month(F.col("pickup_date")).alias("month")
    return kpis.groupBy(month, "service_type").agg(value.alias(metric)).orderBy("month", "service_type")


def monthly_service_total_amount(wh: Warehouse, window: Window = None) -> DataFrame:
    fact = narrowed(wh.fact_trips, window).withColumn("month", year_month(F.col("pickup_date")))
    return star_rollup(fact, [REVENUE, TRIPS], (), ["month", "service_type"]).orderBy("month", "service_type")


def monthly_trip_trend(wh: Warehouse, window: Window = None, service: str | None = None) -> DataFrame:
    fact = narrowed(wh.fact_trips, window, service)
    measures = [total("total_trip_distance", "trip_distance"), TRIPS, FARE, DISTANCE]
    return star_rollup(fact, measures, [_calendar(wh, "year_month")]).orderBy("year_month")


# Zones and boroughs


def zone_demand_ranking(
    wh: Warehouse, window: Window = None, service: str | None = None, metric: str = "trip_count", n: int | None = None
) -> DataFrame:
    return _mart_ranking(wh, ["zone_name", "borough"], window, service, metric, n)


def pickup_borough_demand(
    wh: Warehouse, window: Window = None, service: str | None = None, metric: str = "trip_count", n: int | None = None
) -> DataFrame:
    return _mart_ranking(wh, ["borough"], window, service, metric, n)


def _mart_ranking(wh, labels, window, service, metric, n):
    demand = narrowed(wh.gold_zone_demand, window, service)
    ranked = demand.groupBy(*labels).agg(
        F.sum("trip_count").alias("trip_count"), exact_sum(F.col("total_amount")).alias("total_amount")
    )
    return top_n(ranked, rank_metric(metric, {"trip_count", "total_amount"}), labels, n)


def dropoff_borough_demand(
    wh: Warehouse, window: Window = None, service: str | None = None, metric: str = "trip_count", n: int | None = None
) -> DataFrame:
    fact = narrowed(wh.fact_trips, window, service)
    ranked = star_rollup(fact, [TRIPS, REVENUE], [_zone(wh, "dropoff", {"borough": "borough"})])
    return top_n(ranked, rank_metric(metric, {"trip_count", "total_amount"}), ["borough"], n)


def pickup_zone_trips(wh: Warehouse, window: Window = None) -> DataFrame:
    """The fact joined to the zones in the pickup role; unlike the mart, unmatched trips drop."""
    fact = narrowed(wh.fact_trips, window)
    zone = _zone(wh, "pickup", {"zone_name": "zone_name", "service_zone": "service_zone"})
    return star_rollup(fact, [TRIPS, REVENUE], [zone])


def pickup_dropoff_matrix(wh: Warehouse, window: Window = None, n: int | None = None) -> DataFrame:
    fact = narrowed(wh.fact_trips, window)
    roles = [_zone(wh, r, {f"{r}_borough": "borough"}) for r in ("pickup", "dropoff")]
    return top_n(star_rollup(fact, [TRIPS, REVENUE], roles), "trip_count", ["pickup_borough", "dropoff_borough"], n)


# Vendors and payments


def vendor_analysis(
    wh: Warehouse, window: Window = None, service: str | None = None, metric: str = "trip_count", n: int | None = None
) -> DataFrame:
    ranked = star_rollup(narrowed(wh.fact_trips, window, service), [TRIPS, REVENUE, FARE, DISTANCE], [_vendor(wh)])
    available = {"trip_count", "total_amount", "total_fare_amount", "avg_trip_distance"}
    return top_n(ranked, rank_metric(metric, available), ["vendor_name"], n)


def vendor_monthly_trend(wh: Warehouse, window: Window = None, service: str | None = None) -> DataFrame:
    fact = narrowed(wh.fact_trips, window, service)
    trend = star_rollup(fact, [TRIPS, REVENUE], [_calendar(wh, "year_month"), _vendor(wh)])
    return trend.orderBy("year_month", F.desc("trip_count"), "vendor_name")


def payment_analysis(
    wh: Warehouse, window: Window = None, service: str | None = None, metric: str = "trip_count", n: int | None = None
) -> DataFrame:
    """Trips without a payment code have no dimension row and drop out."""
    ranked = star_rollup(narrowed(wh.fact_trips, window, service), [TRIPS, REVENUE], [_payment(wh)])
    return top_n(ranked, rank_metric(metric, {"trip_count", "total_amount"}), ["payment_type_name"], n)


def payment_by_month(wh: Warehouse, window: Window = None) -> DataFrame:
    fact = narrowed(wh.fact_trips, window)
    return star_rollup(fact, [TRIPS], [_calendar(wh, "year_month"), _payment(wh)])


# The five benchmark reports


def daily_kpi_trend(wh: Warehouse, first: date, last: date) -> DataFrame:
    return between_days(wh.gold_daily_kpis, first, last).orderBy("pickup_date", "service_type")


def zone_ranking(wh: Warehouse, first: date, last: date, n: int = 25) -> DataFrame:
    demand = between_days(wh.gold_zone_demand, first, last)
    ranked = demand.groupBy("zone_name", "borough").agg(
        F.sum("trip_count").alias("trips"), exact_sum(F.col("total_amount")).alias("total_amount")
    )
    return top_n(ranked, "trips", ["zone_name", "borough"], n)


def vendor_rollup(wh: Warehouse, first: date, last: date) -> DataFrame:
    fact = between_days(wh.fact_trips, first, last)
    return top_n(star_rollup(fact, [count("trips"), REVENUE], [_vendor(wh)]), "trips", ["vendor_name"])


def payment_rollup(wh: Warehouse, first: date, last: date) -> DataFrame:
    fact = between_days(wh.fact_trips, first, last)
    return top_n(star_rollup(fact, [count("trips"), REVENUE], [_payment(wh)]), "trips", ["payment_type_name"])


def od_matrix(wh: Warehouse, first: date, last: date, n: int = 50) -> DataFrame:
    fact = between_days(wh.fact_trips, first, last)
    roles = [_zone(wh, r, {f"{r}_borough": "borough"}) for r in ("pickup", "dropoff")]
    return top_n(star_rollup(fact, [count("trips")], roles), "trips", ["pickup_borough", "dropoff_borough"], n)


# Dashboard panels


def dashboard_cards(wh: Warehouse, window: Window = None) -> DataFrame:
    """Total trips and fare, the mean of daily means, and the mean weighted by trips."""
    return narrowed(wh.gold_daily_kpis, window).agg(
        F.sum("trip_count").alias("total_trips"),
        exact_sum(F.col("total_fare_amount")).alias("total_fare"),
        exact_mean(F.col("avg_trip_distance")).alias("mean_of_daily_means"),
        F.round(weighted_mean(F.col("avg_trip_distance"), F.col("trip_count")), 6).alias("weighted_mean_distance"),
    )


def monthly_fare(wh: Warehouse, window: Window = None) -> DataFrame:
    month = year_month(F.col("pickup_date")).alias("month")
    kpis = narrowed(wh.gold_daily_kpis, window)
    return kpis.groupBy(month).agg(exact_sum(F.col("total_fare_amount")).alias("total_fare_amount")).orderBy("month")


def distance_by_service(wh: Warehouse, window: Window = None) -> DataFrame:
    kpis = narrowed(wh.gold_daily_kpis, window)
    return kpis.groupBy("service_type").agg(exact_mean(F.col("avg_trip_distance")).alias("avg_trip_distance"))


def top10_zones(wh: Warehouse, window: Window = None) -> DataFrame:
    demand = narrowed(wh.gold_zone_demand, window)
    return top_n(demand.groupBy("zone_name").agg(F.sum("trip_count").alias("trip_count")), "trip_count", ["zone_name"], 10)


def service_share(wh: Warehouse, window: Window = None) -> DataFrame:
    kpis = narrowed(wh.gold_daily_kpis, window)
    return share_of_total(kpis.groupBy("service_type").agg(F.sum("trip_count").alias("trip_count")), "trip_count")


# Exports and serving tables


def payment_summary(wh: Warehouse, window: Window = None) -> DataFrame:
    """Every payment code, also the missing one; a code without a label reads 'Unknown'."""
    fact = narrowed(wh.fact_trips, window)
    labelled = star_rollup(
        fact,
        [count("trips"), total("revenue", "total_amount")],
        [_payment(wh, how="left", default="Unknown")],
        ["payment_type"],
    )
    return labelled.withColumn("revenue", F.round("revenue", 2)).orderBy(F.desc("trips"), "payment_type")


def payment_summary_serving(wh: Warehouse, window: Window = None) -> DataFrame:
    fact = narrowed(wh.fact_trips, window)
    summary = star_rollup(fact, [count("trips"), total("revenue", "total_amount")], (), ["payment_type"])
    return summary.withColumn("revenue", F.round("revenue", 2)).orderBy(F.desc("trips"), "payment_type")


# Shares, medians, calendar and single-value questions


def insight_shares(wh: Warehouse, window: Window = None) -> DataFrame:
    """Share of trips by pickup borough, service zone and payment label, and revenue of airport zones.

    The fact is reduced to its zone and payment keys once. Each of those few rows then counts
    under every insight it has a dimension row for.
    """
    keyed = narrowed(wh.fact_trips, window).groupBy("pickup_zone_id", "payment_type").agg(
        F.count("*").alias("n"), sum_state(F.col("total_amount")).alias("amount")
    )
    zones = wh.dim_zone.select(F.col("zone_id").alias("pickup_zone_id"), "borough", "zone_name", "service_zone", F.lit(True).alias("has_zone"))
    payments = wh.dim_payment_type.withColumn("has_payment", F.lit(True))
    labelled = keyed.join(zones, "pickup_zone_id", "left").join(payments, "payment_type", "left")

    def entry(insight: str, label: str, counts: Column) -> Column:
        return F.when(counts, F.struct(F.lit(insight).alias("insight"), F.col(label).alias("group_name")))

    entries = F.array_compact(
        F.array(
            entry("pickup_borough", "borough", F.col("has_zone")),
            entry("service_zone", "service_zone", F.col("has_zone")),
            entry("payment_type", "payment_type_name", F.col("has_payment")),
            entry("airport_revenue", "zone_name", F.col("service_zone") == "Airports"),
        )
    )
    grouped = labelled.select("n", "amount", F.inline(entries)).groupBy("insight", "group_name").agg(
        F.sum("n").alias("trips"), state_value(merged_state("amount")).alias("revenue")
    )
    # One row per label by now, so the window holds no more rows than the dimension has labels.
    all_trips = F.sum("trips").over(RowWindow.partitionBy("insight"))
    return grouped.withColumn("share_pct", F.round(F.try_divide(F.col("trips") * 100.0, all_trips), 2))


def distance_median_mean(wh: Warehouse, window: Window = None) -> DataFrame:
    fact = narrowed(wh.fact_trips, window)
    return exact_median(fact, "trip_distance", "median_distance", mean="mean_distance")


def derived_calendar(wh: Warehouse, *columns: str, window: Window = None) -> DataFrame:
    """Trips by a calendar column such as quarter, or weekday name and number."""
    return star_rollup(narrowed(wh.fact_trips, window), [TRIPS], [_calendar(wh, *columns)])


def city_totals(wh: Warehouse, borough: str, window: Window = None) -> DataFrame:
    """Single values over the whole city and one borough."""
    fact = narrowed(wh.fact_trips, window)
    zones = wh.dim_zone.where(F.col("borough") == borough).select(F.col("zone_id").alias("pickup_zone_id"))
    per_zone = fact.groupBy("pickup_zone_id").agg(
        F.count("*").alias("n"), F.min("pickup_date").alias("first"), F.max("pickup_date").alias("last"),
        F.max("trip_distance").alias("longest"), F.max("total_amount").alias("dearest"),
    )
    flagged = per_zone.join(zones.withColumn("_in", F.lit(1)), "pickup_zone_id", "left")
    in_borough = F.coalesce(F.sum(F.when(F.col("_in") == 1, F.col("n"))), F.lit(0))
    return flagged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("trip_count"),
        F.count("pickup_zone_id").alias("distinct_pickup_zones"),
        in_borough.alias("borough_trips"),
        F.round(F.try_divide(in_borough * 100.0, F.sum("n")), 2).alias("borough_pct"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
        F.max("longest").alias("max_distance"),
        F.max("dearest").alias("max_total_amount"),
    )


def service_labelled(wh: Warehouse, window: Window = None) -> DataFrame:
    label = Lookup(wh.dim_service_type, "service_type", "service_type", {"service_type_name": "service_type_name"})
    return star_rollup(narrowed(wh.fact_trips, window), [TRIPS], [label])


def distinct_counts(wh: Warehouse, window: Window = None) -> DataFrame:
    """Distinct values per service. Each distinct key is shuffled once, however often it occurs."""
    return narrowed(wh.fact_trips, window).groupBy("service_type").agg(
        F.countDistinct("vendor_id").alias("vendors"),
        F.countDistinct("pickup_zone_id").alias("pickup_zones"),
        F.countDistinct("pickup_date").alias("days"),
    )


def counts_by_year(wh: Warehouse) -> DataFrame:
    return wh.fact_trips.groupBy(F.year("pickup_date").alias("year")).agg(F.count("*").alias("trip_count"))


def date_range(wh: Warehouse) -> DataFrame:
    return wh.fact_trips.agg(
        F.min("pickup_date").alias("first_date"), F.max("pickup_date").alias("last_date"), F.count("*").alias("trip_count")
    )


def partition_months(wh: Warehouse, year: int, first_month: int, last_month: int) -> DataFrame:
    """Trips per source month of a range; only those month directories are read."""
    rows = wh.silver.where((F.col("source_year") == year) & F.col("source_month").between(first_month, last_month))
    return rows.groupBy("source_year", "source_month", "service_type").agg(F.count("*").alias("trip_count"))


def layer_row_counts(wh: Warehouse, window: DateWindow) -> DataFrame:
    """Rows per layer and service, over everything and over the window."""
    day = window.days()
    layers = None
    unified = wh.unified.withColumn("pickup_date", F.to_date("pickup_at"))
    for layer, frame in (
        ("bronze", unified),
        ("silver", wh.silver),
        ("gold_daily_kpis", wh.gold_daily_kpis),
        ("gold_zone_demand", wh.gold_zone_demand),
    ):
        part = frame.groupBy("service_type").agg(
            F.count("*").alias("all_rows"), F.count_if(day).alias("window_rows")
        ).select(F.lit(layer).alias("layer"), "service_type", "all_rows", "window_rows")
        layers = part if layers is None else layers.unionByName(part)
    return layers
