"""Time the headline queries: one JSON line with seconds per query.

Table builds are timed once each; queries run once to warm up and report the median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import date

from fareloom.functions.dates import DateWindow
from fareloom.operators import gold, quality
from fareloom.plans import queries as q
from fareloom.plans.warehouse import Warehouse
from fareloom.workspace import local_session, materialize

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
DAYS = (date(1998, 1, 1), date(1998, 6, 30))
H1 = DateWindow.first_half(1998)


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS), app="fareloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    # Scanning the tables once keeps JVM start-up out of the first build.
    for name in ("lineitem", "orders", "customer", "supplier"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.format("noop").mode("overwrite").save()
    holder = {}
    seconds["bronze_landing"] = timed(lambda: holder.update(wh=Warehouse.from_tables(spark, SF_DIR)))
    wh = holder["wh"]
    seconds["silver_build"] = timed(lambda: wh.silver)
    for name in ("gold_daily_kpis", "gold_zone_demand", "dim_date", "dim_vendor", "dim_payment_type"):
        seconds[f"{name}_build"] = timed(lambda name=name: wh.table(name))

    reports = {
        "daily_kpi_trend": lambda: q.daily_kpi_trend(wh, *DAYS),
        "zone_ranking": lambda: q.zone_ranking(wh, *DAYS),
        "vendor_rollup": lambda: q.vendor_rollup(wh, *DAYS),
        "payment_rollup": lambda: q.payment_rollup(wh, *DAYS),
        "od_matrix": lambda: q.od_matrix(wh, *DAYS),
        "monthly_service_comparison": lambda: q.monthly_service_comparison(wh, H1),
        "monthly_trip_trend_all": lambda: q.monthly_trip_trend(wh),
        "vendor_monthly_trend_all": lambda: q.vendor_monthly_trend(wh),
        "vendor_analysis_all": lambda: q.vendor_analysis(wh),
        "pickup_dropoff_matrix_all": lambda: q.pickup_dropoff_matrix(wh),
        "payment_summary_all": lambda: q.payment_summary(wh),
        "insight_shares_all": lambda: q.insight_shares(wh),
        "distance_median_mean_all": lambda: q.distance_median_mean(wh),
        "daily_kpis_from_fact": lambda: gold.daily_kpis(wh.fact_trips),
        "zone_demand_from_fact": lambda: gold.zone_demand(wh.fact_trips, wh.dim_zone),
        "quality_report": lambda: quality.quality_report(
            {**wh.gold_tables(), "zone_lookup": wh.dim_zone, "silver_trips": wh.silver}
        ),
    }
    for name, build in reports.items():
        run = lambda build=build: build().collect()
        run()
        seconds[name] = statistics.median(timed(run) for _ in range(REPEATS))
    seconds["silver_rebuild"] = timed(
        lambda: materialize(wh.silver_plan, "silver", ("source_year", "source_month"), ("pickup_date",), rebalance=False)
    )
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in seconds.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
