import io
from contextlib import redirect_stdout
import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fareloom.functions.dates import DateWindow, in_months
from fareloom.operators import gold
from fareloom.operators.silver import silver_trips
from fareloom.plans import queries as q
from fareloom.plans.warehouse import warehouse
from fareloom.sources.feeds import YELLOW, bronze_feed, conform_feed
from fareloom.streaming import incremental
from tests.test_feeds_and_silver import FEED, trip


def plan_of(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_new_files_rebuild_only_their_months(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("source", "silver", "state"))
    schema = spark.createDataFrame([], FEED).schema

    def run():
        changes = incremental.stream_silver(incremental.stream_feed(spark, source, schema, YELLOW), YELLOW)

        def rebuild(months):
            everything = silver_trips(conform_feed(bronze_feed(spark.read.schema(schema).parquet(source), YELLOW), YELLOW))
            return everything.where(in_months(months))

        incremental.rebuild_touched_months(changes, out, state, rebuild).awaitTermination()
        return spark.read.parquet(out)

    february = dict(month=2, tpep_pickup_datetime=datetime(2024, 2, 2))
    spark.createDataFrame([trip(), trip(**february), trip(month=3)], FEED).write.parquet(source)
    first = run()
    assert first.count() == 2
    untouched = {r[0] for r in first.where("source_month = 1").select("_metadata.file_path").collect()}
    spark.createDataFrame([trip(**february), trip(**february)], FEED).write.mode("append").parquet(source)
    second = run()
    assert {(r[0], r[1]) for r in second.groupBy("source_month").count().collect()} == {(1, 1), (2, 3)}
    assert {r[0] for r in second.where("source_month = 1").select("_metadata.file_path").collect()} == untouched
    assert run().count() == 4

    mart = str(tmp_path / "kpis")
    incremental.refresh_daily_kpis(second, [(2024, 1), (2024, 2)], mart)
    incremental.refresh_daily_kpis(second, [(2024, 2)], mart)
    assert spark.read.parquet(mart).agg(F.sum("trip_count")).first()[0] == 4


def test_streamed_kpis_over_several_batches_equal_the_batch_result(spark, small, tmp_path):
    silver = warehouse(spark, small).silver.where("source_year = 1998")
    source, out, state = (str(tmp_path / n) for n in ("source", "out", "state"))
    for part in (0, 1):
        silver.where(F.col("vendor_id").cast("int") % 2 == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(silver.schema).parquet(source)
        incremental.write_updates(incremental.stream_daily_kpis(stream), out, state).awaitTermination()
    got = {tuple(r) for r in incremental.read_updates(spark, out).collect()}
    assert got == {tuple(r) for r in gold.daily_kpis(silver).collect()}


def test_a_landing_is_taken_in_batches_across_restarts(spark, small, tmp_path):
    from fareloom.sources.feeds import FEEDS
    from fareloom.sources.sinks import land_feed

    wh = warehouse(spark, small)
    root, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    schemas = {spec: wh.bronze[spec].drop("service_type").schema for spec in FEEDS}
    batches = []
    for last in (1996, 1999):
        for spec in FEEDS:
            land_feed(wh.bronze[spec].drop("service_type").where(F.col("year") <= last), root, spec)
        silver = incremental.stream_silver_feeds(spark, root, schemas, 15)
        incremental.write_updates(incremental.stream_daily_kpis(silver), out, state).awaitTermination()
        batches.append(len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch=")]))
        got = {tuple(r) for r in incremental.read_updates(spark, out).collect()}
        assert got == {tuple(r) for r in gold.daily_kpis(wh.silver.where(F.col("source_year") <= last)).collect()}
    assert batches[0] > 1 and batches[1] > batches[0] + 1


def test_a_delay_closes_old_days(spark, tmp_path):
    schema = "service_type string, pickup_date date, fare_amount double, trip_distance double"
    source, out, state = (str(tmp_path / n) for n in ("source", "out", "state"))
    for day in (date(2024, 1, 1), date(2024, 1, 9), date(2024, 1, 1)):
        spark.createDataFrame([("yellow_taxi", day, 1.0, 2.0)], schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        incremental.write_updates(incremental.stream_daily_kpis(stream, "2 days"), out, state).awaitTermination()
    got = {r.pickup_date: r.trip_count for r in incremental.read_updates(spark, out).collect()}
    assert got == {date(2024, 1, 1): 1, date(2024, 1, 9): 1}


def test_window_queries_prune_months_and_columns(spark, small):
    wh = warehouse(spark, small)
    plan = plan_of(q.vendor_analysis(wh, DateWindow.first_half(1998)))
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert any("source_year" in line and "source_month" in line for line in filters)
    assert "GreaterThanOrEqual(pickup_date,1998-01-01)" in plan
    scan = [line for line in plan.splitlines() if line.startswith("ReadSchema") and "trip_distance" in line][0]
    assert "dropoff_at" not in scan and "passenger_count" not in scan


def test_silver_is_built_without_a_shuffle_and_by_month(spark, small):
    wh = warehouse(spark, small)
    plan = plan_of(wh.silver_plan)
    assert "Exchange" not in plan
    pruned = plan_of(wh.silver_plan.where(in_months([(1998, 3), (1998, 4)])))
    filters = [line for line in pruned.splitlines() if line.startswith("PartitionFilters")]
    assert filters and all("year" in line and "month" in line for line in filters)


@pytest.mark.parametrize("name", ["vendor_rollup", "od_matrix", "zone_ranking"])
def test_fact_is_reduced_before_it_is_joined(spark, small, name):
    days = (date(1998, 1, 1), date(1998, 6, 30))
    wh = warehouse(spark, small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = getattr(q, name)(wh, *days)
        plan = plan_of(frame)
        result = {tuple(r) for r in frame.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Broadcast" not in plan
    assert result == {tuple(r) for r in getattr(q, name)(wh, *days).collect()}


def test_a_hot_key_does_not_change_results(spark):
    """A third of all rows on one zone and vendor."""
    rows = spark.range(30000).select(
        F.lit("yellow_taxi").alias("service_type"), F.lit(date(1998, 1, 5)).alias("pickup_date"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 50).cast("int") + 2).alias("pickup_zone_id"),
        (F.col("id") % 100 / 100).alias("total_amount"),
    )
    zones = spark.range(1, 40).select(
        F.col("id").cast("int").alias("zone_id"), F.concat(F.lit("b"), F.col("id") % 4).alias("borough"),
        F.concat(F.lit("z"), "id").alias("zone_name"),
    )
    got = {r.zone_id: (r.trip_count, r.total_amount) for r in gold.zone_demand(rows, zones).collect()}
    want = {}
    for i in range(30000):
        zone = 1 if i % 3 == 0 else i % 50 + 2
        key = zone if zone < 40 else None
        want.setdefault(key, []).append(i % 100 / 100)
    assert got == {k: (len(amounts), math.fsum(amounts)) for k, amounts in want.items()}


def test_a_rewritten_folder_is_noticed(spark, small, tmp_path):
    import shutil

    for name in ("lineitem", "orders", "customer", "supplier", "nation", "region"):
        shutil.copyfile(f"{small}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = warehouse(spark, str(tmp_path)).silver.count()
    assert warehouse(spark, str(tmp_path)) is warehouse(spark, str(tmp_path))
    shutil.copyfile("/root/testdata/sf0.01/orders.parquet", tmp_path / "orders.parquet")
    shutil.copyfile("/root/testdata/sf0.01/lineitem.parquet", tmp_path / "lineitem.parquet")
    assert warehouse(spark, str(tmp_path)).silver.count() != before


@pytest.mark.parametrize("name", ["compare_results", "distance_median_mean", "latency_percentiles_overall", "service_share"])
def test_no_cross_joins(spark, small, name):
    import __spark_entry__ as entry

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(entry.queries()[name](spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Cartesian" not in plan and "NestedLoop" not in plan
