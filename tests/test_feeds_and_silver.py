from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fareloom.operators import gold
from fareloom.operators.silver import reject_diagnostics, silver_anomaly_rows, silver_trips
from fareloom.plans.medallion import run_medallion
from fareloom.plans.warehouse import Warehouse
from fareloom.sources.documents import read_run_documents
from fareloom.sources.feeds import FEEDS, GREEN, YELLOW, bronze_feed, conform_feed, scan_feed, scan_zone_csv, unify_feeds
from fareloom.sources.sinks import land_feed

FEED = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID bigint, "
    "DOLocationID bigint, passenger_count bigint, trip_distance double, fare_amount double, total_amount double, "
    "payment_type bigint, year int, month int"
)


def trip(**kw):
    base = dict(
        VendorID=1, tpep_pickup_datetime=datetime(2024, 1, 15, 8), tpep_dropoff_datetime=datetime(2024, 1, 15, 9),
        PULocationID=1, DOLocationID=2, passenger_count=1, trip_distance=2.0, fare_amount=10.0, total_amount=12.0,
        payment_type=1, year=2024, month=1,
    )
    return tuple({**base, **kw}.values())


@pytest.fixture(scope="module")
def unified(spark):
    at = lambda *a: datetime(*a)
    rows = [
        trip(),
        trip(tpep_pickup_datetime=None),
        trip(tpep_dropoff_datetime=None),
        trip(PULocationID=None),
        trip(DOLocationID=None),
        trip(trip_distance=-1.0),
        trip(trip_distance=None),
        trip(fare_amount=-1.0),
        trip(fare_amount=None),
        trip(fare_amount=0.0),
        trip(tpep_pickup_datetime=at(2024, 1, 1)),
        trip(tpep_pickup_datetime=at(2024, 2, 1)),
        trip(year=2023, month=12, tpep_pickup_datetime=at(2023, 12, 31, 23, 59)),
        trip(tpep_dropoff_datetime=at(2024, 1, 15, 7)),
        trip(trip_distance=250.0),
        trip(total_amount=-5.0),
        trip(payment_type=None),
        trip(payment_type=9),
        trip(VendorID=7),
        trip(PULocationID=99),
    ]
    raw = spark.createDataFrame(rows, FEED)
    return unify_feeds({YELLOW: bronze_feed(raw, YELLOW)})


def zones(spark):
    return spark.createDataFrame(
        [(1, "Queens", "A", "Boro Zone"), (2, "Bronx", "B", "Airports")],
        "zone_id int, borough string, zone_name string, service_zone string",
    )


def test_silver_keeps_only_valid_rows(unified):
    assert silver_trips(unified).count() == 11


def test_reject_diagnostics_counts_overlapping_rules(unified):
    got = {r["check_name"]: r["row_count"] for r in reject_diagnostics(unified).collect()}
    assert got["raw_rows"] == 20 and got["passed"] == 11 and got["failed"] == 9
    assert got["null_pickup_timestamp"] == got["null_dropoff_zone"] == got["negative_distance"] == got["negative_fare"] == 1
    assert got["outside_source_month"] == 1


def test_anomalies_stay_and_are_listed(unified):
    assert silver_anomaly_rows(silver_trips(unified)).count() == 3


def test_labels_and_null_zone_group(spark, unified):
    silver = silver_trips(unified)
    vendors = {r[0]: r[1] for r in gold.dim_vendor(silver).collect()}
    assert vendors["7"] == "Unknown vendor" and len(vendors) == 2
    payments = {r[0]: r[1] for r in gold.dim_payment_type(silver).collect()}
    assert payments == {"1": "Credit card", "9": "Other"}
    demand = gold.zone_demand(silver, zones(spark)).where("zone_id is null").collect()
    assert [(r.borough, r.trip_count) for r in demand] == [(None, 1)]


def test_calendar_names_and_weekday_numbers(spark, unified):
    rows = {r.pickup_date: r for r in gold.dim_date(silver_trips(unified)).collect()}
    assert rows[date(2023, 12, 31)].day_name == "Sunday" and rows[date(2023, 12, 31)].day_of_week == 0
    assert rows[date(2024, 1, 1)].year_month == "2024-01" and rows[date(2024, 1, 1)].quarter == 1


def test_months_with_different_types_unite(spark, tmp_path):
    root = str(tmp_path)
    base = f"{root}/yellow_taxi"
    first = spark.createDataFrame([trip()], FEED).drop("year", "month")
    second = first.withColumns(
        {
            "VendorID": F.lit(2.0), "payment_type": F.lit(1.0), "passenger_count": F.lit(2.5),
            "PULocationID": F.lit(3.0), "airport_fee": F.lit(1.25),
            "tpep_pickup_datetime": F.lit(datetime(2024, 2, 3)).cast("timestamp_ntz"),
        }
    )
    first.write.parquet(f"{base}/year=2024/month=01")
    second.write.parquet(f"{base}/year=2024/month=02")
    bronze = scan_feed(spark, root, YELLOW)
    assert bronze.columns[0] == "service_type" and "airport_fee" in bronze.columns
    rows = {r.source_month: r for r in conform_feed(bronze, YELLOW).collect()}
    assert rows[1].vendor_id == "1" and rows[2].vendor_id == "2" and rows[2].payment_type == "1"
    assert rows[2].passenger_count == 2 and rows[2].pickup_zone_id == 3
    assert rows[1].source_year == 2024


def test_files_of_one_month_may_conflict_too(spark, tmp_path):
    month = f"{tmp_path}/yellow_taxi/year=2024/month=01"
    rows = spark.createDataFrame([trip()], FEED).drop("year", "month")
    rows.write.parquet(month)
    rows.withColumn("VendorID", F.lit(2.0)).write.mode("append").parquet(month)
    assert {r.VendorID for r in scan_feed(spark, str(tmp_path), YELLOW).collect()} == {"1", "2"}


def test_landing_leaves_existing_months_alone(spark, tmp_path):
    root = str(tmp_path)
    january = spark.createDataFrame([trip()], FEED)
    assert land_feed(january, root, YELLOW) == 1
    later = spark.createDataFrame([trip(), trip(), trip(month=2, tpep_pickup_datetime=datetime(2024, 2, 2))], FEED)
    assert land_feed(later, root, YELLOW) == 1
    assert scan_feed(spark, root, YELLOW).count() == 2


def test_zone_csv_is_renamed_and_cast(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n')
    row = scan_zone_csv(spark, str(path)).first()
    assert tuple(row) == (1, "EWR", "Newark, Airport", "EWR")


def test_warehouse_over_landing_files(spark, tmp_path):
    root = str(tmp_path / "bronze")
    land_feed(spark.createDataFrame([trip(), trip(fare_amount=-2.0)], FEED), root, YELLOW)
    green = spark.createDataFrame([trip(DOLocationID=1)], FEED)
    green = green.withColumnsRenamed(
        {"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"}
    )
    land_feed(green, root, GREEN)
    csv = tmp_path / "zones.csv"
    csv.write_text("LocationID,Borough,Zone,service_zone\n1,Queens,A,Airports\n2,Bronx,B,Boro Zone\n")
    wh = Warehouse.from_landing(spark, root, str(csv))
    got = {r.service_type: (r.trip_count, r.total_fare_amount) for r in wh.gold_daily_kpis.collect()}
    assert got == {f.service_type: (1, 10.0) for f in FEEDS}
    ingestion = spark.createDataFrame(
        [("yellow", "uploaded", "u", "k", "2024", "01", "5", "s")],
        "dataset string, status string, source_url string, bronze_object_key string, year string, month string, file_size_bytes string, sha256 string",
    )
    named = dict(job="job", run_mode="manual", logical_date="2024-02-01", created_at_utc="t")
    stored, key = run_medallion(spark, wh, str(tmp_path / "lake"), ingestion, run_id="r1", **named)
    assert key == "metadata/pipeline_runs/job/2024-02-01/r1.json"
    assert stored.gold_daily_kpis.count() == 2
    # Another file arrives for January; only that month is rebuilt.
    spark.createDataFrame([trip()], FEED).drop("year", "month").write.mode("append").parquet(f"{root}/yellow_taxi/year=2024/month=1")
    again = Warehouse.from_landing(spark, root, str(csv))
    stored, _ = run_medallion(spark, again, str(tmp_path / "lake"), ingestion, run_id="r2", months=[(2024, 1)], **named)
    assert stored.silver.count() == 3 and stored.gold_daily_kpis.agg(F.sum("trip_count")).first()[0] == 3
    docs = read_run_documents(spark, str(tmp_path / "lake"), "job")
    gates = {r[0] for r in docs.select(F.get_json_object("doc", "$.quality_gate.status")).collect()}
    assert gates == {"passed"} and docs.count() == 2

    wh.register_views()
    assert spark.sql("select sum(trip_count) from gold_zone_demand where borough = 'Queens'").first()[0] == 2
