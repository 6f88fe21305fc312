"""What a task holds stays bounded when a month or a name has many rows."""

from pyspark.sql import functions as F

import registered_control
from fareloom.plans.catalog import name_differences
from fareloom.plans.medallion import StoredWarehouse
from fareloom.plans.warehouse import Warehouse
from fareloom.sources.feeds import GREEN, YELLOW, feed_folder
from fareloom.sources.sinks import land_feed
from fareloom.streaming import incremental
from fareloom.workspace import replace_partitions


def _scattered_month(spark, tmp_path):
    """Bronze whose only month lies in eight files, which are read by eight tasks."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.lit(2024).alias("year"), F.lit(1).alias("month"), (F.col("id") % 3).alias("VendorID"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 31 as int))").alias("pickup"),
        (F.col("id") % 20).cast("int").alias("PULocationID"), (F.col("id") % 19).cast("int").alias("DOLocationID"),
        F.lit(1).alias("passenger_count"), F.rand(1).alias("trip_distance"), F.rand(2).alias("fare_amount"),
        F.rand(3).alias("total_amount"), F.lit("1").alias("payment_type"),
    )
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    feeds = {}
    for spec, letter in ((YELLOW, "t"), (GREEN, "l")):
        named = stored.where(F.lit(spec is YELLOW)).withColumns({f"{letter}pep_{k}_datetime": F.col("pickup") for k in ("pickup", "dropoff")}).drop("pickup")
        feeds[spec] = named.select(F.lit(spec.service_type).alias("service_type"), "*")
    zones = spark.createDataFrame([(i, "b", f"z{i}", "s") for i in range(20)], "zone_id int, borough string, zone_name string, service_zone string")
    return Warehouse(spark, feeds, zones)


def _files_and_rows(silver):
    return silver.select(F.input_file_name().alias("f")).distinct().count(), silver.count()


def test_silver_is_dealt_out_by_month_in_bounded_parts(spark, tmp_path):
    """One file for a small month, although eight tasks read it, and several where the month exceeds the advised size."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        for size, least, most in ((before, 1, 1), ("64k", 2, 1000)):
            spark.conf.set(name, size)
            wh = _scattered_month(spark, f"{tmp_path}/{size}")
            lake = StoredWarehouse(spark, wh, f"{tmp_path}/{size}/lake")
            lake.build_silver()
            for silver in (wh.silver, lake.silver):
                files, rows = _files_and_rows(silver)
                assert least <= files <= most and rows == 60_000
    finally:
        spark.conf.set(name, before)


def test_touched_months_are_dealt_out_by_month(spark, tmp_path, monkeypatch):
    dealt = []

    def seen(df, path, keys, months, order, rebalance=True):
        dealt.append(rebalance)
        replace_partitions(df, path, keys, months, order, rebalance)

    monkeypatch.setattr(incremental, "replace_partitions", seen)
    wh = _scattered_month(spark, f"{tmp_path}/bronze")
    raw = wh.bronze[YELLOW].drop("service_type")
    raw.write.partitionBy("year", "month").parquet(f"{tmp_path}/landing")
    changes = incremental.stream_silver(incremental.stream_feed(spark, f"{tmp_path}/landing", raw.schema, YELLOW), YELLOW)
    incremental.rebuild_touched_months(changes, f"{tmp_path}/out", f"{tmp_path}/state", lambda months: wh.silver_plan).awaitTermination()
    assert dealt == [True] and spark.read.parquet(f"{tmp_path}/out").count() == 60_000


def test_month_folders_land_as_they_lie(spark, tmp_path):
    """Eight files of a month stay eight, as no shuffle brings them together; months beyond the open folders land too."""
    raw = _scattered_month(spark, f"{tmp_path}/bronze").bronze[YELLOW].drop("service_type")
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    assert land_feed(raw, f"{tmp_path}/landing", YELLOW, rebalance=False) == 60_000
    assert _files_and_rows(spark.read.parquet(feed_folder(f"{tmp_path}/landing", YELLOW))) == (8, 60_000)
    many = raw.withColumn("month", (F.col("PULocationID") * 20 + F.col("DOLocationID")).cast("int"))
    assert land_feed(many, f"{tmp_path}/many", YELLOW, rebalance=False) == 60_000
    got = {r[0]: r[1] for r in spark.read.parquet(feed_folder(f"{tmp_path}/many", YELLOW)).groupBy("month").count().collect()}
    assert got == {r[0]: r[1] for r in many.groupBy("month").count().collect()} and len(got) > 32
    assert spark.conf.get(name) == before


def test_streams_land_without_a_shuffle(spark, tmp_path, monkeypatch):
    dealt = []
    monkeypatch.setattr(registered_control, "land_feed", lambda *args, rebalance=True: dealt.append(rebalance))
    registered_control._land(_scattered_month(spark, f"{tmp_path}/bronze"), f"{tmp_path}/landing", F.lit(True))
    assert dealt == [False, False]


def test_names_are_made_distinct_before_they_meet(spark):
    models = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "name string")
    listed = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "name string")
    found = name_differences(models, listed)
    got = sorted((str(r.name), r.missing_from) for r in found.collect())
    assert got == [("None", "catalog"), ("None", "models"), ("a", "catalog"), ("c", "models")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 4
