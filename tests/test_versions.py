"""Versioned tables: a reader meets the old or the new months, whatever a writer does; scans by registered schema."""

import pytest
from pyspark.sql import functions as F

from fareloom.sources.feeds import YELLOW, feed_folder, register, register_months, scan_feed
from fareloom.sources.sinks import land_feed
from fareloom.sources.versions import VersionedTable, schema_groups
from tests.test_feeds_and_silver import FEED, trip

KEYS = ("y", "m")


def months(spark, *rows):
    return spark.createDataFrame(rows, "y int, m int, v string")


def rows_of(table):
    found = table.read()
    return [] if found is None else sorted(map(tuple, found.select("y", "m", "v").collect()))


def test_commit_replaces_months_in_one_step(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", KEYS)
    assert table.read() is None and table.versions() == []
    table.commit(months(spark, (2024, 1, "a"), (2024, 2, "b"), (2024, 3, "c")))
    before = table.read()
    full = table.commit(months(spark, (2024, 2, "new")), [("2024", "1"), ("2024", "2")])
    assert full == [("2024", "2")] and rows_of(table) == [(2024, 2, "new"), (2024, 3, "c")]
    assert sorted(r.v for r in before.collect()) == ["a", "b", "c"]  # a reader of the old version keeps its files
    assert sorted(table.values()) == [("2024", "2"), ("2024", "3")]
    assert table.vacuum() == 0 and rows_of(table) == [(2024, 2, "new"), (2024, 3, "c")]
    table.commit(months(spark, (2025, 1, "d")))
    assert table.vacuum() == 2 and rows_of(table) == [(2025, 1, "d")] and len(table.versions()) == 1
    table.commit(months(spark), [("2025", "1")])
    assert table.read() is None and rows_of(table) == []


def test_a_failed_commit_is_not_seen(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", KEYS)
    table.commit(months(spark, (2024, 1, "a"), (2024, 2, "b")))
    bad = months(spark, (2024, 1, "x"), (2024, 2, "y")).withColumn("v", F.when(F.col("m") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        table.commit(bad, [("2024", "1"), ("2024", "2")])
    assert rows_of(table) == [(2024, 1, "a"), (2024, 2, "b")]
    (tmp_path / "t" / "versions" / "version=2").mkdir()  # a list without its mark
    assert table.versions() == [1] and len(rows_of(table)) == 2


def test_of_two_writers_one_fails(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", KEYS)
    known = table.versions()
    table.replace_list([("y=1/m=1", "c", "{}")], known)
    with pytest.raises(Exception, match="already exists"):
        table.replace_list([], known)


def test_schemas_of_partitions_may_differ_and_only_wanted_months_are_read(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", KEYS)
    table.commit(months(spark, (2024, 1, "1")))
    wider = months(spark, (2024, 2, "2")).select("y", "m", F.col("v").cast("int"), F.lit(0.5).alias("extra"))
    table.commit(wider, [])
    found = table.read(lambda df: df.withColumn("v", F.col("v").cast("string")))
    assert sorted((r.m, r.v, r.extra) for r in found.collect()) == [(1, "1", None), (2, "2", 0.5)]
    plan = found.where("m = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    whole = VersionedTable(spark, f"{tmp_path}/dim")
    whole.commit(spark.range(3))
    whole.commit(spark.range(2))
    assert whole.read().count() == 2


def test_few_jobs_find_the_schemas_of_many_months(spark, tmp_path):
    base = str(tmp_path)
    for m in range(1, 13):
        kind = "int" if m < 6 else "double"
        spark.range(1).select(F.col("id").cast(kind).alias("code")).write.parquet(f"{base}/year=2024/month={m:02}")
    folders = [f"{base}/year=2024/month={m:02}" for m in range(1, 13)]
    groups = schema_groups(spark, base, folders)
    assert sorted(len(paths) for _, paths in groups) == [5, 7]


def test_a_half_landed_month_is_landed_again(spark, tmp_path):
    root = str(tmp_path)
    assert land_feed(spark.createDataFrame([trip()], FEED), root, YELLOW) == 1
    left = spark.createDataFrame([trip(month=2)], FEED).drop("year", "month")
    left.write.parquet(f"{feed_folder(root, YELLOW)}/year=2024/month=2")
    assert scan_feed(spark, root, YELLOW).count() == 1  # what no landing has finished is not there
    both = spark.createDataFrame([trip(), trip(month=2), trip(month=2)], FEED)
    assert land_feed(both, root, YELLOW) == 2 and scan_feed(spark, root, YELLOW).count() == 3
    assert land_feed(both, root, YELLOW) == 0 and scan_feed(spark, root, YELLOW).count() == 3


def test_months_of_others_are_entered_once_and_scanned_with_their_types(spark, tmp_path):
    root, base = str(tmp_path), feed_folder(str(tmp_path), YELLOW)
    first = spark.createDataFrame([trip()], FEED).drop("year", "month")
    first.withColumn("fee", F.lit(1)).write.parquet(f"{base}/year=2024/month=01")
    second = first.withColumns({"VendorID": F.lit(2.0), "fee": F.lit(1.5)})
    second.write.parquet(f"{base}/year=2024/month=02")
    assert register_months(spark, root, YELLOW) == 2 and register_months(spark, root, YELLOW) == 0
    rows = {r.month: r for r in scan_feed(spark, root, YELLOW).collect()}
    assert rows[1].fee == 1.0 and rows[2].fee == 1.5 and rows[2].VendorID == "2"
    assert len(register(spark, root, YELLOW).versions()) == 1
    assert land_feed(spark.createDataFrame([trip(), trip(month=3)], FEED), root, YELLOW) == 1
