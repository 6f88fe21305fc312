"""Registered queries over files and tables that are written from the given ones and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.dates import DateWindow, year_month
from fareloom.operators import compare, ingest, quality
from fareloom.plans import queries as q
from fareloom.plans.catalog import name_differences
from fareloom.plans.warehouse import Warehouse, warehouse
from fareloom.sources import derived_logs as logs
from fareloom.sources import sinks
from fareloom.sources.documents import latest_documents, read_run_documents
from fareloom.sources.feeds import FEEDS, scan_zone_csv
from fareloom.workspace import materialize, scratch_path
from registered_control import checked_tables

H1 = DateWindow.first_half(1998)
Query = Callable[[SparkSession, str], DataFrame]


def _over(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(warehouse(spark, sf_dir))


def _month_files(wh: Warehouse) -> str:
    """A folder with one text file for each service and month of the daily mart: a line for each day, in order."""
    days = wh.gold_daily_kpis.withColumns({"year": F.year("pickup_date"), "month": F.month("pickup_date")})
    line = F.concat_ws(",", F.col("pickup_date").cast("string"), F.col("trip_count").cast("string"))
    # at most 31 lines in a group
    files = days.groupBy("service_type", "year", "month").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("value"))
    root = scratch_path(wh.spark, "month_files")
    files.repartition("service_type", "year", "month").write.partitionBy("service_type", "year", "month").text(root)
    return root


def _folder(path: str) -> list:
    """Service, year and month in a file's path."""
    found = F.regexp_extract(path, r"service_type=([a-z_]+)/year=", 1)
    number = [F.regexp_extract(path, rf"/{part}=([0-9]+)/", 1).cast("int").alias(part) for part in ("year", "month")]
    return [found.alias("service_type"), *number]


def _fingerprints(whole_up_to: int = ingest.WHOLE_UP_TO) -> Query:
    def build(wh: Warehouse) -> DataFrame:
        prints = ingest.file_fingerprints(wh.spark, _month_files(wh), whole_up_to)
        return prints.select(*_folder("path"), "file_size_bytes", "sha256", "accepted")

    return _over(build)


def _object_listing(wh: Warehouse) -> DataFrame:
    """The month files beside metadata that was stored for those of even months only."""
    root = _month_files(wh)
    prints = ingest.file_fingerprints(wh.spark, root)
    key = F.substring_index("path", root.rstrip("/") + "/", -1)
    stored = prints.where(_folder("path")[2] % 2 == 0).select(
        key.alias("bronze_object_key"), F.create_map(F.lit("sha256"), F.col("sha256")).alias("metadata")
    )
    listed = ingest.object_listing(wh.spark, root, stored)
    return listed.select(*_folder("bronze_object_key"), "content_length", F.col("metadata")["sha256"].alias("stored_sha256"), "exists")


def _serving_tables(wh: Warehouse) -> DataFrame:
    """Three tables served for one year and then for the first half of another, read by name."""
    root = scratch_path(wh.spark, "serving")
    database = "serving_" + root.rstrip("/").split("/")[-2]
    for window in (DateWindow.first_half(1996), H1):
        sinks.serve_tables(
            wh.spark,
            {
                "daily_kpis": window.over(wh.gold_daily_kpis),
                "zone_demand": window.over(wh.gold_zone_demand),
                "payment_summary": q.payment_summary_serving(wh, window),
            },
            database,
            root,
        )
    return wh.spark.sql(
        f"""select 'daily_kpis' as table_name, service_type as label, count(*) as row_count, sum(trip_count) as trips,
                max(total_fare_amount) as largest from {database}.daily_kpis group by service_type
            union all select 'zone_demand', borough, count(*), sum(trip_count), max(total_amount) from {database}.zone_demand group by borough
            union all select 'payment_summary', payment_type, count(*), sum(trips), max(revenue) from {database}.payment_summary
                group by payment_type"""
    )


def _gold_views(wh: Warehouse) -> DataFrame:
    """A question in SQL over the names of the gold tables."""
    wh.register_views()
    return wh.spark.sql(
        """select s.service_type_name, v.vendor_name, z.borough, d.year, count(*) as trips, max(f.total_amount) as dearest
           from fact_trips f join dim_service_type s on f.service_type = s.service_type join dim_vendor v on f.vendor_id = v.vendor_id
           join dim_zone z on f.pickup_zone_id = z.zone_id join dim_date d on f.pickup_date = d.pickup_date
           group by s.service_type_name, v.vendor_name, z.borough, d.year"""
    )


def _exported(wh: Warehouse) -> DataFrame:
    """The daily mart of half a year exported, read back from both formats beside the number of rows reported."""
    root, result = scratch_path(wh.spark, "exports"), H1.over(wh.gold_daily_kpis)
    rows = sinks.export(result, root, "daily_kpis")
    kinds = {
        "parquet": wh.spark.read.parquet(f"{root}/daily_kpis.parquet"),
        "csv": wh.spark.read.schema(result.schema).option("header", True).csv(f"{root}/daily_kpis.csv"),
    }
    parts = [frame.select(F.lit(kind).alias("format"), F.lit(rows).cast("long").alias("reported_rows"), "*") for kind, frame in kinds.items()]
    return parts[0].unionByName(parts[1])


def _zones_from_csv(wh: Warehouse) -> DataFrame:
    path = f"{scratch_path(wh.spark, 'lookup')}/taxi_zone_lookup.csv"
    columns = {"zone_id": "LocationID", "borough": "Borough", "zone_name": "Zone", "service_zone": "service_zone"}
    sinks.write_csv(wh.zones.select(*[F.col(c).alias(name) for c, name in columns.items()]), path)
    return scan_zone_csv(wh.spark, path)


def _latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run documents written one after another, one run under two dates; the newest of each run."""
    root = scratch_path(spark, "runs")
    ingestion = logs.ingestion_results(spark, sf_dir)
    stages = materialize(quality.layer_results(quality.quality_report(checked_tables(warehouse(spark, sf_dir)))), "stages", rebalance=False)
    for run_id, day in (("run-1", "1998-08-01"), ("run-2", "1998-08-15"), ("run-1", "1998-09-01")):
        named = dict(job="monthly", run_id=run_id, run_mode="scheduled", logical_date=day, created_at_utc=f"{day}T00:00:00+00:00")
        sinks.write_run_document(quality.run_summary(ingestion, stages, **named), root)
    newest = latest_documents(read_run_documents(spark, root, "monthly"), F.get_json_object("doc", "$.run_id"))
    counted = [F.get_json_object("doc", f"$.quality_gate.dbt_counts.{name}").cast("long").alias(name) for name in ("pass", "warn", "error")]
    files = F.from_json(F.get_json_object("doc", "$.ingestion_results"), "array<struct<bronze_object_key:string,status:string>>")
    listed = F.array_sort(F.transform(files, lambda f: F.concat_ws(" ", f["bronze_object_key"], f["status"])))
    return newest.select(
        F.col("key").alias("run_id"), F.get_json_object("doc", "$.logical_date").alias("logical_date"),
        F.get_json_object("doc", "$.quality_gate.status").alias("gate_status"), *counted,
        F.sha2(F.array_join(listed, "\n"), 256).alias("files_sha256"),
    )


def _month_differences(wh: Warehouse) -> DataFrame:
    """Months that only one of the two feeds has."""
    names = [wh.bronze[spec].select(year_month(F.make_date("year", "month", F.lit(1))).alias("name")) for spec in FEEDS]
    return name_differences(*names)


def _verified(wh: Warehouse) -> DataFrame:
    named = {
        "daily_kpis": lambda: H1.over(wh.gold_daily_kpis),
        "negative_fares": lambda: wh.silver.where("fare_amount < 0"),
        "unknown_table": lambda: wh.spark.table("no_such_table"),
    }
    return compare.verify_queries(wh.spark, named).select("query", "outcome", F.col("reason").isNotNull().alias("explained"))


def all_queries() -> dict[str, Query]:
    return {
        "file_fingerprints": _fingerprints(),
        "file_fingerprints_chunked": _fingerprints(whole_up_to=400),
        "object_listing": _over(_object_listing),
        "serving_tables": _over(_serving_tables),
        "gold_views": _over(_gold_views),
        "exported_daily_kpis": _over(_exported),
        "zones_from_csv": _over(_zones_from_csv),
        "latest_run_documents": _latest_runs,
        "month_differences": _over(_month_differences),
        "verified_queries": _over(_verified),
    }
