"""Registered queries over quality checks, logs, questions, files, comparisons and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.dates import DateWindow, in_months
from fareloom.functions.numbers import exact_sum
from fareloom.functions.text import fold_text, key_part, run_document_key
from fareloom.operators import compare, ingest, matching, metrics, quality, typing
from fareloom.operators.gold import gold_anomaly_rows
from fareloom.operators.silver import silver_trips
from fareloom.plans import queries as q
from fareloom.plans.catalog import gold_catalog
from fareloom.plans.governed import Filter, Join, Metric, Request, governed_query, plan_request
from fareloom.plans.policy import policy_scan
from fareloom.plans.routing import route_questions
from fareloom.plans.warehouse import Warehouse, warehouse
from fareloom.operators.rescoring import rescore
from fareloom.sources import derived_logs as logs
from fareloom.sources import tables
from fareloom.sources.documents import read_audit_log
from fareloom.sources.feeds import FEEDS, MONTH_KEYS, feed_folder, scan_feed, unify_feeds
from fareloom.sources.sinks import append_audit, land_feed
from fareloom.streaming import incremental
from fareloom.workspace import open_folders, scratch_path

H1 = DateWindow.first_half(1998)
Query = Callable[[SparkSession, str], DataFrame]


def over(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(warehouse(spark, sf_dir))


def checked_tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {**wh.gold_tables(), "zone_lookup": wh.dim_zone, "silver_trips": wh.silver}


def faulty_tables(wh: Warehouse) -> dict[str, DataFrame]:
    """The tables with faults that each kind of check must find."""
    vendors, code = wh.dim_vendor, F.col("payment_type")
    dates = wh.dim_date.where(F.dayofmonth("pickup_date") != 31)
    fares, zones = F.col("total_fare_amount"), wh.dim_zone.where(F.col("zone_id") % 7 != 3)
    return {
        **checked_tables(wh),
        "dim_zone": zones,
        "zone_lookup": zones,
        "dim_date": dates.withColumn("month", F.when(F.col("month") == 12, 13).otherwise(F.col("month"))),
        "dim_vendor": vendors.unionByName(vendors.where(F.col("vendor_id") == "1")),
        "dim_payment_type": wh.dim_payment_type.withColumn("payment_type", F.nullif(code, F.lit("2"))),
        "gold_daily_kpis": wh.gold_daily_kpis.withColumn("total_fare_amount", F.when(F.col("trip_count") % 3 == 0, -fares).otherwise(fares)),
    }


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(checked_tables(warehouse(spark, sf_dir)))


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.layer_results(_report(spark, sf_dir))


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = quality.quality_gate(logs.ingestion_results(spark, sf_dir), _stages(spark, sf_dir))
    return gate.select("status", "dbt_counts.*", F.size("blocking_ingestion_statuses").cast("long").alias("blocking"))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = quality.run_summary(
        logs.ingestion_results(spark, sf_dir), _stages(spark, sf_dir), job="monthly", run_id="run-1",
        run_mode="scheduled", logical_date="1998-09-01", created_at_utc="1998-09-01T00:00:00+00:00",
    )
    status = F.col("quality_gate.status")
    return doc.select(
        "dag_id",
        F.array_join("target_months", ",").alias("months"),
        F.size("ingestion_results").cast("long").alias("files"),
        F.size("dbt_results").alias("stages"),
        F.when(status == quality.FAILED_BLOCKING, status).otherwise("other").alias("gate_status"),
    )


def _document_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = logs.run_documents(spark, sf_dir)
    run_id = F.concat(F.lit("run-"), F.col("event_id").cast("string"))
    checked = quality.validate_summaries(docs, "doc", run_id, F.lit("monthly"))
    listed = checked.select(F.explode_outer("failures").alias("failure")).where(F.col("failure").isNotNull())
    return listed.groupBy("failure").agg(F.count("*").alias("documents"))


def quality_queries() -> dict[str, Query]:
    return {
        "quality_report": _report,
        "quality_report_planted": over(lambda w: quality.quality_report(faulty_tables(w))),
        "gold_anomaly_rows_planted": over(lambda w: gold_anomaly_rows(faulty_tables(w)["gold_daily_kpis"])),
        "layer_outcomes": lambda s, d: _stages(s, d).select("layer", "counts.*", "status"),
        "quality_gate": _gate,
        "run_summary": _summary,
        "blocking_results": lambda s, d: quality.blocking_results(logs.ingestion_results(s, d)),
        "orphan_keys": lambda s, d: quality.orphan_keys(
            tables.read_table(s, d, "customer"), "c_custkey", tables.read_table(s, d, "orders"), "o_custkey"
        ),
        "duplicate_keys": lambda s, d: quality.duplicate_keys(tables.read_table(s, d, "orders"), "o_custkey"),
        "duplicate_text_rows": lambda s, d: quality.rows_with_duplicate_keys(
            tables.read_table(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_key")), ["text_key"]
        ).select("doc_id", "key_rows"),
        "result_warnings": over(
            lambda w: quality.result_warnings(H1.over(w.gold_daily_kpis), 100, ("service_type", "month"))
        ),
        "run_document_failures": _document_failures,
    }


def _case_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = compare.evaluate_cases(*logs.evaluation_log(spark, sf_dir))
    return evaluated.select(
        "case_id", "category", F.size("failures").alias("failures"), "status", "trace_complete", "grounded_answer"
    )


def _audit_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "audit")
    append_audit(logs.audited_requests(spark, sf_dir), path)
    return read_audit_log(spark, path).groupBy("status").agg(
        F.count("*").alias("events"),
        F.sum("execution_ms").alias("execution_ms"),
        F.count_if("has_sql_override").alias("overridden"),
        F.count_if(F.array_contains("warnings", "slow")).alias("warned"),
        F.count_if(F.col("error_type") == "timeout").alias("timeouts"),
    )


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_scan(logs.query_log(spark, sf_dir), "sql", gold_catalog())


def metric_queries() -> dict[str, Query]:
    log = logs.request_log
    return {
        "status_counts": lambda s, d: quality.status_counts(log(s, d), "status", ("team",)),
        "pass_rates": lambda s, d: metrics.pass_rates(log(s, d), "surface", F.col("fast")),
        "latency_percentiles": lambda s, d: metrics.latency_percentiles(log(s, d), "whole_ms", ["surface"]),
        "latency_percentiles_overall": lambda s, d: metrics.latency_percentiles(log(s, d), "whole_ms"),
        "latency_summary": lambda s, d: metrics.latency_summary(log(s, d), "elapsed_ms", ["surface"]),
        "throughput": lambda s, d: metrics.throughput(log(s, d), "level", "started_at", "elapsed_ms"),
        "accuracy_by_surface": lambda s, d: metrics.accuracy_by(log(s, d), "surface", F.col("fast")),
        "source_mix": lambda s, d: metrics.source_mix(log(s, d), "source"),
        "policy_scan": lambda s, d: _scanned(s, d).select("event_id", "category", "should_block", "blocked"),
        "block_rates": lambda s, d: metrics.block_rates(_scanned(s, d)),
        "block_reasons": lambda s, d: metrics.reason_histogram(
            _scanned(s, d).select(F.explode_outer("reasons").alias("reason"), "sql").where("reason is not null"), "reason", "sql"
        ),
        "case_evaluation": _case_evaluation,
        "audit_round_trip": _audit_round_trip,
    }


def _routed(df: DataFrame) -> DataFrame:
    out = route_questions(df, "text", gold_catalog())
    return out.select(
        "id", F.md5("normalized").alias("normalized_md5"), "needs_clarification", "metric", "year", "month", "half",
        "service_type", "top_n", "intent", "surface", F.array_join("tables", ",").alias("tables"),
        F.array_join("expected_groupings", ",").alias("expected_groupings"), "date_from", "date_to",
    )


def _object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, sf_dir, "pages").select(
        "page_id",
        key_part(F.col("url")).alias("url_key"),
        run_document_key(F.lit("monthly"), F.col("url"), F.col("url")).alias("document_key"),
    )


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    result = tables.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), day.cast("string").alias("o_orderdate"),
        "o_orderpriority", F.month(day).cast("string").alias("month"), F.to_date(day).cast("string").alias("year_month"),
    )
    return typing.column_kinds(result)


def text_queries() -> dict[str, Query]:
    return {
        "route_questions": lambda s, d: _routed(
            logs.question_log(s, d).select(F.col("o_orderkey").alias("id"), F.col("question").alias("text"))
        ),
        "route_conversations": lambda s, d: _routed(
            tables.read_table(s, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
        ),
        "folded_texts": lambda s, d: tables.read_table(s, d, "documents").select(
            "doc_id", F.md5(fold_text(F.col("text"))).alias("folded_md5")
        ),
        "object_keys": _object_keys,
        "column_kinds": _kinds,
    }


def _new_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = logs.file_manifest(spark, sf_dir)
    stored, _ = logs.stored_and_fetched(manifest)
    return ingest.new_work(manifest, stored).select("bronze_object_key", "source_url")


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    noted = ingest.object_metadata(logs.ingestion_results(spark, sf_dir), "1998-09-01T00:00:00+00:00")
    keys = F.array_join(F.sort_array(F.map_keys("metadata")), ",").alias("keys")
    return noted.select("bronze_object_key", keys)


def _previous_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc(F.to_date("o_orderdate"), "month").alias("run_month")
    runs = tables.read_table(spark, sf_dir, "orders").select(month).distinct()
    return ingest.target_month_starts(runs, "run_month", 3)


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ingest.fingerprints(docs, "text").drop("text")


def ingest_queries() -> dict[str, Query]:
    return {
        "trip_manifest": logs.file_manifest,
        "classified_files": lambda s, d: logs.ingestion_results(s, d).drop("line_count", "local_relative_path"),
        "new_work": _new_work,
        "object_metadata": _metadata,
        "target_months": lambda s, d: logs.ingestion_results(s, d)
        .groupBy("service_type")
        .agg(F.array_join(quality.target_months(F.col("year"), F.col("month")), ",").alias("months")),
        "previous_months": _previous_months,
        "document_fingerprints": _fingerprints,
    }


def _difference(wh: Warehouse) -> DataFrame:
    columns = ["pickup_zone_id", "passenger_count"]
    services = [wh.fact_trips.where(F.col("service_type") == f.service_type).select(*columns) for f in FEEDS]
    return compare.table_difference(*services)


def _compare(wh: Warehouse) -> DataFrame:
    mart = q.pickup_borough_demand(wh, H1)
    request = plan_request(gold_catalog(), ("pickup.borough",), ("trip_count", "total_amount"), roles=("pickup", "dropoff"), window=H1)
    return matching.compare_results(governed_query(wh.table, gold_catalog(), request), mart)


def _ordered(wh: Warehouse) -> DataFrame:
    """The daily mart in order against the same days summed from the fact, first with noise and then in another order."""
    keys = ["pickup_date", "service_type"]
    mart = wh.table("gold_daily_kpis").select(*keys, "trip_count", "total_fare_amount").orderBy(*keys)
    totals = wh.fact_trips.groupBy(*keys).agg(F.count("*").alias("n"), exact_sum(F.col("fare_amount")).alias("total"))
    noisy = totals.select((F.col("total") * (1 + 1e-8)).alias("total"), "n", *keys)
    right = matching.compare_results(noisy.orderBy(*keys), mart, ordered=True)
    wrong = matching.compare_results(noisy.orderBy(F.desc("pickup_date"), "service_type"), mart, ordered=True)
    return right.withColumn("case", F.lit("same order")).union(wrong.withColumn("case", F.lit("latest first")))


def _exact(wh: Warehouse) -> DataFrame:
    """Zone and passenger pairs of the fact against themselves, and against their distinct pairs."""
    pairs = wh.fact_trips.select("pickup_zone_id", "passenger_count")
    same = matching.results_identical(pairs, wh.silver.select(*pairs.columns)).withColumn("case", F.lit("same rows"))
    return same.union(matching.results_identical(pairs.distinct(), pairs).withColumn("case", F.lit("distinct rows")))


def compare_queries() -> dict[str, Query]:
    return {
        "tables_equal": over(lambda w: compare.tables_equal(w.silver_plan, w.silver)),
        "table_difference": over(_difference),
        "compare_results": over(_compare),
        "compare_ordered": over(_ordered),
        "compare_exact": over(_exact),
        "rescore": lambda s, d: rescore(logs.saved_results(s, d)).select("o_custkey", "rescored", "flipped"),
    }


def _ask(dimensions, metric_names, filters=(), roles=("pickup",), **bounds) -> Query:
    catalog = gold_catalog()
    request = plan_request(catalog, dimensions, metric_names, filters, roles, window=H1, **bounds)
    return over(lambda w: governed_query(w.table, catalog, request))


def _distinct_zones(wh: Warehouse) -> DataFrame:
    request = Request(
        "fact_trips",
        ("p.payment_type_name",),
        (Metric("zones", "count_distinct", "pickup_zone_id"), Metric("dearest", "max", "total_amount")),
        joins=(Join("dim_payment_type", "payment_type", "payment_type", "p"),),
        window=H1,
    )
    return governed_query(wh.table, gold_catalog(), request)


def _daily_rows(wh: Warehouse) -> DataFrame:
    request = Request(
        "gold_daily_kpis", ("*",), filters=(Filter("service_type", "=", "green_taxi"),), order_by=("pickup_date",),
        max_rows=1000, window=H1,
    )
    return governed_query(wh.table, gold_catalog(), request)


def governed_queries() -> dict[str, Query]:
    return {
        "governed_zone_ranking": _ask(
            ("zone_name", "borough"), ("trip_count", "total_amount"), (Filter("service_type", "=", "yellow_taxi"),),
            order_by=("-trip_count",), top_n=10,
        ),
        "governed_borough_pairs": _ask(
            ("pickup.borough", "dropoff.borough"), ("trip_count", "total_amount"), roles=("pickup", "dropoff"),
            order_by=("-trip_count", "-total_amount"), top_n=12,
        ),
        "governed_vendor_months": _ask(("year_month", "vendor_name"), ("trip_count", "avg_trip_distance"), max_rows=1000),
        "governed_airport_total": _ask(
            (), ("trip_count", "total_amount"), (Filter("pickup.service_zone", "=", "Airports"),), roles=("pickup", "dropoff")
        ),
        "governed_distinct_zones": over(_distinct_zones),
        "governed_daily_rows": over(_daily_rows),
    }


def _land(wh: Warehouse, root: str, rows: Column) -> None:
    """Land some months of bronze, which lies in month folders, as they lie."""
    for spec in FEEDS:
        land_feed(wh.bronze[spec].drop("service_type").where(rows), root, spec, rebalance=False)


def _update_kpis(wh: Warehouse, root: str, out: str, state: str, **bounds) -> None:
    """One run of the stream over what has landed since the checkpoint was left."""
    schemas = {spec: wh.bronze[spec].drop("service_type").schema for spec in FEEDS}
    silver = incremental.stream_silver_feeds(wh.spark, root, schemas, bounds.get("files_per_batch"))
    incremental.write_updates(incremental.stream_daily_kpis(silver, bounds.get("delay")), out, state).awaitTermination()


def _streaming_kpis(wh: Warehouse) -> DataFrame:
    """Three landings of some years each, in batches of a few files; the stream is started anew after each landing."""
    root, out, state = (scratch_path(wh.spark, name) for name in ("kpi_landing", "kpi_updates", "kpi_state"))
    for last in (1996, 1998, 9999):
        _land(wh, root, F.col("year") <= last)
        _update_kpis(wh, root, out, state, files_per_batch=20)
    return incremental.read_updates(wh.spark, out)


def _closed_days(wh: Warehouse) -> DataFrame:
    """Days close 30 days after the latest one: of trips that arrive a second time, only those of open days count."""
    root, out, state = (scratch_path(wh.spark, name) for name in ("kpi_landing", "kpi_updates", "kpi_state"))
    for last in (1998, 9999):
        _land(wh, root, F.col("year") <= last)
        _update_kpis(wh, root, out, state, delay="30 days")
    for spec in FEEDS:
        late = wh.bronze[spec].drop("service_type").where("passenger_count = 1")
        with open_folders(wh.spark):
            late.write.mode("append").partitionBy(*MONTH_KEYS).parquet(feed_folder(root, spec))
    _update_kpis(wh, root, out, state, delay="30 days")
    return incremental.read_updates(wh.spark, out)


def _streaming_silver(wh: Warehouse) -> DataFrame:
    """Land half the months of each feed, then all; after each landing a stream rebuilds the silver months it touches."""
    spark = wh.spark
    root, out = scratch_path(spark, "landing"), scratch_path(spark, "silver_incremental")
    both = None
    for spec in FEEDS:
        raw = wh.bronze[spec].drop("service_type")
        state, target = scratch_path(spark, f"state_{spec.dataset}"), f"{out}/{spec.dataset}"

        def rebuild(months, spec=spec):
            return silver_trips(unify_feeds({spec: scan_feed(spark, root, spec)})).where(in_months(months))

        for last in (6, 12):
            land_feed(raw.where(F.col("month") <= last), root, spec)
            changes = incremental.stream_silver(incremental.stream_feed(spark, feed_folder(root, spec), raw.schema, spec), spec)
            incremental.rebuild_touched_months(changes, target, state, rebuild).awaitTermination()
        part = spark.read.schema(wh.silver.schema).parquet(target)
        both = part if both is None else both.unionByName(part)
    return q.star_rollup(both, [q.TRIPS, q.REVENUE], (), ["source_year", "source_month", "service_type"])


def stream_queries() -> dict[str, Query]:
    return {
        "streaming_daily_kpis": over(_streaming_kpis),
        "streaming_closed_days": over(_closed_days),
        "streaming_silver_months": over(_streaming_silver),
    }


def all_queries() -> dict[str, Query]:
    return {
        **quality_queries(),
        **metric_queries(),
        **text_queries(),
        **ingest_queries(),
        **compare_queries(),
        **governed_queries(),
        **stream_queries(),
    }
