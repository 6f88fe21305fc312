"""Logs and control tables derived from the given tables, as inputs for the log jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators import ingest
from fareloom.sources.tables import read_table

BASE_URL = "https://example.org/data"


def choose(key: Column, options: list) -> Column:
    """The option at position key modulo the number of options."""
    chosen = None
    for i, option in enumerate(options):
        value = option if isinstance(option, Column) else F.lit(option)
        same = key % len(options) == i
        chosen = F.when(same, value) if chosen is None else chosen.when(same, value)
    return chosen


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timed request per event."""
    kind = F.col("event_type")
    word = (
        F.when(kind == "click", "success").when(kind == "view", "warn").when(kind == "error", "ERROR")
        .when(kind == "purchase", "skipped").otherwise("halted")
    )
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("started_at"),
        F.col("value").alias("elapsed_ms"),
        F.floor("value").cast("int").alias("whole_ms"),
        kind.alias("surface"),
        (F.col("user_id") % 8).cast("int").alias("level"),
        (F.col("user_id") % 10).cast("int").alias("team"),
        word.alias("status"),
        F.nullif(kind, F.lit("error")).alias("source"),
        (F.col("value") < 40).alias("fast"),
    )


# Query texts by category; {v} stands for a number from the event. The last field says whether the
# catalog forbids the text.
QUERY_TEXTS = [
    ("SELECT service_type, SUM(trip_count) AS trips FROM gold_daily_kpis WHERE trip_count > {v} GROUP BY service_type", "safe", False),
    ("DELETE FROM fact_trips WHERE vendor_id = '{v}'", "dml", True),
    ("SELECT * FROM gold_zone_demand WHERE zone_id = {v}", "safe", False),
    ("SELECT * FROM fact_trips LIMIT {v}", "wildcard_detail", True),
    ("SELECT v.vendor_name, COUNT(*) AS trips FROM fact_trips AS f JOIN dim_vendor AS v ON f.vendor_id = v.vendor_id GROUP BY v.vendor_name", "safe", False),
    ("SELECT f.fare_amount FROM fact_trips AS f JOIN dim_zone AS z ON f.fare_amount = z.zone_id WHERE z.zone_id > {v}", "illegal_join", True),
    ("SELECT pickup_date FROM gold_daily_kpis; DROP TABLE fact_trips", "injection", True),
    ("SELECT secret_{v} FROM gold_daily_kpis", "unknown_column", True),
    ("SELECT trip_count FROM gold_zone_demand CROSS JOIN dim_vendor", "cartesian", True),
    ("WITH d AS (SELECT pickup_date, trip_count FROM gold_daily_kpis) SELECT d.pickup_date, d.trip_count FROM d WHERE d.trip_count > {v}", "safe", False),
    ("SELECT borough FROM silver_trips_{v}", "out_of_scope_table", True),
]


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One labelled query text per event."""
    key, number = F.col("event_id"), F.col("user_id").cast("string")

    def option(field: int):
        values = [row[field] for row in QUERY_TEXTS]
        return choose(key, [F.replace(F.lit(v), F.lit("{v}"), number) if field == 0 else v for v in values])

    return read_table(spark, sf_dir, "events").select(
        "event_id", option(0).alias("sql"), option(1).alias("category"), option(2).alias("should_block")
    )


# Question wordings; {y} is a year and {n} a small number from the order.
QUESTIONS = [
    "Monthly trips of Yellow and Green in {y} H1",
    "Average trip distance by service type by month in {y}",
    "Tổng tiền theo tháng của taxi vàng và taxi xanh năm {y}",
    "Top {n} pickup zones by revenue in {y}",
    "Which vendor has the most trips in {y}?",
    "Vendor trend by month in {y} H1",
    "Payment type distribution, thang {n} {y}",
    "Compare pickup and dropoff borough demand in {y}",
    "Pickup borough demand for yellow, first half of {y}",
    "Khu vực nào có nhiều chuyến nhất thang {n} nam {y}",
    "Dropoff borough demand in {y}",
    "Trips by month in {y}",
    "trips {y}",
    "So sánh",
    "What is the weather {n}",
]


def question_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per order."""
    year = F.year("o_orderdate") + 10
    number = (F.col("o_custkey") % 14).cast("string")
    text = choose(F.col("o_orderkey"), QUESTIONS)
    text = F.replace(F.replace(text, F.lit("{y}"), year.cast("string")), F.lit("{n}"), number)
    return read_table(spark, sf_dir, "orders").select("o_orderkey", text.alias("question"))


def shipped_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months in which lines were shipped, with their row counts."""
    month = F.trunc(F.to_date("l_shipdate"), "month").alias("month_start")
    return read_table(spark, sf_dir, "lineitem").groupBy(month).agg(F.count("*").alias("line_count"))


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.trip_manifest(shipped_months(spark, sf_dir), "month_start", BASE_URL)


def stored_and_fetched(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is in storage and what the source answered, by the age of each month.

    Of every six months three are stored (verified, without checksum, with a wrong size), and the
    others answer 404, 200 and 403.
    """
    case = (F.col("year").cast("int") * 12 + F.col("month").cast("int")) % 6
    size = F.col("line_count").cast("string")
    known = F.create_map(F.lit("source_url"), F.col("source_url"))
    stored = manifest.where(case < 3).select(
        "bronze_object_key",
        F.col("line_count").alias("content_length"),
        F.when(case == 0, F.map_concat(known, F.create_map(F.lit("file_size_bytes"), size, F.lit("sha256"), F.sha2("source_url", 256))))
        .when(case == 1, known)
        .otherwise(F.map_concat(known, F.create_map(F.lit("file_size_bytes"), F.concat(F.lit("1"), size))))
        .alias("metadata"),
    )
    fetched = manifest.where(case >= 3).select(
        "source_url",
        F.when(case == 3, 404).when(case == 4, 200).otherwise(403).alias("http_status"),
        F.when(case == 4, F.col("line_count")).alias("file_size_bytes"),
        F.when(case == 4, F.sha2("bronze_object_key", 256)).alias("sha256"),
    )
    return stored, fetched


def ingestion_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = file_manifest(spark, sf_dir)
    stored, fetched = stored_and_fetched(manifest)
    return ingest.classify(manifest, stored, fetched, F.lit("1998-09-01").cast("date"))


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON run document per order line count and event, some of them flawed by rule."""
    key = F.col("event_id")
    status = choose(key, ["uploaded", "skipped_existing_verified", "skipped_source_unavailable_recent"])
    item = F.struct(
        F.when(key % 7 != 0, "yellow").alias("dataset"),
        status.alias("status"),
        F.lit("https://example.org/x").alias("source_url"),
        F.when(key % 5 != 0, F.concat(F.lit("bronze/"), key.cast("string"))).alias("bronze_object_key"),
        F.when(key % 4 != 0, F.sha2(key.cast("string"), 256)).alias("sha256"),
        F.col("user_id").cast("string").alias("file_size_bytes"),
    )
    counts = F.struct(
        F.lit(1).alias("pass"), F.lit(0).alias("warn"), F.when(key % 11 != 0, 0).alias("error"), F.lit(0).alias("skip")
    )
    gate = F.struct(
        F.when(key % 13 == 0, "unsure").otherwise("passed").alias("status"),
        counts.alias("dbt_counts"),
        F.array().cast("array<string>").alias("blocking_ingestion_statuses"),
    )
    doc = F.struct(
        F.lit("1.0").alias("schema_version"),
        F.lit("monthly").alias("dag_id"),
        F.concat(F.lit("run-"), key.cast("string")).alias("run_id"),
        F.when(key % 6 == 0, "replay").otherwise("manual").alias("run_mode"),
        F.when(key % 9 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("2024-01"))).alias("target_months"),
        F.array(item).alias("ingestion_results"),
        F.array(F.struct(F.lit("silver").alias("layer"))).alias("dbt_results"),
        gate.alias("quality_gate"),
        F.when(key % 10 != 0, F.col("ts").cast("string")).alias("created_at_utc"),
    )
    return read_table(spark, sf_dir, "events").select("event_id", F.to_json(doc).alias("doc"))


def saved_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer, the orders by status as an expected result and an answer that may deviate.

    Answers swap the columns, carry rounding noise, add a column, or are wrong, by customer.
    """
    orders = read_table(spark, sf_dir, "orders")
    per_status = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.count("*").alias("n"), F.sum(F.rint(F.col("o_totalprice") * 100).cast("long")).alias("cents")
    )
    case = F.col("o_custkey") % 5
    value = F.col("cents") / 100.0
    noisy = F.when(case == 1, value * F.lit(1.0 + 1e-9)).when(case == 3, value * F.lit(1.001)).otherwise(value)
    gold = F.array(F.col("o_orderstatus"), value.cast("string"))
    agent = F.when(case == 2, F.array(F.col("n").cast("string"), noisy.cast("string"), F.col("o_orderstatus"))).otherwise(
        F.array(noisy.cast("string"), F.col("o_orderstatus"))
    )
    # At most three statuses per customer, so the lists are short.
    packed = per_status.groupBy("o_custkey").agg(
        F.sort_array(F.collect_list(gold)).alias("gold_rows"), F.sort_array(F.collect_list(agent)).alias("agent_rows")
    )
    names = F.when(case == 2, F.lit(["orders", "price", "status"])).otherwise(F.lit(["price", "status"]))
    return packed.select(
        "o_custkey",
        names.alias("agent_cols"),
        F.when(case == 4, F.slice("agent_rows", 1, 1)).otherwise(F.col("agent_rows")).alias("agent_rows"),
        F.lit(["status", "total"]).alias("gold_cols"),
        "gold_rows",
        F.lit("select status, sum(price) from orders group by 1 order by 1").alias("gold_sql"),
        (case != 1).alias("match"),
    )


def evaluation_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One evaluation case and one response per event; the response deviates by rule."""
    key = F.col("event_id")
    events = read_table(spark, sf_dir, "events").select(key.alias("case_id"), "event_type", "value")
    cid = F.col("case_id")
    cases = events.select(
        "case_id",
        F.col("event_type").alias("category"),
        F.lit(200).alias("expected_http"),
        F.lit(None).cast("string").alias("error_contains"),
        F.lit(False).alias("requires_clarification"),
        F.lit("star_schema").alias("expected_surface"),
        F.lit(["fact_trips"]).alias("expected_tables"),
        F.lit(["fact_trips", "1998-01-01"]).alias("sql_contains"),
        F.lit(["Grounding:"]).alias("answer_contains"),
        F.lit(["planning", "execution"]).alias("required_steps"),
    )
    responses = events.select(
        "case_id",
        F.when(cid % 17 == 0, 400).otherwise(200).alias("http_status"),
        F.lit(None).cast("string").alias("detail"),
        (cid % 19 == 0).alias("requires_clarification"),
        F.when(cid % 5 == 0, "aggregate_mart").otherwise("star_schema").alias("surface"),
        F.when(cid % 7 == 0, F.lit(["dim_zone"])).otherwise(F.lit(["dim_zone", "fact_trips"])).alias("selected_tables"),
        F.lit("select 1 from fact_trips where pickup_date >= date '1998-01-01'").alias("sql"),
        F.when(cid % 3 == 0, "no rows").otherwise("Grounding: rows only").alias("answer"),
        F.when(cid % 4 == 0, F.lit(["planning"])).otherwise(F.lit(["planning", "execution"])).alias("steps"),
        F.floor("value").cast("int").alias("elapsed_ms"),
    )
    return cases, responses


def audited_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as an audit writer receives them, one per event."""
    return read_table(spark, sf_dir, "events").select(
        F.col("ts").cast("string").alias("timestamp"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.concat(F.lit("question "), F.col("event_id").cast("string")).alias("question"),
        (F.col("event_id") % 3 == 0).alias("has_sql_override"),
        F.lit(100).alias("requested_max_rows"),
        F.floor("value").cast("long").alias("execution_ms"),
        F.when(F.col("value") > 100, F.array(F.lit("slow"))).alias("warnings"),
        F.when(F.col("event_type") == "error", "timeout").alias("error_type"),
    )
