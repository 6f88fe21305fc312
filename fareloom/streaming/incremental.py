"""Incremental landing, silver and daily KPIs on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fareloom.functions.dates import in_months
from fareloom.functions.numbers import safe_divide, state_value, sum_state
from fareloom.operators.gold import daily_kpis
from fareloom.operators.silver import silver_trips
from fareloom.sources.feeds import FeedSpec, bronze_feed, conform_feed, feed_folder
from fareloom.workspace import replace_partitions, write_table

MONTH = ("source_year", "source_month")


def stream_feed(spark: SparkSession, path: str, schema: T.StructType, spec: FeedSpec, files_per_batch: int | None = None) -> DataFrame:
    """A feed's landing folder as a stream; a checkpoint makes each file count once.

    ``files_per_batch`` bounds a micro-batch, so that the first run over a large landing is a row of batches of its own size.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return bronze_feed(reader.parquet(path), spec)


def stream_silver(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """The batch cleaning rules on a stream; rows outside their source month are dropped here too."""
    return silver_trips(conform_feed(bronze, spec))


def stream_silver_feeds(spark: SparkSession, root: str, schemas: dict[FeedSpec, T.StructType], files_per_batch: int | None = None) -> DataFrame:
    """Silver of several feeds as one stream over their landing folders."""
    both = None
    for spec, schema in schemas.items():
        part = stream_silver(stream_feed(spark, feed_folder(root, spec), schema, spec, files_per_batch), spec)
        both = part if both is None else both.unionByName(part)
    return both


def rebuild_touched_months(
    changes: DataFrame, path: str, checkpoint: str, rebuild: Callable[[list[tuple[int, int]]], DataFrame]
) -> StreamingQuery:
    """For each micro-batch, rebuild the months it touches and leave all others as they are.

    ``rebuild(months)`` returns the full silver rows of the given source months. Only the list of
    months, a handful of number pairs, reaches the driver; as literals they prune the directories
    to read. Overwriting whole months makes a replayed batch harmless.
    """

    def one_batch(batch: DataFrame, _: int) -> None:
        touched = [(r[0], r[1]) for r in batch.select(*MONTH).distinct().collect()]
        if touched:
            replace_partitions(rebuild(touched), path, MONTH, touched, ("pickup_date",))

    return changes.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_daily_kpis(silver: DataFrame, delay: str | None = None) -> DataFrame:
    """Daily KPIs of a silver stream over one-day windows.

    Without ``delay`` nothing is ever too late, and the state grows by one row per service and day.
    With it, days older than the delay are closed: their state is freed and later rows are ignored.
    The event time is built from the pickup date, so windows are calendar days in any session time
    zone. Sums are kept as exact states, from which ``finish_daily_kpis`` derives the averages.
    """
    timed = silver.withColumn("event_time", F.timestamp_seconds(F.unix_date("pickup_date").cast("long") * 86400))
    if delay is not None:
        timed = timed.withWatermark("event_time", delay)
    grouped = timed.groupBy(F.window("event_time", "1 day"), "service_type")
    counted = grouped.agg(
        F.count("*").alias("trip_count"),
        sum_state(F.col("fare_amount")).alias("fares"),
        sum_state(F.col("trip_distance")).alias("distances"),
        F.count("trip_distance").alias("distance_rows"),
    )
    day = F.date_from_unix_date((F.unix_seconds(F.col("window.start")) / 86400).cast("int"))
    return counted.select("service_type", day.alias("pickup_date"), *counted.columns[2:])


def finish_daily_kpis(states: DataFrame) -> DataFrame:
    return states.select(
        "service_type",
        "pickup_date",
        "trip_count",
        state_value(F.col("fares")).alias("total_fare_amount"),
        safe_divide(state_value(F.col("distances")), F.col("distance_rows")).alias("avg_trip_distance"),
    )


def write_updates(kpis: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the groups each micro-batch changed into a folder of their own.

    A batch that is replayed after a failure overwrites its folder, so nothing is counted twice.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        write_table(batch, f"{path}/batch={number}")

    return (
        kpis.writeStream.outputMode("update")
        .foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of each day and service."""
    states = spark.read.option("basePath", path).parquet(path)
    values = [c for c in states.columns if c not in ("service_type", "pickup_date", "batch")]
    latest = states.groupBy("service_type", "pickup_date").agg(F.max_by(F.struct(*values), "batch").alias("s"))
    return finish_daily_kpis(latest.select("service_type", "pickup_date", "s.*"))


def refresh_daily_kpis(silver: DataFrame, months: list[tuple[int, int]], path: str) -> None:
    """Rewrite the mart's months that changed."""
    kpis = daily_kpis(silver.where(in_months(months)))
    dated = kpis.withColumns({"source_year": F.year("pickup_date"), "source_month": F.month("pickup_date")})
    replace_partitions(dated, path, MONTH, months)
