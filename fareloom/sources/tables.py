"""Trip feeds derived from the order tables, for running the models on general test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.sources.feeds import GREEN, YELLOW, FeedSpec
from fareloom.workspace import materialize


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per order line, with a feed tag and the month its file would be named after.

    Orders meet customers first: that join moves a quarter of the rows the line items have, so the
    line items are shuffled once per key and never with the customer columns. No side is
    broadcast by hand; Spark does so below its size threshold and otherwise splits hot keys.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.col("o_orderdate").alias("dropoff_at"),
        F.when(~F.col("o_orderpriority").startswith("4"), F.substring("o_orderpriority", 1, 1)).alias("payment_type"),
    )
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dropoff_zone_id")
    )
    suppliers = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("pickup_zone_id")
    )
    shipped = F.col("l_shipdate")
    filed = F.when(F.col("l_orderkey") % 50 == 0, F.add_months(shipped, -1)).otherwise(F.to_date(shipped))
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return (
        lines.join(orders.join(customers, "o_custkey"), "l_orderkey")
        .join(suppliers, "l_suppkey")
        .select(
            F.when(F.col("l_linestatus") == "F", YELLOW.service_type).otherwise(GREEN.service_type).alias("feed"),
            F.year(filed).alias("year"),
            F.month(filed).alias("month"),
            (F.col("l_suppkey") % 4).alias("vendor_id"),
            shipped.alias("pickup_at"),
            "dropoff_at",
            "pickup_zone_id",
            "dropoff_zone_id",
            F.col("l_linenumber").alias("passenger_count"),
            F.col("l_quantity").alias("trip_distance"),
            F.when(F.col("l_orderkey") % 97 == 0, -F.col("l_extendedprice"))
            .otherwise(F.col("l_extendedprice"))
            .alias("fare_amount"),
            amount.alias("total_amount"),
            "payment_type",
        )
    )


TRIP_TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")


def tables_stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of change of the tables, to notice that a folder was written anew."""
    path_type = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    stamp = []
    for name in TRIP_TABLES:
        path = path_type(f"{sf_dir}/{name}.parquet")
        status = path.getFileSystem(conf).getFileStatus(path)
        stamp.append((status.getLen(), status.getModificationTime()))
    return tuple(stamp)


def landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips written once in the landing layout, one directory per feed and month."""
    return materialize(order_trips(spark, sf_dir), "bronze", ("feed", "year", "month"))


def feed_view(landed: DataFrame, spec: FeedSpec) -> DataFrame:
    """The landed rows of one feed under the column names that feed uses."""
    rows = landed.where(F.col("feed") == spec.service_type)
    return rows.select(*[F.col(_landed_name(t)).alias(s) for t, s in spec.source_columns.items()])


def _landed_name(target: str) -> str:
    return {"source_year": "year", "source_month": "month"}.get(target, target)


def zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones from nations and regions."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("zone_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone_name"),
        F.when(F.col("n_nationkey") % 5 == 0, "Airports").otherwise("Boro Zone").alias("service_zone"),
    )
