"""Monthly trip feeds: scan, conform to one schema, unite."""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.numbers import code_text, half_even_int
from fareloom.sources.versions import VersionedTable, schema_groups
from fareloom.workspace import folder_names

# Column order and types of a conformed trip.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("service_type", T.StringType()),
        T.StructField("source_year", T.IntegerType()),
        T.StructField("source_month", T.IntegerType()),
        T.StructField("vendor_id", T.StringType()),
        T.StructField("pickup_at", T.TimestampNTZType()),
        T.StructField("dropoff_at", T.TimestampNTZType()),
        T.StructField("pickup_zone_id", T.IntegerType()),
        T.StructField("dropoff_zone_id", T.IntegerType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("payment_type", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FeedSpec:
    """How one feed names the trip columns."""

    service_type: str
    label: str
    dataset: str
    source_columns: dict[str, str] = field(hash=False)


# The column names the two feeds arrive with, and the service names.
_SHARED_NAMES = {
    "source_year": "year",
    "source_month": "month",
    "vendor_id": "VendorID",
    "pickup_zone_id": "PULocationID",
    "dropoff_zone_id": "DOLocationID",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "total_amount": "total_amount",
    "payment_type": "payment_type",
}
YELLOW = FeedSpec(
    "yellow_taxi",
    "Yellow Taxi",
    "yellow",
    {**_SHARED_NAMES, "pickup_at": "tpep_pickup_datetime", "dropoff_at": "tpep_dropoff_datetime"},
)
GREEN = FeedSpec(
    "green_taxi",
    "Green Taxi",
    "green",
    {**_SHARED_NAMES, "pickup_at": "lpep_pickup_datetime", "dropoff_at": "lpep_dropoff_datetime"},
)
FEEDS = (YELLOW, GREEN)


def bronze_feed(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """The feed as it arrived, with the service tag in front."""
    return raw.select(F.lit(spec.service_type).alias("service_type"), "*")


MONTH_KEYS = ("year", "month")


def feed_folder(root: str, spec: FeedSpec) -> str:
    return f"{root.rstrip('/')}/{spec.service_type}"


def register(spark: SparkSession, root: str, spec: FeedSpec) -> VersionedTable:
    """The list of a feed's landed months with the schema of their files; the files lie in the landing layout."""
    return VersionedTable(spark, f"{root.rstrip('/')}/_register/{spec.service_type}", MONTH_KEYS)


def month_folders(spark: SparkSession, base: str) -> list[str]:
    """Names of the month folders below a feed's folder, such as ``year=2024/month=01``."""
    years = [y for y in folder_names(spark, base) if y.startswith("year=")]
    return sorted(f"{y}/{m}" for y in years for m in folder_names(spark, f"{base}/{y}") if m.startswith("month="))


def _examined(spark: SparkSession, base: str, names: list[str]) -> list[tuple[str, str, str]]:
    """Register entries for folders (or the files of a folder that conflict) that nobody registered."""
    if not names:
        return []
    groups = schema_groups(spark, base, [f"{base}/{name}" for name in names])
    return [(path.split(f"{base}/", 1)[1], "", schema.json()) for schema, paths in groups for path in paths]


def register_months(spark: SparkSession, root: str, spec: FeedSpec) -> int:
    """Enter month folders that something else wrote; returns how many entries were added.

    Only folders that are not in the register are looked at. A later scan reads no footer.
    """
    table = register(spark, root, spec)
    entries = [tuple(e) for e in table.entries()]
    known = {"/".join(e[0].split("/")[:2]) for e in entries}
    base = feed_folder(root, spec)
    fresh = _examined(spark, base, [name for name in month_folders(spark, base) if name not in known])
    if fresh or not table.versions():
        table.replace_list([*entries, *fresh])
    return len(fresh)


def scan_feed(spark: SparkSession, root: str, spec: FeedSpec) -> DataFrame:
    """Read every month of a feed under ``root``, uniting files by column name.

    The source changes types between months, which Parquet schema merging refuses. The months in the feed's register are
    read schema by schema, each once, with the schema that the register holds; a month that is not in it is not there. A
    folder without a register is examined first. ``year`` and ``month`` come from the directory names.
    """
    base, table = feed_folder(root, spec), register(spark, root, spec)
    entries = [tuple(e) for e in table.entries()] if table.versions() else _examined(spark, base, month_folders(spark, base))
    by_schema: dict[str, list[str]] = defaultdict(list)
    for partition, _, schema in entries:
        by_schema[schema].append(f"{base}/{partition}")
    parts = [
        spark.read.schema(T.StructType.fromJson(json.loads(schema))).option("basePath", base).parquet(*paths)
        for schema, paths in by_schema.items()
    ]
    if not parts:
        raise FileNotFoundError(f"no month of {spec.service_type} has landed under {root}")
    common = _common_types(parts, spec)
    merged = None
    for part in parts:
        typed = part.select(*(_cast(F.col(name), kind, common[name]).alias(name) for name, kind in part.dtypes))
        merged = typed if merged is None else merged.unionByName(typed, allowMissingColumns=True)
    return bronze_feed(merged, spec)


def _common_types(parts: list[DataFrame], spec: FeedSpec) -> dict[str, T.DataType]:
    """One type for each column: the models' type for those they read; for others their own, a wider number, or text."""
    found: dict[str, set[T.DataType]] = defaultdict(set)
    for part in parts:
        for item in part.schema.fields:
            found[item.name].add(item.dataType)
    wanted = {source: TRIP_SCHEMA[name].dataType for name, source in spec.source_columns.items()}
    common = {}
    for name, kinds in found.items():
        if name in wanted:
            common[name] = wanted[name]
        elif len(kinds) == 1:
            common[name] = next(iter(kinds))
        elif all(isinstance(kind, T.NumericType) for kind in kinds):
            common[name] = T.LongType() if all(isinstance(kind, T.IntegralType) for kind in kinds) else T.DoubleType()
        else:
            common[name] = T.StringType()
    return common


def _cast(col: Column, type_name: str, target: T.DataType) -> Column:
    if isinstance(target, T.StringType):
        return code_text(col, type_name)
    if isinstance(target, T.IntegerType) and type_name in ("double", "float"):
        return half_even_int(col)
    return col.cast(target)


def conform_feed(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rename and cast the feed's columns to the trip schema; a column the feed lacks is NULL."""
    types = dict(bronze.dtypes)
    columns = [F.col("service_type")]
    for item in TRIP_SCHEMA.fields[1:]:
        source = spec.source_columns[item.name]
        if source in types:
            value = _cast(F.col(source), types[source], item.dataType)
        else:
            value = F.lit(None).cast(item.dataType)
        columns.append(value.alias(item.name))
    return bronze.select(*columns)


def unify_feeds(bronze: dict[FeedSpec, DataFrame]) -> DataFrame:
    """UNION ALL of the conformed feeds."""
    united = None
    for spec, frame in bronze.items():
        part = conform_feed(frame, spec)
        united = part if united is None else united.unionByName(part)
    return united


def service_labels(spark: SparkSession, feeds: tuple[FeedSpec, ...] = FEEDS) -> DataFrame:
    """Inline relation of service codes and names."""
    rows = ", ".join(f"('{f.service_type}', '{f.label}')" for f in feeds)
    return spark.sql(f"select * from values {rows} as v(service_type, service_type_name)")


ZONE_CSV_SCHEMA = "LocationID string, Borough string, Zone string, service_zone string"


def scan_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with the zone lookup, renamed and cast."""
    raw = spark.read.csv(path, header=True, schema=ZONE_CSV_SCHEMA)
    return raw.select(
        F.col("LocationID").cast("int").alias("zone_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )
