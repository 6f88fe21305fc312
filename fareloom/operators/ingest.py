"""Ingestion control as table jobs: manifests, fingerprints and status classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.dates import month_index, previous_month_starts
from fareloom.functions.text import pad
from fareloom.sources.feeds import FEEDS, FeedSpec

DEFAULT_GRACE_MONTHS = 3
LOOKUP_DATASET = "taxi_zone_lookup"
LOOKUP_KEY = "reference/taxi_zone_lookup/taxi_zone_lookup.csv"


def target_month_starts(runs: DataFrame, run_date: str, count: int) -> DataFrame:
    """For each run, one row per previous month, oldest first."""
    return runs.withColumn("month_start", F.explode(previous_month_starts(F.col(run_date), count)))


def trip_manifest(months: DataFrame, month_start: str, base_url: str, feeds: tuple[FeedSpec, ...] = FEEDS) -> DataFrame:
    """One row per month and feed: where the file comes from and where it goes."""
    feed = F.array(*[F.struct(F.lit(f.dataset).alias("dataset"), F.lit(f.service_type).alias("service_type")) for f in feeds])
    expanded = months.withColumn("feed", F.explode(feed))
    year, month = pad(F.year(month_start), 4), pad(F.month(month_start), 2)
    name = F.concat(F.col("feed.dataset"), F.lit("_tripdata_"), year, F.lit("-"), month, F.lit(".parquet"))
    key = F.concat(
        F.lit("bronze/"), F.col("feed.service_type"), F.lit("/year="), year, F.lit("/month="), month, F.lit("/"), name
    )
    return expanded.select(
        *[c for c in months.columns if c != month_start],
        F.col("feed.dataset").alias("dataset"),
        F.col("feed.service_type").alias("service_type"),
        year.alias("year"),
        month.alias("month"),
        F.concat(F.lit(f"{base_url}/trip-data/"), name).alias("source_url"),
        key.alias("bronze_object_key"),
        key.alias("local_relative_path"),
    )


def lookup_manifest(spark: SparkSession, base_url: str) -> DataFrame:
    """The manifest row of the reference file; it has no year and month."""
    return spark.range(1).select(
        F.lit(LOOKUP_DATASET).alias("dataset"),
        F.lit("reference_data").alias("service_type"),
        F.lit(None).cast("string").alias("year"),
        F.lit(None).cast("string").alias("month"),
        F.lit(f"{base_url}/misc/taxi_zone_lookup.csv").alias("source_url"),
        F.lit(LOOKUP_KEY).alias("bronze_object_key"),
        F.lit(LOOKUP_KEY).alias("local_relative_path"),
    )


def fingerprints(content: DataFrame, body: str) -> DataFrame:
    """Size and SHA-256 of each body, and whether it may be stored: empty content may not."""
    data = F.col(body).cast("binary")
    size = F.octet_length(data).cast("long")
    return content.withColumns(
        {"file_size_bytes": size, "sha256": F.sha2(data, 256), "accepted": F.coalesce(size > 0, F.lit(False))}
    )


#: Files up to this size are hashed as one binary value by Spark itself; larger ones a megabyte at a time in a task.
WHOLE_UP_TO = 256 << 20


def file_fingerprints(spark: SparkSession, root: str, whole_up_to: int = WHOLE_UP_TO) -> DataFrame:
    """Path, size and SHA-256 of the files under a folder.

    Files of at most ``whole_up_to`` bytes are read and hashed by Spark's binary file source; the bound is a filter that
    reaches that source, so it opens no other file. Larger ones, which would not fit a value, are spread by path and read
    in chunks inside the tasks; only their paths go through the shuffle. Spark's file listing leaves empty files out, so
    an empty file has no fingerprint and ``refused_files`` reports it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    small = files.where(F.col("length") <= whole_up_to)
    whole = small.select("path", F.col("length").alias("file_size_bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole_up_to).select("path")
    chunked = large.repartition("path").mapInPandas(_hash_files, "path string, file_size_bytes long, sha256 string")
    return whole.unionByName(chunked).withColumn("accepted", F.col("file_size_bytes") > 0)


def refused_files(expected: DataFrame, prints: DataFrame, path: str = "path") -> DataFrame:
    """Expected files that are missing or empty."""
    return expected.join(prints.where("accepted").select(path), path, "left_anti")


def _hash_files(batches):
    import hashlib

    import pandas as pd
    from pyarrow import fs

    for batch in batches:
        rows = []
        for path in batch["path"]:
            uri = path if "://" in path else path.replace("file:", "file://", 1)
            store, key = fs.FileSystem.from_uri(uri)
            digest, size = hashlib.sha256(), 0
            with store.open_input_stream(key) as stream:
                while chunk := stream.read(1 << 20):
                    digest.update(chunk)
                    size += len(chunk)
            rows.append((path, size, digest.hexdigest()))
        yield pd.DataFrame(rows, columns=["path", "file_size_bytes", "sha256"])


def object_listing(spark: SparkSession, root: str, metadata: DataFrame) -> DataFrame:
    """Each object with its size and stored metadata. Contents are not read.

    ``metadata`` has ``bronze_object_key`` and a map column ``metadata``.
    """
    base = root.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    listed = files.select(
        F.substring_index(F.col("path"), base, -1).alias("bronze_object_key"),
        F.col("length").alias("content_length"),
        F.col("modificationTime").alias("last_modified"),
    )
    return listed.join(metadata, "bronze_object_key", "left").withColumn("exists", F.lit(True))


def object_metadata(manifest: DataFrame, ingested_at_utc: str) -> DataFrame:
    """Add the non-empty key/value pairs stored with each object."""
    names = ("sha256", "file_size_bytes", "source_url", "dataset", "service_type", "year", "month")
    pairs = []
    for n in names:
        if n in manifest.columns:
            pairs += [F.lit(n), F.coalesce(F.col(n).cast("string"), F.lit(""))]
    pairs += [F.lit("ingested_at_utc"), F.lit(ingested_at_utc)]
    return manifest.withColumn("metadata", F.map_filter(F.create_map(*pairs), lambda _, v: v != ""))


def months_old(checked_on: Column, year: Column, month: Column) -> Column:
    return month_index(checked_on) - (year.cast("int") * 12 + month.cast("int") - 1)


def is_historical(checked_on: Column, year: Column, month: Column, grace: int = DEFAULT_GRACE_MONTHS) -> Column:
    """A missing file is a failure once it is older than the grace period; a file without a month never is."""
    return F.coalesce(months_old(checked_on, year, month) > grace, F.lit(False))


def classify(manifest: DataFrame, listing: DataFrame, fetched: DataFrame, checked_on: Column, grace: int = DEFAULT_GRACE_MONTHS) -> DataFrame:
    """The status of every manifest row.

    ``listing``: bronze_object_key, content_length, metadata (map) of what is stored already.
    ``fetched``: source_url, http_status, file_size_bytes, sha256 of what was asked of the source.
    Stored objects are checked against their metadata and skipped; for the rest, 403 and 404 mean
    the source has no such file, and an empty body is refused.
    """
    stored = listing.select("bronze_object_key", "content_length", "metadata", F.lit(True).alias("stored"))
    asked = fetched.select(
        "source_url", "http_status", F.col("file_size_bytes").cast("string").alias("fetched_size"), F.col("sha256").alias("fetched_sha")
    )
    joined = manifest.join(stored, "bronze_object_key", "left").join(asked, "source_url", "left")
    noted_size = _noted("file_size_bytes")
    noted_url = _noted("source_url")
    size = F.col("content_length").cast("string")
    mismatch = (noted_size.isNotNull() & ~noted_size.eqNullSafe(size)) | (
        noted_url.isNotNull() & (noted_url != F.col("source_url"))
    )
    verified = _noted("sha256").isNotNull() & noted_size.isNotNull()
    status = (
        F.when(F.col("stored") & mismatch, "failed_existing_metadata_mismatch")
        .when(F.col("stored") & verified, "skipped_existing_verified")
        .when(F.col("stored"), "skipped_existing_unverified")
        .when(
            F.col("http_status").isin(403, 404) & is_historical(checked_on, F.col("year"), F.col("month"), grace),
            "failed_source_missing_historical",
        )
        .when(F.col("http_status").isin(403, 404), "skipped_source_unavailable_recent")
        .when((F.col("http_status") == 200) & (F.coalesce(F.col("fetched_size"), F.lit("0")) == "0"), "failed_empty_file")
        .when(F.col("http_status") == 200, "uploaded")
        .otherwise("failed_source_error")
    )
    kept = [c for c in manifest.columns]
    return joined.select(
        *kept,
        status.alias("status"),
        F.when(F.col("stored"), size).otherwise(F.col("fetched_size")).alias("file_size_bytes"),
        F.when(F.col("stored"), F.coalesce(_noted("sha256"), F.lit(""))).otherwise(F.col("fetched_sha")).alias("sha256"),
        F.when(F.col("stored").isNull(), F.col("http_status").cast("string")).alias("http_status"),
    )


def _noted(name: str) -> Column:
    """A metadata value, with an empty one counting as absent."""
    return F.nullif(F.try_element_at(F.col("metadata"), F.lit(name)), F.lit(""))


def new_work(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest rows whose object does not exist yet."""
    return manifest.join(listing.select("bronze_object_key"), "bronze_object_key", "left_anti")
