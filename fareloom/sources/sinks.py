"""Where results go: Parquet, CSV, serving tables, run documents, audit log."""

from __future__ import annotations

import logging
import uuid
from contextlib import nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.dates import in_months
from fareloom.functions.text import run_document_key
from fareloom.sources.documents import audit_events
from fareloom.sources.feeds import MONTH_KEYS, FeedSpec, feed_folder, register, register_months
from fareloom.workspace import open_folders

log = logging.getLogger(__name__)


def export(df: DataFrame, path: str, name: str) -> int:
    """Write a result as Parquet and as header CSV under ``path`` and return its row count.

    The count is taken while the Parquet file is written; the CSV is written from that file, so
    the result is computed once.
    """
    seen = Observation(f"export_{name}")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    stored = df.sparkSession.read.parquet(f"{path}/{name}.parquet")
    write_csv(stored, f"{path}/{name}.csv")
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def build_serving_tables(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Create or replace the standalone tables a BI tool reads, and return their row counts."""
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"serve_{name}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/{name}")
        counts[name] = seen.get["rows"]
    return counts


def serve_tables(spark: SparkSession, tables: dict[str, DataFrame], database: str, root: str) -> dict[str, int]:
    """Create or replace tables of the session's catalog, to be read as ``database.name``, and return their row counts.

    Each build writes a folder of its own below ``root`` and then names it as the table's location, so a query that has
    begun goes on with the old rows, and a build that fails leaves the table as it was. A table of other columns or types
    is dropped and created anew. Folders of earlier builds stay until the caller removes them.
    """
    root = root.rstrip("/")
    spark.sql(f"create database if not exists `{database}` location {_quoted(root)}")
    counts = {}
    for name, df in tables.items():
        folder, seen = f"{root}/{name}/{uuid.uuid4().hex}", Observation(f"serve_{name}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
        full = f"`{database}`.`{name}`"
        if spark.catalog.tableExists(full) and spark.table(full).dtypes == df.dtypes:
            spark.sql(f"alter table {full} set location {_quoted(folder)}")
            spark.catalog.refreshTable(full)
        else:
            spark.sql(f"drop table if exists {full}")
            spark.catalog.createTable(full, path=folder, source="parquet", schema=df.schema)
        counts[name] = seen.get["rows"]
    return counts


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def land_feed(raw: DataFrame, root: str, spec: FeedSpec, rebalance: bool = True) -> int:
    """Write a feed in the monthly landing layout, leaving months that have landed alone; returns the rows written.

    A month has landed once it is in the register, which is extended after its files are complete. What a failed landing
    left of a month is replaced by the next one. Months that are there before the feed has a register are entered first.
    Rows are dealt out by month; ``raw`` that lies in month folders itself goes without that shuffle.
    """
    spark = raw.sparkSession
    if not register(spark, root, spec).versions():
        register_months(spark, root, spec)
    table = register(spark, root, spec)
    known, entries = table.versions(), [tuple(e) for e in table.entries()]
    held = sorted({tuple(int(part.split("=")[1]) for part in e[0].split("/")[:2]) for e in entries})
    fresh = raw.where(~in_months(held, *MONTH_KEYS)) if held else raw
    seen = Observation(f"land_{spec.dataset}")
    folders = F.collect_set(F.concat_ws("/", *(F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in MONTH_KEYS)))
    dealt = fresh.hint("rebalance", *MONTH_KEYS) if rebalance else fresh
    written = dealt.observe(seen, F.count(F.lit(1)).alias("rows"), folders.alias("folders"))
    writer = written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH_KEYS)
    with nullcontext() if rebalance else open_folders(spark):
        writer.parquet(feed_folder(root, spec))
    if seen.get["rows"]:
        table.replace_list([*entries, *((name, "", fresh.schema.json()) for name in sorted(seen.get["folders"]))], known)
    return seen.get["rows"]


def write_run_document(summary: DataFrame, root: str) -> str:
    """Write a one-row run summary as JSON under its stable key and return the key."""
    key = summary.select(run_document_key(F.col("dag_id"), F.col("run_id"), F.col("logical_date"))).first()[0]
    # One document per run: the folder carries the key, the part file inside it the document.
    summary.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/{key}")
    return key


def document_metadata(summary: DataFrame) -> DataFrame:
    """The three values stored beside a run document as object metadata."""
    return summary.select(
        F.create_map(
            F.lit("dag_id"), F.col("dag_id"), F.lit("run_id"), F.col("run_id"),
            F.lit("quality_gate"), F.col("quality_gate.status"),
        ).alias("metadata")
    )


def append_audit(requests: DataFrame, path: str) -> bool:
    """Append audit events. A failing audit never fails the query; it is reported instead."""
    try:
        audit_events(requests).write.mode("append").json(path)
        return True
    except Exception:  # noqa: BLE001
        log.exception("audit events were not written to %s", path)
        return False
