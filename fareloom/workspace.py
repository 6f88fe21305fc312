"""Session settings and the shared folder in which derived tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fareloom") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the submitter's session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str | None:
    """The folder every executor can reach, or None when a cluster names none.

    ``spark.checkpoint.dir`` decides. A local folder is chosen only for a local master with the
    setting unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return None
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="fareloom-")
        spark.sparkContext.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used before, so a retried build never meets a half-written table."""
    root = shared_root(spark)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder to write derived tables")
    return f"{root}/fareloom/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def materialize(
    df: DataFrame,
    name: str,
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
    rebalance: bool = True,
) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it; fails where a cluster names no folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path, partition_by, sort_by, rebalance=rebalance)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
    mode: str = "overwrite",
    rebalance: bool = True,
) -> None:
    """Write a table in files of a sensible size.

    The rebalance hint lets adaptive execution split a hot partition value over several tasks and
    merge small ones, so a month holding a third of the rows is not written by one task and small
    months do not become one file per task. It costs a shuffle, so input that already lies in the
    directories it is written to goes without.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    if partition_by or sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    if mode == "overwrite" and partition_by:
        writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


@contextmanager
def open_folders(spark: SparkSession, most: int = 32) -> Iterator[None]:
    """Inside, a writing task keeps up to ``most`` folders open instead of sorting its whole split by folder.

    For input that lies in the folders it is written to: a split of Spark's default size packs at most 32 files. A task that
    meets more folders sorts the rest of its rows.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def replace_partitions(
    df: DataFrame, path: str, partition_by: tuple[str, ...], replaced: list[tuple], sort_by: tuple[str, ...] = (), rebalance: bool = True
) -> None:
    """Replace the partitions ``replaced`` (values of ``partition_by``) by the rows of ``df``.

    Spark overwrites the partitions that got rows; those of the list that got none are removed afterwards.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    written = F.collect_set(F.concat_ws("/", *(F.col(c).cast("string") for c in partition_by)))
    writer = df.sortWithinPartitions(*partition_by, *sort_by).observe(seen, written.alias("written")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    full = set(seen.get["written"])
    emptied = [values for values in replaced if "/".join(map(str, values)) not in full]
    remove_folders(df.sparkSession, ["/".join([path.rstrip("/"), *(f"{c}={v}" for c, v in zip(partition_by, values))]) for values in emptied])


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders through Spark's file systems; missing ones are left alone."""
    for name in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, through Spark's file systems; none for a missing folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []
