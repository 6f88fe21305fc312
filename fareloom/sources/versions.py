"""Tables whose readers see the old or the new state of a partition, never a half-written one.

Data files are written to a folder of their own for each commit. A commit then writes a new list of (partition values,
commit, schema) under the next version number, and Spark's writer marks that list as complete in one last step. Readers
take the newest complete list, so a failed or running commit is invisible to them, and of two writers that start from the
same version one fails. Each entry keeps the schema its files were written with: a scan needs no look at the files, and
partitions of different schemas are read schema by schema.

The lists hold a row for each partition, of which there are as many as months; only they pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.workspace import folder_names, remove_folders, write_table

_LIST_SCHEMA = "partition string, commit string, schema string"
_DONE = "_SUCCESS"


class VersionedTable:
    """A table under ``root`` in partitions of ``keys``; without keys it is replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ()) -> None:
        self.spark, self.root, self.keys = spark, root.rstrip("/"), tuple(keys)

    # --- lists

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        base = f"{self.root}/versions"
        numbers = sorted(int(name.split("=")[1]) for name in folder_names(self.spark, base) if name.startswith("version="))
        return [n for n in numbers if _DONE in folder_names(self.spark, f"{base}/version={n}")]

    def entries(self, version: int | None = None) -> list[Row]:
        """The partitions of a version (the newest unless given), in the order of their names."""
        if version is None:
            known = self.versions()
            if not known:
                return []
            version = known[-1]
        listed = self.spark.read.schema(_LIST_SCHEMA).json(f"{self.root}/versions/version={version}")
        return sorted(listed.collect(), key=lambda e: e.partition)

    def values(self) -> list[tuple[str, ...]]:
        """Values of the keys for which there are rows."""
        return [tuple(part.split("=", 1)[1] for part in e.partition.split("/")) for e in self.entries() if e.partition]

    # --- reading and writing

    def read(self, as_found: Callable[[DataFrame], DataFrame] = lambda df: df, version: int | None = None) -> DataFrame | None:
        """The rows of a version, or None for a table without any partition.

        Partitions are read once for each schema, with that schema; ``as_found`` is applied to each of these reads, for
        instance to cast them alike. Columns that a schema lacks are null.
        """
        by_schema: dict[str, list[str]] = defaultdict(list)
        for e in self.entries(version):
            by_schema[e.schema].append("/".join(p for p in (f"{self.root}/data/commit={e.commit}", e.partition) if p))
        united = None
        for schema, folders in by_schema.items():
            reader = self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).option("basePath", f"{self.root}/data")
            part = as_found(reader.parquet(*folders).drop("commit"))
            united = part if united is None else united.unionByName(part, allowMissingColumns=True)
        return united

    def commit(self, df: DataFrame, replaced: Sequence[tuple] | None = None, sort_by: tuple[str, ...] = (), rebalance: bool = False) -> list[tuple]:
        """Put the rows of ``df`` in place of the partitions ``replaced`` (all of them if None) in one step.

        Values of ``replaced`` without a row vanish. Returns the values that got rows.
        """
        known = self.versions()
        commit, seen = uuid.uuid4().hex, Observation()
        values = F.struct(*(F.col(k).cast("string").alias(k) for k in self.keys)) if self.keys else F.lit(0)
        dealt = df.hint("rebalance", *self.keys) if rebalance else df
        observed = dealt.observe(seen, F.collect_set(values).alias("values"))
        write_table(observed, f"{self.root}/data/commit={commit}", self.keys, sort_by, "errorifexists", rebalance=False)
        full = sorted(tuple(v) for v in seen.get["values"]) if self.keys else [()]
        named = lambda v: "/".join(f"{k}={x}" for k, x in zip(self.keys, v))
        gone = None if replaced is None else {named(v) for v in replaced} | {named(v) for v in full}
        kept = [] if gone is None or not known else [tuple(e) for e in self.entries(known[-1]) if e.partition not in gone]
        fresh = [(named(v), commit, df.schema.json()) for v in full]
        self.replace_list([*kept, *fresh], known)
        return full

    def replace_list(self, entries: list[tuple], known: list[int] | None = None) -> None:
        """Make ``entries`` the next version after ``known``; fails if another writer was first."""
        known = self.versions() if known is None else known
        rows = self.spark.createDataFrame(entries, _LIST_SCHEMA).coalesce(1)
        rows.write.mode("errorifexists").json(f"{self.root}/versions/version={known[-1] + 1 if known else 1}")

    def vacuum(self) -> int:
        """Remove what the newest version does not need: older lists, and commits that it does not name, failed ones too.

        Only to be called while no reader is on an older version and no commit is running. Returns the commits removed.
        """
        known = self.versions()
        used = {f"commit={e.commit}" for e in self.entries()}
        old = [name for name in folder_names(self.spark, f"{self.root}/data") if name not in used]
        lists = [name for name in folder_names(self.spark, f"{self.root}/versions") if known and name != f"version={known[-1]}"]
        remove_folders(self.spark, [f"{self.root}/data/{n}" for n in old] + [f"{self.root}/versions/{n}" for n in lists])
        return len(old)


def schema_groups(spark: SparkSession, base: str, folders: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Folders of Parquet files by schema, for files that nobody registered.

    Spark merges the schemas of all files in one distributed job. Where they conflict, the folders are halved until they
    agree; a source changes its types at a few dates, so neighbouring folders stay together and the number of jobs grows
    with the number of changes, not of folders. A folder whose own files conflict comes file by file.
    """
    reader = spark.read.option("mergeSchema", "true").option("basePath", base)
    try:
        return [(reader.parquet(*folders).schema, folders)]
    except (PySparkException, Py4JJavaError) as exc:
        if "CANNOT_MERGE_SCHEMAS" not in str(exc):
            raise
    if len(folders) == 1:
        files = [name for name in folder_names(spark, folders[0]) if not name.startswith(("_", "."))]
        if len(files) < 2:
            raise RuntimeError(f"the schemas below {folders[0]} cannot be merged")
        parts = [f"{folders[0]}/{name}" for name in sorted(files)]
    else:
        parts = folders
    half = len(parts) // 2
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, found in [*schema_groups(spark, base, parts[:half]), *schema_groups(spark, base, parts[half:])]:
        groups.setdefault(schema.json(), (schema, []))[1].extend(found)
    return list(groups.values())
