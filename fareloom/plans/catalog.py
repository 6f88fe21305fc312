"""The semantic catalog: which gold tables, columns and join paths may be queried."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MART, FACT, DIMENSION = "aggregate_mart", "fact", "dimension"


@dataclass(frozen=True)
class JoinPath:
    left_table: str
    left_column: str
    right_table: str
    right_column: str


@dataclass(frozen=True)
class CatalogTable:
    name: str
    table_type: str = MART
    execution_enabled: bool = False
    grain: str = ""
    description: str = ""
    fields: tuple[str, ...] = ()
    dimensions: tuple[str, ...] = ()
    metrics: tuple[str, ...] = ()
    allowed_filters: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[JoinPath, ...] = ()
    allowed_joins: tuple[JoinPath, ...] = ()
    preferred_questions: tuple[str, ...] = ()

    @property
    def columns(self) -> frozenset[str]:
        return frozenset((*self.fields, *self.dimensions, *self.metrics, *self.allowed_filters, *self.primary_key))


@dataclass(frozen=True)
class Catalog:
    tables: tuple[CatalogTable, ...] = field(default_factory=tuple)

    def get(self, name: str) -> CatalogTable | None:
        return next((t for t in self.tables if t.name == name), None)

    def enabled(self) -> Catalog:
        return Catalog(tuple(t for t in self.tables if t.execution_enabled))

    def names(self) -> list[str]:
        return [t.name for t in self.tables]

    def joins(self) -> frozenset[JoinPath]:
        """Allowed join paths in both directions."""
        paths = [j for t in self.tables for j in t.allowed_joins]
        turned = [JoinPath(j.right_table, j.right_column, j.left_table, j.left_column) for j in paths]
        return frozenset((*paths, *turned))

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The catalog as rows with nested lists."""
        rows = [json.dumps(asdict(t)) for t in self.tables]
        parsed = spark.createDataFrame([(r,) for r in rows], "doc string")
        join = "array<struct<left_table:string,left_column:string,right_table:string,right_column:string>>"
        words = ", ".join(
            f"{n} array<string>"
            for n in ("fields", "dimensions", "metrics", "allowed_filters", "primary_key", "preferred_questions")
        )
        schema = (
            "name string, table_type string, execution_enabled boolean, grain string, description string, "
            f"{words}, foreign_keys {join}, allowed_joins {join}"
        )
        return parsed.select(F.from_json("doc", schema).alias("t")).select("t.*")


def load_catalog(path: str | Path) -> Catalog:
    """Read a catalog file (JSON, or YAML where a YAML reader is installed)."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        payload = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("no YAML reader is installed; convert the catalog to JSON") from exc
        payload = yaml.safe_load(text)
    return Catalog(tuple(_table(item) for item in (payload or {}).get("tables", [])))


def _table(item: dict) -> CatalogTable:
    def names(key: str) -> tuple[str, ...]:
        return tuple(v["name"] if isinstance(v, dict) else v for v in item.get(key) or ())

    return CatalogTable(
        name=item["name"],
        table_type=item.get("table_type", MART),
        execution_enabled=item.get("execution_enabled", False),
        grain=item.get("grain", ""),
        description=item.get("description", ""),
        fields=names("fields"),
        dimensions=names("dimensions"),
        metrics=names("metrics"),
        allowed_filters=names("allowed_filters"),
        primary_key=names("primary_key"),
        foreign_keys=tuple(
            JoinPath(item["name"], f["column"], f["references_table"], f["references_column"])
            for f in item.get("foreign_keys") or ()
        ),
        allowed_joins=tuple(JoinPath(**j) for j in item.get("allowed_joins") or ()),
        preferred_questions=names("preferred_questions"),
    )


# The tables, columns and keys of the gold contract.
_CONTRACT = [
    (
        "gold_daily_kpis", MART, "one row per service type and pickup date",
        ["service_type", "pickup_date"], ["trip_count", "total_fare_amount", "avg_trip_distance"],
        ["service_type", "pickup_date"],
    ),
    (
        "gold_zone_demand", MART, "one row per service type, pickup date and pickup zone",
        ["service_type", "pickup_date", "zone_id", "borough", "zone_name"], ["trip_count", "total_amount"],
        ["service_type", "pickup_date", "zone_id"],
    ),
    (
        "fact_trips", FACT, "one row per valid trip",
        [
            "service_type", "source_year", "source_month", "pickup_date", "pickup_at", "dropoff_at", "vendor_id",
            "pickup_zone_id", "dropoff_zone_id", "payment_type",
        ],
        ["passenger_count", "trip_distance", "fare_amount", "total_amount"], [],
    ),
    (
        "dim_date", DIMENSION, "one row per pickup date",
        ["pickup_date", "year", "quarter", "month", "day", "day_name", "day_of_week", "year_month"], [], ["pickup_date"],
    ),
    ("dim_zone", DIMENSION, "one row per zone", ["zone_id", "borough", "zone_name", "service_zone"], [], ["zone_id"]),
    ("dim_service_type", DIMENSION, "one row per service type", ["service_type", "service_type_name"], [], ["service_type"]),
    ("dim_vendor", DIMENSION, "one row per vendor", ["vendor_id", "vendor_name"], [], ["vendor_id"]),
    ("dim_payment_type", DIMENSION, "one row per payment code", ["payment_type", "payment_type_name"], [], ["payment_type"]),
]
_FACT_KEYS = [
    ("pickup_date", "dim_date", "pickup_date"),
    ("service_type", "dim_service_type", "service_type"),
    ("vendor_id", "dim_vendor", "vendor_id"),
    ("payment_type", "dim_payment_type", "payment_type"),
    ("pickup_zone_id", "dim_zone", "zone_id"),
    ("dropoff_zone_id", "dim_zone", "zone_id"),
]


def gold_catalog() -> Catalog:
    keys = tuple(JoinPath("fact_trips", c, t, k) for c, t, k in _FACT_KEYS)
    tables = []
    for name, kind, grain, dimensions, metrics, key in _CONTRACT:
        columns = tuple(dict.fromkeys((*dimensions, *metrics)))
        table = CatalogTable(
            name, kind, True, grain, fields=columns, dimensions=tuple(dimensions), metrics=tuple(metrics),
            allowed_filters=columns, primary_key=tuple(key),
        )
        tables.append(replace(table, foreign_keys=keys, allowed_joins=keys) if kind == FACT else table)
    return Catalog(tuple(tables))


def contract_problems(tables: dict[str, DataFrame], catalog: Catalog) -> list[str]:
    """Differences between the gold tables and the catalog, in both directions."""
    problems = [f"table {n} is not in the catalog" for n in sorted(set(tables) - set(catalog.names()))]
    problems += [f"catalog table {n} does not exist" for n in sorted(set(catalog.names()) - set(tables))]
    for name in sorted(set(tables) & set(catalog.names())):
        have, want = set(tables[name].columns), catalog.get(name).columns
        problems += [f"column {name}.{c} is not in the catalog" for c in sorted(have - want)]
        problems += [f"catalog column {name}.{c} does not exist" for c in sorted(want - have)]
    return problems


def has_columns(table: CatalogTable | None, columns: set[str]) -> bool:
    """True when the table is enabled and catalogs all the columns."""
    return table is not None and table.execution_enabled and columns <= table.columns


def name_differences(models: DataFrame, cataloged: DataFrame, name: str = "name") -> DataFrame:
    """Names on one side only. Both sides are tables with a ``name`` column; each name is moved once a task, however often it occurs."""
    modelled, listed = models.select(name).distinct(), cataloged.select(name).distinct()
    left, right = modelled.join(listed, name, "left_anti"), listed.join(modelled, name, "left_anti")
    return left.withColumn("missing_from", F.lit("catalog")).unionByName(right.withColumn("missing_from", F.lit("models")))
