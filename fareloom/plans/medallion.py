"""One run over the lakehouse: bronze to silver to gold, checks, gate and run document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.dates import in_months
from fareloom.operators import gold, quality
from fareloom.plans.warehouse import GOLD_TABLES, Warehouse
from fareloom.sources.sinks import write_run_document
from fareloom.sources.versions import VersionedTable
from fareloom.workspace import write_table

MONTH = ("source_year", "source_month")
MONTHLY = ("silver", "gold_daily_kpis", "gold_zone_demand")


class StoredWarehouse(Warehouse):
    """A warehouse whose silver and gold tables live under a fixed folder.

    Silver and the marts are versioned by source month, the dimensions as a whole: readers see the months before or
    after a run, and a run that fails leaves what was there. A trip's day lies in its source month, so a changed month
    changes just that month of the marts.
    """

    def __init__(self, spark: SparkSession, source: Warehouse, root: str):
        super().__init__(spark, source.bronze, source.zones)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stored(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name), MONTH if name in MONTHLY else ())

    def build_silver(self, months: list[tuple[int, int]] | None = None) -> None:
        """Rebuild silver, or only the given source months, leaving the others untouched."""
        plan = self.silver_plan
        self._store("silver", plan if months is None else plan.where(in_months(months)), plan.columns, months, ("pickup_date",))

    def build_gold(self, months: list[tuple[int, int]] | None = None) -> None:
        """Rebuild the dimensions, and the marts or only their given months, from stored silver."""
        fact = self.fact_trips if months is None else self.fact_trips.where(in_months(months))
        for name, plan in {
            "dim_date": gold.dim_date(self.silver),
            "dim_vendor": gold.dim_vendor(self.silver),
            "dim_payment_type": gold.dim_payment_type(self.silver),
            "dim_zone": gold.dim_zone(self.zones),
            "dim_service_type": self.dim_service_type,
        }.items():
            self._store(name, plan, plan.columns)
        for name, plan in {"gold_daily_kpis": gold.daily_kpis(fact), "gold_zone_demand": gold.zone_demand(fact, self.dim_zone)}.items():
            dated = plan.withColumns({"source_year": F.year("pickup_date"), "source_month": F.month("pickup_date")})
            self._store(name, dated, plan.columns, months, ("pickup_date",))

    def _store(self, name: str, plan: DataFrame, columns: list[str], months: list[tuple[int, int]] | None = None, order: tuple[str, ...] = ()) -> None:
        table = self.stored(name)
        replaced = None if months is None else [(str(y), str(m)) for y, m in months]
        table.commit(plan, replaced, order, rebalance=name in MONTHLY)
        found = table.read()
        self.__dict__[name] = (plan.limit(0) if found is None else found).select(*columns)


def run_medallion(
    spark: SparkSession,
    source: Warehouse,
    root: str,
    ingestion: DataFrame,
    *,
    job: str,
    run_id: str,
    run_mode: str,
    logical_date: str | None,
    created_at_utc: str,
    months: list[tuple[int, int]] | None = None,
) -> tuple[StoredWarehouse, str]:
    """Build silver, then gold, then check, then write the run document; return its key.

    With ``months`` only those source months are read from bronze and replaced in silver and the marts; one that has no
    row any more vanishes. Without stored tables all months are built.

    A failed gate is recorded in the document; what to do about it is the caller's decision.
    """
    wh = StoredWarehouse(spark, source, root)
    if not wh.stored("silver").versions():
        months = None
    wh.build_silver(months)
    wh.build_gold(months)
    tables = {name: wh.table(name) for name in GOLD_TABLES}
    report = quality.quality_report({**tables, "zone_lookup": wh.dim_zone, "silver_trips": wh.silver})
    write_table(report, wh.path(f"quality/{run_id}"))
    stored = spark.read.schema(report.schema).parquet(wh.path(f"quality/{run_id}"))
    summary = quality.run_summary(
        ingestion, quality.layer_results(stored), job=job, run_id=run_id, run_mode=run_mode,
        logical_date=logical_date, created_at_utc=created_at_utc,
    )
    return wh, write_run_document(summary, wh.root)
