"""Answering one question: route it, run the named query it asks for, bound and check the result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from fareloom.functions.dates import DateWindow
from fareloom.operators.quality import result_warnings
from fareloom.operators.ranking import MAX_ROWS_DEFAULT, bounded, key_finding
from fareloom.plans import queries
from fareloom.plans.catalog import Catalog, gold_catalog
from fareloom.plans.routing import route_questions
from fareloom.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Answer:
    """``result`` is None when the question is unclear or no named query covers it."""

    intent: str
    surface: str
    tables: list[str]
    needs_clarification: bool
    result: DataFrame | None = None
    warnings: DataFrame | None = None
    finding: DataFrame | None = None


def answer(wh: Warehouse, question: str, max_rows: int = MAX_ROWS_DEFAULT, catalog: Catalog | None = None) -> Answer:
    log = wh.spark.range(1).select(F.lit(question).alias("question"))
    routed = route_questions(log, "question", catalog or gold_catalog()).first()
    base = (routed.intent, routed.surface, routed.tables, routed.needs_clarification)
    result = None if routed.needs_clarification else named_result(wh, routed)
    if result is None:
        return Answer(*base)
    result = bounded(result, max_rows)
    return Answer(
        *base, result, result_warnings(result, max_rows, tuple(routed.expected_groupings)), key_finding(result)
    )


def named_result(wh: Warehouse, routed: Row) -> DataFrame | None:
    """The named query of a routed question with its filters. Only rankings take a top-n; "top 0" asks for nothing less."""
    window = DateWindow(routed.date_from, routed.date_to) if routed.date_from else None
    service, metric, n = routed.service_type, routed.metric, routed.top_n or None
    ranked = dict(window=window, service=service, metric=metric, n=n)
    if routed.intent == "vendor_analysis" and "year_month" in routed.expected_groupings:
        trend = queries.vendor_monthly_trend(wh, window, service)
        return trend if n is None else trend.limit(n)
    builders = {
        "monthly_service_comparison": lambda: queries.monthly_service_comparison(wh, window),
        "monthly_service_kpi": lambda: queries.monthly_service_kpi(wh, metric, window),
        "monthly_service_total_amount": lambda: queries.monthly_service_total_amount(wh, window),
        "monthly_trip_trend": lambda: queries.monthly_trip_trend(wh, window, service),
        "zone_demand": lambda: queries.zone_demand_ranking(wh, **ranked),
        "pickup_borough_demand": lambda: queries.pickup_borough_demand(wh, **ranked),
        "dropoff_borough_demand": lambda: queries.dropoff_borough_demand(wh, **ranked),
        "vendor_analysis": lambda: queries.vendor_analysis(wh, **ranked),
        "payment_analysis": lambda: queries.payment_analysis(wh, **ranked),
        "pickup_dropoff_borough_comparison": lambda: queries.pickup_dropoff_matrix(wh, window, n),
    }
    return builders[routed.intent]() if routed.intent in builders else None
