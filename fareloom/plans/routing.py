"""Routing a log of questions: which analysis each text asks for, as added columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.text import fold_text, has_any
from fareloom.plans.catalog import Catalog

# The words that signal each notion, in English and in unaccented Vietnamese.
MONTHLY = (
    "monthly", "year_month", "by month", "per month", "theo thang", "tung thang", "moi thang", "hang thang", "cac thang",
)
TRIP = ("trip", "trips", "chuyen", "luot")
ZONE = ("zone", "borough", "pickup zone", "khu vuc", "diem don")
BOROUGH = ("borough",)
ZONE_WORDING = ("zone", "khu vuc")
PICKUP = ("pickup", "diem don")
DROPOFF = ("dropoff", "diem tra")
VENDOR = ("vendor", "provider", "hang xe", "nha cung cap")
PAYMENT = ("payment", "cash", "card", "thanh toan")
TREND = ("trend", "over time", "by month", "theo thang")
DISTANCE = ("average distance", "avg distance", "avg trip distance", "trip distance", "khoang cach")
FARE = ("total fare", "fare amount", "fare", "cuoc")
AMOUNT = ("total amount", "revenue", "doanh thu", "tong tien")
FIRST_HALF = ("h1", "first half", "nua dau")
SUPERLATIVE = ("highest", "most", "largest", "longest", "maximum")
ASKING = ("which", "what")
UNCLEAR = ("compare", "comparison", "so sanh", "show data", "data")

MART, STAR, PLANNED = "aggregate_mart", "star_schema", "llm_planned"


def route_questions(df: DataFrame, text: str, catalog: Catalog) -> DataFrame:
    """Add the normalised text, the intent with its tables, and the filters the text implies."""
    folded = df.withColumn("normalized", fold_text(F.col(text)))
    q = F.col("normalized")
    staged = folded.withColumns(
        {
            "needs_clarification": needs_clarification(q),
            "metric": asked_metric(q),
            "year": asked_year(q),
            "month": asked_month(q),
            "half": has_any(q, FIRST_HALF),
            "service_type": asked_service(q),
            "top_n": asked_top_n(q),
        }
    )
    # Every notion is looked for once, then the rules combine the findings into a plan number.
    signals = {f"_{name}": found for name, found in notions(q).items()}
    numbered = staged.withColumns(signals).withColumn("_plan", plan_number(F.col("metric")))
    start, end = asked_window(F.col("year"), F.col("month"), F.col("half"))
    plans = [*PLANS, Plan("general_gold_query", PLANNED, tuple(catalog.enabled().names()), ())]

    def chosen(options: list) -> Column:
        return F.get(F.array(*options), F.col("_plan"))

    def names(values: tuple[str, ...]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return numbered.select(
        *staged.columns,
        chosen([F.lit(p.intent) for p in plans]).alias("intent"),
        chosen([F.lit(p.surface) for p in plans]).alias("surface"),
        chosen([names(p.tables) for p in plans]).alias("tables"),
        chosen([names(p.groupings) for p in plans]).alias("expected_groupings"),
        start.alias("date_from"),
        end.alias("date_to"),
    )


def needs_clarification(q: Column) -> Column:
    words = F.when(q == "", 0).otherwise(F.size(F.split(q, r"[\s\x1c-\x1f]+")))
    return ((words <= 2) & has_any(q, TRIP)) | q.isin(*UNCLEAR)


def asked_metric(q: Column) -> Column:
    return (
        F.when(has_any(q, DISTANCE), "avg_trip_distance")
        .when(has_any(q, FARE), "total_fare_amount")
        .when(has_any(q, AMOUNT), "total_amount")
        .otherwise("trip_count")
    )


def asked_year(q: Column) -> Column:
    return F.regexp_extract(q, r"\b(20\d{2})\b", 1).try_cast("int")


def asked_month(q: Column) -> Column:
    month = F.regexp_extract(q, r"\bthang\s+(\d{1,2})\b", 1).try_cast("int")
    return F.when(month.between(1, 12), month)


def asked_service(q: Column) -> Column:
    """Both services or neither means no filter."""
    yellow = q.contains("yellow") | q.contains("vang")
    green = q.contains("green") | q.contains("xanh")
    return F.when(yellow & ~green, "yellow_taxi").when(green & ~yellow, "green_taxi")


def asked_top_n(q: Column) -> Column:
    """``top N`` asks for N rows; a singular superlative asks for one."""
    stated = F.regexp_extract(q, r"\btop\s+(\d+)\b", 1).try_cast("long")
    single = (q.contains("nhat") & q.contains("nao")) | (has_any(q, SUPERLATIVE) & has_any(q, ASKING))
    return F.coalesce(stated, F.when(single, F.lit(1).cast("long")))


def asked_window(year: Column, month: Column, half: Column) -> tuple[Column, Column]:
    """Half-open dates: the month if one is named, else the first half-year, else the year."""
    one = F.lit(1)
    start = F.make_date(year, F.coalesce(month, one), one)
    months = F.when(month.isNotNull(), 1).when(half, 6).otherwise(12)
    return start, F.add_months(start, months)


def names_services(q: Column) -> Column:
    return (
        (q.contains("yellow") & q.contains("green"))
        | (q.contains("vang") & q.contains("xanh"))
        | q.contains("service type")
    )


@dataclass(frozen=True)
class Plan:
    intent: str
    surface: str
    tables: tuple[str, ...]
    groupings: tuple[str, ...]


_BY_MONTH = ("month", "service_type")
# In the order in which the rules are tried.
PLANS = (
    Plan("pickup_dropoff_borough_comparison", STAR, ("fact_trips", "dim_zone"), ("pickup_borough", "dropoff_borough")),
    Plan("monthly_service_total_amount", STAR, ("fact_trips",), _BY_MONTH),
    Plan("monthly_service_kpi", MART, ("gold_daily_kpis",), _BY_MONTH),
    Plan("monthly_service_comparison", MART, ("gold_daily_kpis",), _BY_MONTH),
    Plan("monthly_trip_trend", STAR, ("fact_trips", "dim_date"), ("year_month",)),
    Plan("dropoff_borough_demand", STAR, ("fact_trips", "dim_zone"), ("borough",)),
    Plan("pickup_borough_demand", MART, ("gold_zone_demand",), ("borough",)),
    Plan("zone_demand", MART, ("gold_zone_demand",), ("zone_name",)),
    Plan("vendor_analysis", STAR, ("fact_trips", "dim_vendor"), ("year_month", "vendor_name")),
    Plan("vendor_analysis", STAR, ("fact_trips", "dim_vendor"), ("vendor_name",)),
    Plan("payment_analysis", STAR, ("fact_trips", "dim_payment_type"), ("payment_type_name",)),
)


def notions(q: Column) -> dict[str, Column]:
    return {
        "monthly": has_any(q, MONTHLY),
        "services": names_services(q),
        "trip": has_any(q, TRIP),
        "zone": has_any(q, ZONE),
        "borough": has_any(q, BOROUGH),
        "zone_wording": has_any(q, ZONE_WORDING),
        "pickup": has_any(q, PICKUP),
        "dropoff": has_any(q, DROPOFF),
        "vendor": has_any(q, VENDOR),
        "payment": has_any(q, PAYMENT),
        "trend": has_any(q, TREND),
    }


def plan_number(metric: Column) -> Column:
    """The place in ``PLANS`` of the first rule that holds, or the place after the last."""

    def has(name: str) -> Column:
        return F.col(f"_{name}")

    monthly_service = has("monthly") & has("services")
    rules = [
        has("pickup") & has("dropoff") & has("zone"),
        monthly_service & (metric == "total_amount"),
        monthly_service & metric.isin("avg_trip_distance", "total_fare_amount"),
        monthly_service,
        has("monthly") & has("trip"),
        has("dropoff") & has("zone"),
        has("borough") & ~has("zone_wording"),
        has("zone"),
        has("vendor") & (has("monthly") | has("trend")),
        has("vendor"),
        has("payment"),
    ]
    number = F.when(rules[0], 0)
    for i, rule in enumerate(rules[1:], start=1):
        number = number.when(rule, i)
    return number.otherwise(len(rules))
