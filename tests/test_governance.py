from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from fareloom.plans.answers import answer
from fareloom.plans.catalog import Catalog, CatalogTable, JoinPath, contract_problems, gold_catalog
from fareloom.plans.governed import Filter, GovernedQueryError, Join, Metric, Request, check_request, governed_query, plan_request
from fareloom.plans.policy import policy_scan
from fareloom.plans.routing import route_questions
from fareloom.plans.warehouse import warehouse

CATALOG = gold_catalog()
VENDOR = Join("dim_vendor", "vendor_id", "vendor_id", "v")
COUNT = Metric("trips", "count")


@pytest.mark.parametrize(
    ("request_", "message"),
    [
        (Request(""), "at least one"),
        (Request("silver_trips", ("pickup_date",)), "unknown tables"),
        (Request("gold_unknown", ("pickup_date",)), "unknown tables"),
        (Request("fact_trips", ("*",)), "Wildcard"),
        (Request("fact_trips", ("*",), joins=(VENDOR,)), "Wildcard"),
        (Request("gold_daily_kpis", ("pickup_date", "fake_metric")), "unknown column"),
        (Request("fact_trips", ("x.vendor_name",), joins=(VENDOR,)), "unknown table or alias"),
        (Request("fact_trips", ("v.secret",), joins=(VENDOR,)), "unknown column"),
        (Request("fact_trips", ("v.vendor_name",), joins=(replace(VENDOR, left_column="payment_type"),)), "join path"),
        (Request("fact_trips", ("v.vendor_name",), joins=(replace(VENDOR, left_column=""),)), "cartesian"),
        (Request("gold_daily_kpis", ("pickup_date",), joins=(Join("dim_date", "pickup_date", "pickup_date"),)), "join path"),
        (Request("fact_trips", ("vendor_id",), filters=(Filter("nothing", "=", 1),)), "unknown column"),
        (Request("fact_trips", ("vendor_id",), filters=(Filter("vendor_id", "drop", 1),)), "Unknown comparison"),
        (Request("fact_trips", ("vendor_id",), max_rows=0), "max_rows"),
        (Request("fact_trips", ("vendor_id",), max_rows=1001), "max_rows"),
        (Request("fact_trips", ("vendor_id",), (COUNT,), order_by=("-fares",)), "unknown column"),
        (Request("fact_trips", ("vendor_id",), (Metric("x", "exec", "vendor_id"),)), "Unknown aggregate"),
        (Request("fact_trips", joins=(VENDOR, VENDOR), metrics=(COUNT,)), "used twice"),
        (Request("fact_trips"), "project"),
    ],
)
def test_refused_requests(request_, message):
    with pytest.raises(GovernedQueryError, match=message):
        check_request(request_, CATALOG)


def test_disabled_tables_and_filters_outside_the_list():
    disabled = Catalog(tuple(replace(t, execution_enabled=t.name != "fact_trips") for t in CATALOG.tables))
    with pytest.raises(GovernedQueryError, match="not execution-enabled"):
        check_request(Request("fact_trips", ("vendor_id",)), disabled)
    narrow = Catalog(tuple(replace(t, allowed_filters=("pickup_date",)) for t in CATALOG.tables))
    with pytest.raises(GovernedQueryError, match="not an allowed filter"):
        check_request(Request("fact_trips", ("vendor_id",), filters=(Filter("vendor_id", "=", "1"),)), narrow)


def test_joins_are_allowed_in_both_directions():
    turned = Request("dim_vendor", ("vendor_name",), (COUNT,), joins=(Join("fact_trips", "vendor_id", "vendor_id"),))
    check_request(turned, CATALOG)


def test_results_are_bounded(spark, small):
    wh = warehouse(spark, small)
    rows = governed_query(wh.table, CATALOG, Request("gold_zone_demand", ("*",), max_rows=7))
    assert rows.count() == 7
    assert governed_query(wh.table, CATALOG, Request("fact_trips", ("pickup_date",), top_n=500, max_rows=20)).count() == 20
    total = governed_query(wh.table, CATALOG, Request("fact_trips", (), (COUNT,))).first().trips
    assert total == wh.fact_trips.count()


def test_split_and_plain_plans_agree(spark, small):
    wh = warehouse(spark, small)
    base = Request("fact_trips", ("v.vendor_name",), (COUNT, Metric("paid", "sum", "total_amount")), joins=(VENDOR,))
    plain = replace(base, metrics=(*base.metrics, Metric("zones", "count_distinct", "pickup_zone_id")))
    split = {tuple(r) for r in governed_query(wh.table, CATALOG, base).collect()}
    assert split == {tuple(r)[:3] for r in governed_query(wh.table, CATALOG, plain).collect()}


def test_surface_choice():
    assert plan_request(CATALOG, ("service_type",), ("trip_count",)).base == "gold_daily_kpis"
    assert plan_request(CATALOG, ("pickup.borough",), ("total_amount",)).base == "gold_zone_demand"
    fact = plan_request(CATALOG, ("service_type",), ("total_amount", "avg_trip_distance"))
    assert fact.base == "fact_trips" and not fact.joins
    pair = plan_request(CATALOG, ("pickup.borough", "dropoff.borough"), ("trip_count",), roles=("pickup", "dropoff"))
    assert [j.left_column for j in pair.joins] == ["pickup_zone_id", "dropoff_zone_id"]
    with pytest.raises(GovernedQueryError):
        plan_request(CATALOG, ("weather",), ("trip_count",))


def test_gold_tables_keep_the_contract(spark, small):
    tables = warehouse(spark, small).gold_tables()
    assert contract_problems(tables, CATALOG) == []
    tables["dim_zone"] = tables["dim_zone"].drop("borough").withColumn("odd", F.lit(1))
    del tables["dim_date"]
    assert contract_problems(tables, CATALOG) == [
        "catalog table dim_date does not exist", "column dim_zone.odd is not in the catalog",
        "catalog column dim_zone.borough does not exist",
    ]


UNSAFE = [
    "delete from gold_daily_kpis", "update dim_zone set borough = 'x'", "insert into fact_trips values (1)",
    "drop view gold_zone_demand", "create table t as select * from gold_daily_kpis", "alter table dim_zone drop column borough",
    "copy gold_daily_kpis to 'out.csv'", "attach 'other.db'", "pragma show_tables", "install anything",
    "select trip_count from gold_daily_kpis; delete from dim_zone",
    "select borough from dim_zone union all select secret from accounts", "select * from silver_trips",
    "select name from information_schema.columns", "select * from pg_catalog.pg_class", "select password from accounts",
    "select * from read_parquet('/data/x')", "select * from dim_zone", "select f.* from fact_trips f",
    "select pickup_date, * from fact_trips", "select borough from dim_zone cross join dim_vendor",
    "select f.fare_amount from fact_trips f join dim_vendor v",
    "select f.fare_amount from fact_trips f join dim_zone z on f.vendor_id = z.zone_id",
    "select g.trip_count from gold_zone_demand g join dim_zone z on g.zone_id = z.zone_id",
    "select hidden from gold_daily_kpis", "select g.hidden from gold_daily_kpis g", "select 1", "",
]
SAFE = [
    "select borough, sum(trip_count) as trips from gold_zone_demand group by borough order by trips desc limit 5",
    "select * from gold_zone_demand where borough = 'drop table x; --'",
    "select avg(trip_distance) as d from fact_trips",
    "select pz.borough, count(*) as n from fact_trips as f join dim_zone as pz on f.pickup_zone_id = pz.zone_id "
    "join dim_zone as dz on f.dropoff_zone_id = dz.zone_id group by pz.borough",
    "select v.vendor_name, count(*) from fact_trips f join dim_vendor v on v.vendor_id = f.vendor_id "
    "where f.pickup_date >= date '2024-01-01' group by v.vendor_name",
    "with d as (select pickup_date, sum(trip_count) as n from gold_daily_kpis group by pickup_date) select d.pickup_date, n from d",
    "SELECT service_type,\n  SUM(trip_count) AS trips\nFROM gold_daily_kpis\nWHERE pickup_date BETWEEN DATE '2024-01-01' AND DATE '2024-06-30'\nGROUP BY service_type",
]


def test_policy_audit(spark):
    rows = [(t, True) for t in UNSAFE] + [(t, False) for t in SAFE]
    df = policy_scan(spark.createDataFrame(rows, "sql string, should_block boolean"), "sql", CATALOG)
    wrong = [(r["sql"], r.reasons) for r in df.collect() if r.blocked != r.should_block]
    assert wrong == []


QUESTIONS = [
    ("So sánh số chuyến Yellow Taxi và Green Taxi theo tháng trong nửa đầu năm 2024", "monthly_service_comparison", "aggregate_mart", date(2024, 1, 1), date(2024, 7, 1)),
    ("Average trip distance by service type by month in 2024 H1", "monthly_service_kpi", "aggregate_mart", date(2024, 1, 1), date(2024, 7, 1)),
    ("Total amount by service type by month in 2023", "monthly_service_total_amount", "star_schema", date(2023, 1, 1), date(2024, 1, 1)),
    ("Vendor trend by month", "vendor_analysis", "star_schema", None, None),
    ("Payment type distribution thang 12 2024", "payment_analysis", "star_schema", date(2024, 12, 1), date(2025, 1, 1)),
    ("Pickup borough demand in 2024 H1", "pickup_borough_demand", "aggregate_mart", date(2024, 1, 1), date(2024, 7, 1)),
    ("Compare pickup and dropoff borough demand", "pickup_dropoff_borough_comparison", "star_schema", None, None),
    ("Top pickup zones by trip count", "zone_demand", "aggregate_mart", None, None),
    ("Dropoff borough demand", "dropoff_borough_demand", "star_schema", None, None),
    ("Trips by month in 2024 H1", "monthly_trip_trend", "star_schema", date(2024, 1, 1), date(2024, 7, 1)),
    ("Tell me a story", "general_gold_query", "llm_planned", None, None),
]


def test_routing(spark):
    df = route_questions(spark.createDataFrame([(q[0],) for q in QUESTIONS], "text string"), "text", CATALOG)
    got = {r.text: (r.intent, r.surface, r.date_from, r.date_to) for r in df.collect()}
    assert got == {q[0]: q[1:] for q in QUESTIONS}


def test_routing_details(spark):
    texts = ["trips", "compare", "show data", "Top 5 khu vực taxi vàng", "Khu vực nào nhiều chuyến nhất", "thang 13 2024", "revenue per zone green vs yellow"]
    rows = {r.text: r for r in route_questions(spark.createDataFrame([(t,) for t in texts], "text string"), "text", CATALOG).collect()}
    assert [rows[t].needs_clarification for t in texts[:4]] == [True, True, True, False]
    assert rows[texts[3]].top_n == 5 and rows[texts[3]].service_type == "yellow_taxi"
    assert rows[texts[4]].top_n == 1
    assert rows[texts[5]].month is None and rows[texts[5]].date_to == date(2025, 1, 1)
    assert rows[texts[6]].service_type is None and rows[texts[6]].metric == "total_amount"


@pytest.mark.parametrize(
    ("question", "columns", "rows"),
    [
        ("Monthly trips of yellow and green in 1998 H1", {"month", "service_type", "trip_count"}, 12),
        ("Fare by month and service type", {"month", "service_type", "total_fare_amount"}, None),
        ("Revenue per month, yellow and green", {"month", "service_type", "total_amount", "trip_count"}, None),
        ("Trips by month", {"year_month", "total_trip_distance", "trip_count", "total_fare_amount", "avg_trip_distance"}, None),
        ("Top 3 zones by revenue", {"zone_name", "borough", "trip_count", "total_amount"}, 3),
        ("Which borough has the most trips?", {"borough", "trip_count", "total_amount"}, 1),
        ("Dropoff borough demand", {"borough", "trip_count", "total_amount"}, 5),
        ("Vendors", {"vendor_name", "trip_count", "total_amount", "total_fare_amount", "avg_trip_distance"}, 3),
        ("Vendor trend by month thang 3 nam 2011", {"year_month", "vendor_name", "trip_count", "total_amount"}, 0),
        ("Payment mix", {"payment_type_name", "trip_count", "total_amount"}, 4),
        ("pickup against dropoff borough", {"pickup_borough", "dropoff_borough", "trip_count", "total_amount"}, 25),
    ],
)
def test_answers(spark, small, question, columns, rows):
    # Years before 2000 are not recognised as such, so most questions cover everything.
    found = answer(warehouse(spark, small), question)
    assert set(found.result.columns) == columns
    count = found.result.count()
    assert count <= 100
    if rows is not None and "1998" not in question:
        assert count == rows
    warnings = {r.warning for r in found.warnings.collect()}
    assert ("The query returned no rows." in warnings) == (count == 0)
    assert not any("Expected grouping" in w for w in warnings)
    assert found.finding.count() == (1 if count else 0)


@pytest.mark.parametrize("question", ["trips", "compare", "how is the weather"])
def test_questions_without_an_answer(spark, small, question):
    found = answer(warehouse(spark, small), question)
    assert found.result is None and found.needs_clarification == (question != "how is the weather")


def test_star_join_on_a_tiny_warehouse(spark):
    tables = {
        "fact_trips": spark.createDataFrame([(date(2024, 1, 1), 1, 3.5)], "pickup_date date, vendor_id int, trip_distance double"),
        "dim_vendor": spark.createDataFrame([(1, "One")], "vendor_id int, vendor_name string"),
    }
    path = JoinPath("fact_trips", "vendor_id", "dim_vendor", "vendor_id")
    catalog = Catalog(
        (
            CatalogTable("fact_trips", "fact", True, fields=("pickup_date", "vendor_id", "trip_distance"), allowed_joins=(path,)),
            CatalogTable("dim_vendor", "dimension", True, fields=("vendor_id", "vendor_name")),
        )
    )
    request = Request(
        "fact_trips", ("v.vendor_name",), (Metric("distance", "sum", "trip_distance"),), joins=(Join("dim_vendor", "vendor_id", "vendor_id", "v"),)
    )
    assert [tuple(r) for r in governed_query(tables.get, catalog, request).collect()] == [("One", 3.5)]
    # Without vendor rows nothing joins.
    tables["dim_vendor"] = tables["dim_vendor"].limit(0)
    assert governed_query(tables.get, catalog, request).count() == 0


def test_gold_views_serve_plain_sql(spark, small):
    wh = warehouse(spark, small)
    wh.register_views()
    sql = "with daily as (select pickup_date, sum(trip_count) as n from gold_daily_kpis group by 1) select sum(n) from daily"
    assert spark.sql(sql).first()[0] == wh.fact_trips.count()
