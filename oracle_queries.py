"""The registered queries restated as SQL over the given tables."""

from __future__ import annotations

UNIT = float(2**64)


def exact(col: str) -> str:
    """The double next to the exact sum: values as whole multiples of 2^-64, which they are in the given tables."""
    return f"cast(sum(cast({col} * {UNIT:.1f} as hugeint)) as double) / {UNIT:.1f}"


def avg(col: str) -> str:
    return f"{exact(col)} / nullif(count({col}), 0)"


RAW = """
raw as (
  select case when l_linestatus = 'F' then 'yellow_taxi' else 'green_taxi' end as service_type,
         cast(year(filed) as integer) as source_year, cast(month(filed) as integer) as source_month,
         cast(l_suppkey % 4 as varchar) as vendor_id,
         l_shipdate as pickup_at, o_orderdate as dropoff_at,
         cast(s_nationkey as integer) as pickup_zone_id, cast(c_nationkey as integer) as dropoff_zone_id,
         cast(l_linenumber as integer) as passenger_count, cast(l_quantity as double) as trip_distance,
         cast(case when l_orderkey % 97 = 0 then -l_extendedprice else l_extendedprice end as double) as fare_amount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) as total_amount,
         case when o_orderpriority like '4%' then null else substr(o_orderpriority, 1, 1) end as payment_type
  from (select *, case when l_orderkey % 50 = 0 then l_shipdate - interval 1 month else l_shipdate end as filed
        from lineitem) l
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
)"""

SILVER = """
silver as (
  select service_type, source_year, source_month, cast(pickup_at as date) as pickup_date, pickup_at, dropoff_at,
         vendor_id, pickup_zone_id, dropoff_zone_id, passenger_count, trip_distance, fare_amount, total_amount,
         payment_type
  from raw
  where pickup_at is not null and dropoff_at is not null
    and pickup_zone_id is not null and dropoff_zone_id is not null
    and trip_distance >= 0 and fare_amount >= 0
    and pickup_at >= make_date(source_year, source_month, 1)
    and pickup_at < make_date(source_year, source_month, 1) + interval 1 month
)"""

ZONE = """
dim_zone as (
  select cast(n_nationkey as integer) as zone_id, r_name as borough, n_name as zone_name,
         case when n_nationkey % 5 = 0 then 'Airports' else 'Boro Zone' end as service_zone
  from nation join region on n_regionkey = r_regionkey
)"""

DIMS = """
dim_date as (
  select pickup_date, cast(year(pickup_date) as integer) as year, cast(quarter(pickup_date) as integer) as quarter,
         cast(month(pickup_date) as integer) as month, cast(day(pickup_date) as integer) as day,
         dayname(pickup_date) as day_name, cast(dayofweek(pickup_date) as integer) as day_of_week,
         strftime(pickup_date, '%Y-%m') as year_month
  from (select distinct pickup_date from silver where pickup_date is not null)
),
dim_vendor as (
  select vendor_id, case vendor_id when '1' then 'Creative Mobile Technologies, LLC' when '2' then 'VeriFone Inc.'
                    else 'Unknown vendor' end as vendor_name
  from (select distinct vendor_id from silver where vendor_id is not null)
),
dim_payment_type as (
  select payment_type, case payment_type when '1' then 'Credit card' when '2' then 'Cash' when '3' then 'No charge'
                       when '4' then 'Dispute' when '5' then 'Unknown' when '6' then 'Voided trip'
                       else 'Other' end as payment_type_name
  from (select distinct payment_type from silver where payment_type is not null)
),
dim_service_type as (
  select * from (values ('yellow_taxi', 'Yellow Taxi'), ('green_taxi', 'Green Taxi')) v(service_type, service_type_name)
)"""

MARTS = f"""
daily as (
  select service_type, pickup_date, count(*) as trip_count, {exact('fare_amount')} as total_fare_amount,
         {avg('trip_distance')} as avg_trip_distance
  from silver group by 1, 2
),
zone_demand as (
  select t.service_type, t.pickup_date, z.zone_id, z.borough, z.zone_name, count(*) as trip_count,
         {exact('t.total_amount')} as total_amount
  from silver t left join dim_zone z on t.pickup_zone_id = z.zone_id group by 1, 2, 3, 4, 5
)"""

WITH = "with " + ",".join([RAW, SILVER, ZONE, DIMS, MARTS]) + "\n"

H1 = "pickup_date >= date '1998-01-01' and pickup_date < date '1998-07-01'"
BETWEEN = "pickup_date between date '1998-01-01' and date '1998-06-30'"
MONTH = "strftime(pickup_date, '%Y-%m')"
N = "cast(sum(trip_count) as bigint)"
PRICE = exact("f.total_amount")


def star(select: str, joins: str = "", where: str = H1, group: str = "", tail: str = "") -> str:
    where = where.replace("pickup_date", "f.pickup_date") if where else "true"
    grouping = f" group by {group}" if group else ""
    return f"{WITH} select {select} from silver f {joins} where {where}{grouping} {tail}"


VENDOR = "join dim_vendor v on f.vendor_id = v.vendor_id"
PAYMENT = "join dim_payment_type p on f.payment_type = p.payment_type"
DATE = "join dim_date d on f.pickup_date = d.pickup_date"
PICKUP = "join dim_zone pz on f.pickup_zone_id = pz.zone_id"
DROPOFF = "join dim_zone dz on f.dropoff_zone_id = dz.zone_id"


def insight(name: str, label: str, join: str, where: str = "true") -> str:
    return f"""select '{name}' as insight, {label} as group_name, count(*) as trips,
      round(count(*) * 100.0 / sum(count(*)) over (), 2) as share_pct, {PRICE} as revenue
      from silver f {join} where f.{H1.replace(' and pickup', ' and f.pickup')} and {where} group by {label}"""


def model_sql() -> dict[str, str]:
    """Layers, dimensions and marts."""
    bronze = """select service_type, vendor_id as "VendorID", pickup_at as {p}_pickup_datetime,
      dropoff_at as {p}_dropoff_datetime, pickup_zone_id as "PULocationID", dropoff_zone_id as "DOLocationID",
      passenger_count, trip_distance, fare_amount, total_amount, payment_type, source_year as "year",
      source_month as "month" from (select * replace (cast(vendor_id as bigint) as vendor_id) from raw)
      where service_type = '{s}'"""
    rules = {
        "null_pickup_timestamp": "pickup_at is null",
        "null_dropoff_timestamp": "dropoff_at is null",
        "null_pickup_zone": "pickup_zone_id is null",
        "null_dropoff_zone": "dropoff_zone_id is null",
        "negative_distance": "trip_distance < 0",
        "negative_fare": "fare_amount < 0",
        "outside_source_month": "not (pickup_at >= make_date(source_year, source_month, 1) and "
        "pickup_at < make_date(source_year, source_month, 1) + interval 1 month)",
    }
    checks = " union all ".join(
        f"select '{n}' as check_name, count(*) filter (where {r}) as row_count from raw" for n, r in rules.items()
    )
    return {
        "bronze_yellow_trips": WITH + bronze.format(p="tpep", s="yellow_taxi"),
        "bronze_green_trips": WITH + bronze.format(p="lpep", s="green_taxi"),
        "zone_lookup": WITH + "select * from dim_zone",
        "silver_trips": WITH + "select * from silver",
        "reject_diagnostics": WITH
        + f"""select 'raw_rows' as check_name, count(*) as row_count from raw
            union all select 'passed', count(*) from silver
            union all select 'failed', (select count(*) from raw) - (select count(*) from silver)
            union all {checks}""",
        "partition_months": WITH
        + """select source_year, source_month, service_type, count(*) as trip_count from silver
            where source_year = 1998 and source_month between 1 and 6 group by 1, 2, 3""",
        "dim_date": WITH + "select * from dim_date",
        "dim_vendor": WITH + "select * from dim_vendor",
        "dim_payment_type": WITH + "select * from dim_payment_type",
        "gold_daily_kpis": WITH + "select * from daily",
        "gold_zone_demand": WITH + "select * from zone_demand",
        "silver_anomaly_rows": WITH
        + """select service_type, pickup_at, dropoff_at, pickup_zone_id, dropoff_zone_id, trip_distance, fare_amount,
            total_amount from silver where dropoff_at < pickup_at or trip_distance > 200 or total_amount < 0""",
        "gold_anomaly_rows": WITH
        + """select * from daily where trip_count <= 0 or total_fare_amount < 0 or avg_trip_distance < 0
            or avg_trip_distance > 200""",
        "anomaly_counts": WITH
        + " union all ".join(
            f"select '{n}' as check_name, count(*) filter (where {r}) as all_rows, "
            f"count(*) filter (where ({r}) and {H1}) as window_rows from silver"
            for n, r in {
                "dropoff_before_pickup": "dropoff_at < pickup_at",
                "distance_over_200": "trip_distance > 200",
                "negative_total": "total_amount < 0",
            }.items()
        ),
        "layer_row_counts": WITH
        + " union all ".join(
            f"select '{layer}' as layer, service_type, count(*) as all_rows, "
            f"count(*) filter (where {H1.replace('pickup_date', day)}) as window_rows from {table} group by 2"
            for layer, table, day in (
                ("bronze", "raw", "cast(pickup_at as date)"),
                ("silver", "silver", "pickup_date"),
                ("gold_daily_kpis", "daily", "pickup_date"),
                ("gold_zone_demand", "zone_demand", "pickup_date"),
            )
        ),
    }


def question_sql() -> dict[str, str]:
    """The named analytic queries."""
    mart = f"{WITH} select {{}} from {{}} where {H1} {{}}"
    return {
        "monthly_service_comparison": mart.format(f"{MONTH} as month, service_type, {N} as trip_count", "daily", "group by 1, 2"),
        "monthly_service_distance": mart.format(
            f"{MONTH} as month, service_type, {avg('avg_trip_distance')} as avg_trip_distance", "daily", "group by 1, 2"
        ),
        "monthly_service_fare": mart.format(
            f"{MONTH} as month, service_type, {exact('total_fare_amount')} as total_fare_amount", "daily", "group by 1, 2"
        ),
        "monthly_service_total_amount": star(
            f"strftime(f.pickup_date, '%Y-%m') as month, service_type, {PRICE} as total_amount, count(*) as trip_count",
            group="1, 2",
        ),
        "monthly_trip_trend": star(
            f"d.year_month, {exact('trip_distance')} as total_trip_distance, count(*) as trip_count, "
            f"{exact('fare_amount')} as total_fare_amount, {avg('trip_distance')} as avg_trip_distance",
            DATE, group="1",
        ),
        "monthly_trip_trend_yellow": star(
            f"d.year_month, {exact('trip_distance')} as total_trip_distance, count(*) as trip_count, "
            f"{exact('fare_amount')} as total_fare_amount, {avg('trip_distance')} as avg_trip_distance",
            DATE, where="f.service_type = 'yellow_taxi'", group="1",
        ),
        "zone_demand_ranking": mart.format(
            f"zone_name, borough, {N} as trip_count, {exact('total_amount')} as total_amount", "zone_demand", "group by 1, 2"
        ),
        "pickup_borough_demand": mart.format(
            f"borough, {N} as trip_count, {exact('total_amount')} as total_amount", "zone_demand", "group by 1"
        ),
        "top_borough_by_amount": mart.format(
            f"borough, {N} as trip_count, {exact('total_amount')} as total_amount", "zone_demand",
            "group by 1 order by 3 desc, 1 limit 3",
        ),
        "dropoff_borough_demand": star(
            f"dz.borough, count(*) as trip_count, {PRICE} as total_amount", DROPOFF, group="1"
        ),
        "pickup_zone_trips": star(
            f"pz.zone_name, pz.service_zone, count(*) as trip_count, {PRICE} as total_amount", PICKUP, group="1, 2"
        ),
        "vendor_analysis": star(
            f"v.vendor_name, count(*) as trip_count, {PRICE} as total_amount, {exact('fare_amount')} as total_fare_amount, "
            f"{avg('trip_distance')} as avg_trip_distance",
            VENDOR, group="1",
        ),
        "top_vendor": star(
            f"v.vendor_name, count(*) as trip_count, {PRICE} as total_amount, {exact('fare_amount')} as total_fare_amount, "
            f"{avg('trip_distance')} as avg_trip_distance",
            VENDOR, group="1", tail="order by trip_count desc, vendor_name limit 1",
        ),
        "vendor_monthly_trend": star(
            f"d.year_month, v.vendor_name, count(*) as trip_count, {PRICE} as total_amount", f"{VENDOR} {DATE}", group="1, 2"
        ),
        "payment_analysis": star(
            f"p.payment_type_name, count(*) as trip_count, {PRICE} as total_amount", PAYMENT, group="1"
        ),
        "pickup_dropoff_matrix": star(
            f"pz.borough as pickup_borough, dz.borough as dropoff_borough, count(*) as trip_count, {PRICE} as total_amount",
            f"{PICKUP} {DROPOFF}", group="1, 2",
        ),
        "daily_kpi_trend": f"{WITH} select * from daily where {BETWEEN}",
        "zone_ranking": f"""{WITH} select zone_name, borough, {N} as trips, {exact('total_amount')} as total_amount
            from zone_demand where {BETWEEN} group by 1, 2 order by 3 desc, 1, 2 limit 25""",
        "vendor_rollup": star(f"v.vendor_name, count(*) as trips, {PRICE} as total_amount", VENDOR, BETWEEN, "1"),
        "payment_rollup": star(f"p.payment_type_name, count(*) as trips, {PRICE} as total_amount", PAYMENT, BETWEEN, "1"),
        "od_matrix": star(
            "pz.borough as pickup_borough, dz.borough as dropoff_borough, count(*) as trips",
            f"{PICKUP} {DROPOFF}", BETWEEN, "1, 2", "order by trips desc, 1, 2 limit 50",
        ),
        "dashboard_cards": mart.format(
            f"{N} as total_trips, {exact('total_fare_amount')} as total_fare, "
            f"{avg('avg_trip_distance')} as mean_of_daily_means, "
            f"round({exact('avg_trip_distance * trip_count')} / sum(trip_count), 6) as weighted_mean_distance", "daily", "",
        ),
        "monthly_fare": mart.format(f"{MONTH} as month, {exact('total_fare_amount')} as total_fare_amount", "daily", "group by 1"),
        "distance_by_service": mart.format(
            f"service_type, {avg('avg_trip_distance')} as avg_trip_distance", "daily", "group by 1"
        ),
        "top10_zones": mart.format(f"zone_name, {N} as trip_count", "zone_demand", "group by 1 order by 2 desc, 1 limit 10"),
        "borough_demand": mart.format(
            f"borough, {N} as trip_count, {exact('total_amount')} as total_amount", "zone_demand", "group by 1"
        ),
        "service_share": mart.format(
            f"service_type, {N} as trip_count, round(sum(trip_count) * 100.0 / sum(sum(trip_count)) over (), 2) as share_pct",
            "daily", "group by 1",
        ),
        "payment_summary": star(
            f"f.payment_type, coalesce(p.payment_type_name, 'Unknown') as payment_type_name, count(*) as trips, "
            f"round({PRICE}, 2) as revenue", "left " + PAYMENT, group="1, 2",
        ),
        "payment_summary_serving": star(
            f"f.payment_type, count(*) as trips, round({PRICE}, 2) as revenue", group="1"
        ),
        "insight_shares": WITH + " union all ".join(
            [
                insight("pickup_borough", "pz.borough", PICKUP),
                insight("service_zone", "pz.service_zone", PICKUP),
                insight("payment_type", "p.payment_type_name", PAYMENT),
                insight("airport_revenue", "pz.zone_name", PICKUP, "pz.service_zone = 'Airports'"),
            ]
        ),
        "distance_median_mean": star(
            f"median(trip_distance) as median_distance, {avg('trip_distance')} as mean_distance"
        ),
        "trips_by_quarter": star("d.quarter, count(*) as trip_count", DATE, "", "1"),
        "trips_by_weekday": star("d.day_name, d.day_of_week, count(*) as trip_count", DATE, "", "1, 2"),
        "city_totals": star(
            "count(*) as trip_count, count(distinct f.pickup_zone_id) as distinct_pickup_zones, "
            "count(*) filter (where pz.borough = 'ASIA') as borough_trips, "
            "round(count(*) filter (where pz.borough = 'ASIA') * 100.0 / count(*), 2) as borough_pct, "
            "min(f.pickup_date) as first_date, max(f.pickup_date) as last_date, max(trip_distance) as max_distance, "
            "max(total_amount) as max_total_amount", "left " + PICKUP,
        ),
        "payment_by_month": star(
            "d.year_month, p.payment_type_name, count(*) as trip_count", f"{PAYMENT} {DATE}", group="1, 2"
        ),
        "service_labelled": star(
            "s.service_type_name, count(*) as trip_count", "join dim_service_type s on f.service_type = s.service_type",
            group="1",
        ),
        "distinct_counts": star(
            "f.service_type, count(distinct vendor_id) as vendors, count(distinct pickup_zone_id) as pickup_zones, "
            "count(distinct f.pickup_date) as days", group="1",
        ),
        "counts_by_year": star("cast(year(f.pickup_date) as integer) as year, count(*) as trip_count", where="", group="1"),
        "date_range": star(
            "min(f.pickup_date) as first_date, max(f.pickup_date) as last_date, count(*) as trip_count", where=""
        ),
        "trips_pivoted_by_service": mart.format(
            f"{MONTH} as month, cast(sum(trip_count) filter (where service_type = 'yellow_taxi') as bigint) as yellow_taxi, "
            "cast(sum(trip_count) filter (where service_type = 'green_taxi') as bigint) as green_taxi", "daily", "group by 1",
        ),
        "passengers_by_payment": star(
            "f.payment_type, cast(sum(passenger_count) as bigint) as passengers", where="", group="1"
        ),
        "key_finding": f"""{WITH} , ranked as (select zone_name, borough, {N} as trip_count from zone_demand where {H1}
            group by 1, 2) select 'trip_count' as metric, cast(trip_count as double) as highest, zone_name, borough
            from ranked order by trip_count desc, zone_name, borough limit 1""",
    }


def all_sql() -> dict[str, str]:
    return {**model_sql(), **question_sql()}
