"""The queries over months as files, restated as SQL over the given tables."""

from __future__ import annotations

from oracle_queries import RAW, WITH, exact

_COLUMNS = (
    "service_type, source_year, source_month, vendor_id, pickup_at, dropoff_at, pickup_zone_id, dropoff_zone_id, "
    "passenger_count, trip_distance, fare_amount, total_amount, payment_type"
)


def _scan(service: str) -> str:
    fees = exact("case when source_year * 100 + source_month >= 199507 then dropoff_zone_id * 0.25 end")
    return f"""with {RAW}, own as (select {_COLUMNS} from raw where service_type = '{service}')
        select own.*, m.month_fees from own join (select source_year, source_month, {fees} as month_fees from own group by 1, 2) m
        using (source_year, source_month)"""


def _marts(rows: str) -> str:
    return f"""{WITH}, kept as (select * from silver where {rows})
        select 'gold_daily_kpis' as mart, service_type, pickup_date, count(*) as trip_count, {exact('fare_amount')} as amount from kept group by 2, 3
        union all select 'gold_zone_demand', service_type, pickup_date, cast(sum(n) as bigint), {exact('amount')} from (
          select service_type, pickup_date, pickup_zone_id, count(*) as n, {exact('total_amount')} as amount from kept group by 1, 2, 3) group by 2, 3"""


def all_sql() -> dict[str, str]:
    return {
        "scan_yellow": _scan("yellow_taxi"),
        "scan_green": _scan("green_taxi"),
        "landed_twice": f"""with {RAW} select service_type, source_year as "year", source_month as "month", count(*) as trips,
            cast(sum(count(*) filter (where source_month <= 6)) over w as bigint) as "first",
            cast(sum(count(*) filter (where source_month > 6)) over w as bigint) as "second", cast(0 as bigint) as "third"
            from raw group by 1, 2, 3 window w as (partition by service_type)""",
        "medallion_run": _marts("true"),
        "medallion_incremental": _marts(
            "source_year * 100 + source_month <> 199502 and (source_year * 100 + source_month not in (199501, 199503) or passenger_count <= 3)"
        ),
    }
