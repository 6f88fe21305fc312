"""The queries over written files and tables, restated as SQL over the given tables."""

from __future__ import annotations

from oracle_control import CLASSIFIED, quality_cte
from oracle_queries import H1, WITH, exact

_FILES = f"""{WITH}, files as (
  select service_type, cast(year(pickup_date) as integer) as "year", cast(month(pickup_date) as integer) as "month",
         string_agg(strftime(pickup_date, '%Y-%m-%d') || ',' || trip_count, chr(10) order by pickup_date) || chr(10) as body
  from daily group by 1, 2, 3)"""
_PRINTS = f"""{_FILES} select service_type, "year", "month", cast(strlen(body) as bigint) as file_size_bytes, sha256(body) as sha256,
  true as accepted from files"""


def all_sql() -> dict[str, str]:
    return {
        "file_fingerprints": _PRINTS,
        "file_fingerprints_chunked": _PRINTS,
        "object_listing": f"""{_FILES} select service_type, "year", "month", cast(strlen(body) as bigint) as content_length,
            case when "month" % 2 = 0 then sha256(body) end as stored_sha256, true as "exists" from files""",
        "serving_tables": f"""{WITH}, paid as (select payment_type, count(*) as trips, round({exact('total_amount')}, 2) as revenue
              from silver where {H1} group by 1)
            select 'daily_kpis' as table_name, service_type as label, count(*) as row_count, cast(sum(trip_count) as bigint) as trips,
              max(total_fare_amount) as largest from daily where {H1} group by 2
            union all select 'zone_demand', borough, count(*), cast(sum(trip_count) as bigint), max(total_amount) from zone_demand
              where {H1} group by 2
            union all select 'payment_summary', payment_type, 1, trips, revenue from paid""",
        "gold_views": f"""{WITH} select case f.service_type when 'yellow_taxi' then 'Yellow Taxi' else 'Green Taxi' end as service_type_name,
            v.vendor_name, z.borough, cast(year(f.pickup_date) as integer) as "year", count(*) as trips, max(f.total_amount) as dearest
            from silver f join dim_vendor v using (vendor_id) join dim_zone z on f.pickup_zone_id = z.zone_id group by 1, 2, 3, 4""",
        "exported_daily_kpis": f"""{WITH}, windowed as (select *, count(*) over () as reported_rows from daily where {H1})
            select format, windowed.* from windowed, (values ('parquet'), ('csv')) v(format)""",
        "zones_from_csv": f"{WITH} select * from dim_zone",
        "latest_run_documents": f"""{quality_cte()}, {CLASSIFIED}, gate as (
              select count(*) filter (where status = 'pass') as pass, count(*) filter (where status = 'warn') as warn,
                count(*) filter (where status = 'error') as error from report),
            files as (select count(*) filter (where status like 'failed%') as failed,
                sha256(string_agg(bronze_object_key || ' ' || status, chr(10) order by bronze_object_key || ' ' || status)) as files_sha256
              from classified)
            select run_id, logical_date, case when failed > 0 or error > 0 then 'failed_blocking' when warn > 0 then 'passed_with_warnings'
              else 'passed' end as gate_status, pass, warn, error, files_sha256
            from gate, files, (values ('run-1', '1998-09-01'), ('run-2', '1998-08-15')) v(run_id, logical_date)""",
        "month_differences": f"""{WITH}, named as (select distinct service_type, printf('%04d-%02d', source_year, source_month) as name from raw)
            select name, case when service_type = 'yellow_taxi' then 'catalog' else 'models' end as missing_from
            from named where name not in (select name from named o where o.service_type <> named.service_type)""",
        "verified_queries": f"""{WITH} select 'daily_kpis' as query, case when count(*) > 0 then 'ran' else 'empty' end as outcome,
              false as explained from daily where {H1}
            union all select 'negative_fares', case when count(*) > 0 then 'ran' else 'empty' end, false from silver where fare_amount < 0
            union all select 'unknown_table', 'failed', true""",
    }
