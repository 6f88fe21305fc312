"""SQL twins of the quality, log, routing, ingestion, comparison and streaming queries."""

from __future__ import annotations

from fareloom.plans import routing as words
from fareloom.sources.derived_logs import BASE_URL, QUERY_TEXTS, QUESTIONS
from oracle_queries import DATE, H1, PAYMENT, PICKUP, PRICE, DROPOFF, VENDOR, WITH, avg, exact, star

LOG = """with log as (
  select event_id, ts as started_at, value as elapsed_ms, cast(floor(value) as integer) as whole_ms,
         event_type as surface, cast(user_id % 8 as integer) as level, cast(user_id % 10 as integer) as team,
         case event_type when 'click' then 'pass' when 'view' then 'warn' when 'error' then 'error'
           when 'purchase' then 'skip' else 'error' end as outcome,
         nullif(event_type, 'error') as source, value < 40 as fast
  from events)
"""


# The rules each text of QUERY_TEXTS breaks, in the same order.
BROKEN_RULES = [
    [],
    ["not a select", "write or command word", "unknown column"],
    [],
    ["wildcard on detail table"],
    [],
    ["join off the catalog paths"],
    ["more than one statement", "write or command word", "unknown column"],
    ["unknown column"],
    ["cross join"],
    [],
    ["unknown table", "unknown column"],
]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _choose(key: str, options: list[str]) -> str:
    cases = " ".join(f"when {i} then {o}" for i, o in enumerate(options))
    return f"case {key} % {len(options)} {cases} end"


def _not_null(table: str, source: str, columns: str) -> list[str]:
    return [
        f"select '{table}' as table_name, '{c}' as column_name, 'not_null' as check_name, "
        f"count(*) filter (where {c} is null) as failures, 'error' as severity from {source}"
        for c in columns.split()
    ]


def _unique(table: str, source: str, column: str) -> str:
    return (
        f"select '{table}', '{column}', 'unique', count(*), 'error' from "
        f"(select {column} from {source} where {column} is not null group by 1 having count(*) > 1)"
    )


def _accepted(table: str, source: str, column: str, values: str) -> str:
    return f"select '{table}', '{column}', 'accepted_values', count(*) filter (where {column} not in ({values})), 'error' from {source}"


def _related(table: str, source: str, column: str, parent: str, key: str) -> str:
    return (
        f"select '{table}', '{column}', 'relationships', count(*), 'error' from {source} c where c.{column} is not null "
        f"and not exists (select 1 from {parent} p where p.{key} = c.{column})"
    )


def quality_cte(more: str = "", **instead: str) -> str:
    """All checks; ``more`` adds tables, and ``instead`` names those to check in place of others."""
    services = "'yellow_taxi', 'green_taxi'"
    months = ", ".join(str(m) for m in range(1, 13))
    parts = []
    for table, source, columns in (
        ("zone_lookup", "dim_zone", "zone_id"),
        ("silver_trips", "silver", "service_type source_year source_month pickup_date pickup_zone_id dropoff_zone_id"),
        ("dim_date", "dim_date", "pickup_date year month"),
        ("dim_service_type", "dim_service_type", "service_type service_type_name"),
        ("dim_vendor", "dim_vendor", "vendor_id vendor_name"),
        ("dim_payment_type", "dim_payment_type", "payment_type payment_type_name"),
        ("dim_zone", "dim_zone", "zone_id borough zone_name"),
        (
            "fact_trips", "silver",
            "service_type pickup_date pickup_at dropoff_at vendor_id pickup_zone_id dropoff_zone_id trip_distance "
            "fare_amount total_amount",
        ),
        ("gold_daily_kpis", "daily", "service_type pickup_date trip_count total_fare_amount avg_trip_distance"),
        ("gold_zone_demand", "zone_demand", "service_type pickup_date zone_id borough zone_name trip_count total_amount"),
    ):
        parts += _not_null(table, instead.get(source, source), columns)
    for table, source, column in (
        ("zone_lookup", "dim_zone", "zone_id"), ("dim_date", "dim_date", "pickup_date"),
        ("dim_service_type", "dim_service_type", "service_type"), ("dim_vendor", "dim_vendor", "vendor_id"),
        ("dim_payment_type", "dim_payment_type", "payment_type"), ("dim_zone", "dim_zone", "zone_id"),
    ):
        parts.append(_unique(table, instead.get(source, source), column))
    for table, source, column, values in (
        ("silver_trips", "silver", "service_type", services), ("silver_trips", "silver", "source_month", months),
        ("dim_date", "dim_date", "month", months), ("dim_service_type", "dim_service_type", "service_type", services),
        ("gold_daily_kpis", "daily", "service_type", services), ("gold_zone_demand", "zone_demand", "service_type", services),
    ):
        parts.append(_accepted(table, instead.get(source, source), column, values))
    for column, parent, key in (
        ("service_type", "dim_service_type", "service_type"), ("pickup_date", "dim_date", "pickup_date"),
        ("vendor_id", "dim_vendor", "vendor_id"), ("pickup_zone_id", "dim_zone", "zone_id"),
        ("dropoff_zone_id", "dim_zone", "zone_id"), ("payment_type", "dim_payment_type", "payment_type"),
    ):
        parts.append(_related("fact_trips", "silver", column, instead.get(parent, parent), key))
    parts.append(_related("gold_zone_demand", "zone_demand", "zone_id", instead.get("dim_zone", "dim_zone"), "zone_id"))
    for table, source in (("gold_daily_kpis", "daily"), ("gold_zone_demand", "zone_demand")):
        parts.append(f"select '{table}', '*', 'not_empty', case when exists (select 1 from {source}) then 0 else 1 end, 'error'")
    parts.append(
        "select 'silver_trips', '*', 'anomalies', count(*), 'warn' from silver where dropoff_at < pickup_at "
        "or trip_distance > 200 or total_amount < 0"
    )
    parts.append(
        f"select 'gold_daily_kpis', '*', 'anomalies', count(*), 'warn' from {instead.get('daily', 'daily')} where trip_count <= 0 "
        "or total_fare_amount < 0 or avg_trip_distance < 0 or avg_trip_distance > 200"
    )
    return (
        f"{WITH}{more}, checks as ({' union all '.join(parts)}), report as (select table_name, column_name, check_name, "
        "cast(failures as bigint) as failures, severity, case when failures = 0 then 'pass' else severity end as status from checks)"
    )


# Tables with faults: zones and dates that are missing, a vendor twice, a payment type without a code, months past the
# year's end, marts with fares below zero.
PLANTED = """, faulty_zone as (select * from dim_zone where zone_id % 7 <> 3),
  faulty_date as (select * replace (case when month = 12 then 13 else month end as month) from dim_date where day(pickup_date) <> 31),
  faulty_vendor as (select * from dim_vendor union all select * from dim_vendor where vendor_id = '1'),
  faulty_payment as (select * replace (nullif(payment_type, '2') as payment_type) from dim_payment_type),
  faulty_daily as (select * replace (case when trip_count % 3 = 0 then -total_fare_amount else total_fare_amount end as total_fare_amount) from daily)"""


MANIFEST = f"""manifest as (
  select dataset, service_type, y as year, m as month,
         '{BASE_URL}/trip-data/' || dataset || '_tripdata_' || y || '-' || m || '.parquet' as source_url,
         'bronze/' || service_type || '/year=' || y || '/month=' || m || '/' || dataset || '_tripdata_' || y || '-' || m
           || '.parquet' as bronze_object_key, line_count
  from (select strftime(d, '%Y') as y, strftime(d, '%m') as m, count(*) as line_count
        from (select date_trunc('month', l_shipdate) as d from lineitem) group by 1, 2),
       (values ('yellow', 'yellow_taxi'), ('green', 'green_taxi')) f(dataset, service_type)
)"""
CLASSIFIED = f"""{MANIFEST}, staged as (
  select *, (cast(year as integer) * 12 + cast(month as integer)) % 6 as c,
         1998 * 12 + 9 - (cast(year as integer) * 12 + cast(month as integer)) as age from manifest
), classified as (
  select dataset, service_type, year, month, source_url, bronze_object_key,
    case c when 0 then 'skipped_existing_verified' when 1 then 'skipped_existing_unverified'
      when 2 then 'failed_existing_metadata_mismatch' when 4 then 'uploaded'
      else case when age > 3 then 'failed_source_missing_historical' else 'skipped_source_unavailable_recent' end end as status,
    case when c in (0, 1, 2, 4) then cast(line_count as varchar) end as file_size_bytes,
    case c when 0 then sha256(source_url) when 1 then '' when 2 then '' when 4 then sha256(bronze_object_key) end as sha256,
    case c when 3 then '404' when 4 then '200' when 5 then '403' end as http_status
  from staged
)"""


def _any(col: str, tokens: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains({col}, {_text(t)})" for t in tokens) + ")"


def fold(col: str) -> str:
    decoded = f"replace(replace(replace(replace({col}, 'đ', 'd'), 'Đ', 'D'), 'Ä‘', 'd'), 'Ä' || chr(144), 'D')"
    return f"trim(lower(regexp_replace(strip_accents({decoded}), '[^\\x00-\\x7F]', '', 'g')), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31))"


def routed(source: str) -> str:
    """Routing of a relation with columns id and text."""
    q = "q"
    a = lambda tokens: _any(q, tokens)
    services = (
        "((contains(q, 'yellow') and contains(q, 'green')) or (contains(q, 'vang') and contains(q, 'xanh')) "
        "or contains(q, 'service type'))"
    )
    monthly = a(words.MONTHLY)
    cases = [
        (f"{a(words.PICKUP)} and {a(words.DROPOFF)} and {a(words.ZONE)}", "pickup_dropoff_borough_comparison|star_schema|fact_trips,dim_zone|pickup_borough,dropoff_borough"),
        (f"{monthly} and {services} and metric = 'total_amount'", "monthly_service_total_amount|star_schema|fact_trips|month,service_type"),
        (f"{monthly} and {services} and metric in ('avg_trip_distance', 'total_fare_amount')", "monthly_service_kpi|aggregate_mart|gold_daily_kpis|month,service_type"),
        (f"{monthly} and {services}", "monthly_service_comparison|aggregate_mart|gold_daily_kpis|month,service_type"),
        (f"{monthly} and {a(words.TRIP)}", "monthly_trip_trend|star_schema|fact_trips,dim_date|year_month"),
        (f"{a(words.DROPOFF)} and {a(words.ZONE)}", "dropoff_borough_demand|star_schema|fact_trips,dim_zone|borough"),
        (f"contains(q, 'borough') and not {a(words.ZONE_WORDING)}", "pickup_borough_demand|aggregate_mart|gold_zone_demand|borough"),
        (a(words.ZONE), "zone_demand|aggregate_mart|gold_zone_demand|zone_name"),
        (f"{a(words.VENDOR)} and ({monthly} or {a(words.TREND)})", "vendor_analysis|star_schema|fact_trips,dim_vendor|year_month,vendor_name"),
        (a(words.VENDOR), "vendor_analysis|star_schema|fact_trips,dim_vendor|vendor_name"),
        (a(words.PAYMENT), "payment_analysis|star_schema|fact_trips,dim_payment_type|payment_type_name"),
    ]
    everything = "gold_daily_kpis,gold_zone_demand,fact_trips,dim_date,dim_zone,dim_service_type,dim_vendor,dim_payment_type"
    rules = " ".join(f"when {rule} then '{plan}'" for rule, plan in cases)
    yellow = "(contains(q, 'yellow') or contains(q, 'vang'))"
    green = "(contains(q, 'green') or contains(q, 'xanh'))"
    unclear = ", ".join(_text(w) for w in words.UNCLEAR)
    months = "case when month is not null then 1 when half then 6 else 12 end"
    return f"""with source as ({source}),
    folded as (select id, {fold('text')} as q from source),
    staged as (select id, q,
      (case when q = '' then 0 else len(regexp_split_to_array(q, '[\\s\\x1c-\\x1f]+')) end <= 2 and {a(words.TRIP)})
        or q in ({unclear}) as needs_clarification,
      case when {a(words.DISTANCE)} then 'avg_trip_distance' when {a(words.FARE)} then 'total_fare_amount'
           when {a(words.AMOUNT)} then 'total_amount' else 'trip_count' end as metric,
      try_cast(nullif(regexp_extract(q, '\\b(20\\d{{2}})\\b', 1), '') as integer) as year,
      try_cast(nullif(regexp_extract(q, '\\bthang\\s+(\\d{{1,2}})\\b', 1), '') as integer) as named_month,
      {a(words.FIRST_HALF)} as half,
      case when {yellow} and not {green} then 'yellow_taxi' when {green} and not {yellow} then 'green_taxi' end as service_type,
      coalesce(try_cast(nullif(regexp_extract(q, '\\btop\\s+(\\d+)\\b', 1), '') as bigint),
        case when (contains(q, 'nhat') and contains(q, 'nao')) or ({a(words.SUPERLATIVE)} and {a(words.ASKING)}) then 1 end) as top_n
      from folded),
    planned as (select *, case when named_month between 1 and 12 then named_month end as month,
      case {rules} else 'general_gold_query|llm_planned|{everything}|' end as plan from staged)
    select id, md5(q) as normalized_md5, needs_clarification, metric, year, month, half, service_type, top_n,
      split_part(plan, '|', 1) as intent, split_part(plan, '|', 2) as surface, split_part(plan, '|', 3) as tables,
      split_part(plan, '|', 4) as expected_groupings,
      make_date(year, coalesce(month, 1), 1) as date_from,
      cast(make_date(year, coalesce(month, 1), 1) + to_months({months}) as date) as date_to
    from planned"""


def quality_sql() -> dict[str, str]:
    report = quality_cte()
    return {
        "quality_report": f"{report} select * from report",
        "quality_report_planted": quality_cte(
            PLANTED, dim_zone="faulty_zone", dim_date="faulty_date", dim_vendor="faulty_vendor",
            dim_payment_type="faulty_payment", daily="faulty_daily",
        ) + " select * from report",
        "gold_anomaly_rows_planted": f"{WITH}{PLANTED} select * from faulty_daily where total_fare_amount < 0",
        "layer_outcomes": f"""{report} select case when table_name in ('zone_lookup', 'silver_trips') then 'silver' else 'gold' end
            as layer, count(*) filter (where status = 'pass') as pass, count(*) filter (where status = 'warn') as warn,
            count(*) filter (where status = 'error') as error, cast(0 as bigint) as skip,
            case when count(*) filter (where status = 'error') = 0 then 'success' else 'error' end as status
            from report group by 1""",
        "quality_gate": f"""{report}, {CLASSIFIED} select case when (select count(*) from classified where status like 'failed%') > 0
            or count(*) filter (where status = 'error') > 0 then 'failed_blocking'
            when count(*) filter (where status = 'warn') > 0 then 'passed_with_warnings' else 'passed' end as status,
            count(*) filter (where status = 'pass') as pass, count(*) filter (where status = 'warn') as warn,
            count(*) filter (where status = 'error') as error, cast(0 as bigint) as skip,
            (select count(*) from classified where status like 'failed%') as blocking from report""",
        "run_summary": f"""{report}, {CLASSIFIED} select 'monthly' as dag_id,
            (select string_agg(ym, ',' order by ym) from (select distinct year || '-' || month as ym from classified)) as months,
            (select count(*) from classified) as files, 2 as stages,
            case when (select count(*) from classified where status like 'failed%') > 0 then 'failed_blocking' else 'other' end
            as gate_status""",
        "blocking_results": f"""with {CLASSIFIED} select dataset, status, source_url, bronze_object_key from classified
            where status in ('failed_existing_metadata_mismatch', 'failed_source_missing_historical')""",
        "orphan_keys": """select c_custkey as key, count(*) as row_count from customer
            where c_custkey not in (select o_custkey from orders) group by 1""",
        "duplicate_keys": "select o_custkey, count(*) as row_count from orders group by 1 having count(*) > 1",
        "duplicate_text_rows": """select doc_id, count(*) over (partition by text) as key_rows from documents
            qualify count(*) over (partition by text) > 1""",
        "result_warnings": WITH
        + f""", r as (select * from daily where {H1}), w as (
            select unnest([
              case when (select count(*) from r) = 0 then 'The query returned no rows.' end,
              case when (select count(*) from r) >= 100 then
                'The result reached the max row limit; increase max rows for more detail.' end,
              (select case when year(min(pickup_date)) < 2010 or year(max(pickup_date)) > 2030 then
                '`pickup_date` has an unusual date range: ' || min(pickup_date) || ' to ' || max(pickup_date) || '.' end from r),
              (select case when count(*) filter (where total_fare_amount < 0) > 0 then '`total_fare_amount` contains negative values.' end from r),
              'Expected grouping `month` was not present in the result.']) as warning)
            select warning from w where warning is not null""",
        "run_document_failures": """with k as (select event_id as k, user_id from events), f as (
            select k, unnest([
              case when k % 10 = 0 then 'Missing top-level fields: created_at_utc' end,
              case when k % 6 = 0 then 'run_mode must be manual or scheduled' end,
              case when k % 9 = 0 then 'target_months must be a non-empty list' end,
              case when k % 7 = 0 then 'ingestion_results[0] missing dataset' end,
              case when k % 5 = 0 and k % 3 <> 2 then 'ingestion_results[0] missing bronze_object_key/object_key' end,
              case when k % 4 = 0 and k % 3 <> 2 then 'ingestion_results[0] missing checksum for verified/uploaded object' end,
              case when k % 13 = 0 then 'quality_gate.status has an unexpected value' end,
              case when k % 11 = 0 then 'quality_gate.dbt_counts missing: error' end]) as failure from k)
            select failure, count(*) as documents from f where failure is not null group by 1""",
    }


def metric_sql() -> dict[str, str]:
    pct = lambda p: (
        f"round_even(list_sort(list(elapsed_ms))[1 + least(count(*) - 1, cast(round_even({p} / 100.0 * (count(*) - 1), 0) as bigint))], 1)"
    )
    text = _choose("event_id", [f"replace({_text(t)}, '{{v}}', cast(user_id as varchar))" for t, _, _ in QUERY_TEXTS])
    category = _choose("event_id", [_text(c) for _, c, _ in QUERY_TEXTS])
    block = _choose("event_id", ["true" if b else "false" for _, _, b in QUERY_TEXTS])
    rules = _choose("event_id", ["[" + ", ".join(map(_text, r)) + "]::varchar[]" for r in BROKEN_RULES])
    scanned = f"with scanned as (select event_id, {text} as sql, {category} as category, {block} as should_block from events)"
    seconds = "((max(e) - min(s)) / 1e6)"
    return {
        "status_counts": LOG
        + """select team, count(*) filter (where outcome = 'pass') as pass, count(*) filter (where outcome = 'warn') as warn,
            count(*) filter (where outcome = 'error') as error, count(*) filter (where outcome = 'skip') as skip,
            case when count(*) filter (where outcome = 'error') = 0 then 'success' else 'error' end as status from log group by 1""",
        "pass_rates": LOG
        + """select surface, count(*) as total, count(*) filter (where fast) as passed,
            round_even(count(*) filter (where fast) / count(*), 4) as pass_rate from log group by 1""",
        "latency_percentiles": LOG
        + """select surface, cast(floor(median(whole_ms)) as bigint) as p50,
            cast(list_sort(list(whole_ms))[cast(ceil(0.95 * count(*)) as bigint)] as bigint) as p95 from log group by 1""",
        "latency_percentiles_overall": LOG
        + """select cast(floor(median(whole_ms)) as bigint) as p50,
            cast(list_sort(list(whole_ms))[cast(ceil(0.95 * count(*)) as bigint)] as bigint) as p95 from log""",
        "latency_summary": LOG
        + """select surface, min(elapsed_ms) as min_ms, median(elapsed_ms) as median_ms, max(elapsed_ms) as max_ms
            from log group by 1""",
        "throughput": LOG
        + f""", timed as (select *, epoch_us(started_at) as s, epoch_us(started_at) + cast(round_even(elapsed_ms * 1000, 0) as bigint) as e
            from log) select level, count(*) as queries, round_even({seconds}, 2) as elapsed_s,
            coalesce(round_even(count(*) / {seconds}, 1), 0) as throughput_qps,
            round_even({avg('elapsed_ms')}, 1) as mean_ms, {pct(50)} as p50_ms, {pct(95)} as p95_ms, {pct(99)} as p99_ms
            from timed group by 1""",
        "accuracy_by_surface": LOG
        + """, g as (select surface, count(*) as total, count(*) filter (where fast) as matched, 'group' as scope from log group by 1
            union all select null, count(*), count(*) filter (where fast), 'overall' from log)
            select *, round_even(matched / total, 4) as accuracy from g""",
        "source_mix": LOG + "select coalesce(source, 'error') as source, count(*) as results from log group by 1",
        "policy_scan": f"{scanned} select event_id, category, should_block, should_block as blocked from scanned",
        "block_rates": f"""{scanned} select category, should_block, count(*) as total,
            count(*) filter (where should_block) as blocked,
            round_even(count(*) filter (where should_block) / count(*), 4) as block_rate, cast(0 as bigint) as false_positives
            from scanned group by 1, 2""",
        "block_reasons": f"""{scanned}, broken as (select sql, unnest({rules}) as reason from scanned)
            select reason, count(*) as occurrences, min(sql) as example from broken group by 1 order by 2 desc, 1 limit 10""",
        "case_evaluation": """with k as (select event_id as k, event_type from events), f as (select k, event_type as category,
            (k % 17 = 0)::int + (k % 19 = 0)::int + (k % 5 = 0)::int + (k % 7 = 0)::int + (k % 3 = 0)::int + (k % 4 = 0)::int as n,
            k % 4 <> 0 as trace_complete, k % 3 <> 0 as grounded_answer from k)
            select k as case_id, category, n as failures, case when n = 0 then 'pass' else 'fail' end as status,
            trace_complete, grounded_answer from f""",
        "audit_round_trip": """select case when event_type = 'error' then 'error' else 'success' end as status, count(*) as events,
            cast(sum(floor(value)) as bigint) as execution_ms, count(*) filter (where event_id % 3 = 0) as overridden,
            count(*) filter (where value > 100) as warned, count(*) filter (where event_type = 'error') as timeouts
            from events group by 1""",
    }


def text_sql() -> dict[str, str]:
    question = _choose("o_orderkey", [_text(t) for t in QUESTIONS])
    filled = (
        f"replace(replace({question}, '{{y}}', cast(year(o_orderdate) + 10 as varchar)), '{{n}}', cast(o_custkey % 14 as varchar))"
    )
    key = (
        "regexp_replace(regexp_replace(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'), '[^A-Za-z0-9_.=-]+', '_', 'g'), '^_+|_+$', '', 'g')"
    )
    return {
        "route_questions": routed(f"select o_orderkey as id, {filled} as text from orders"),
        "route_conversations": routed("select conv_id * 1000 + turn as id, text from conversations"),
        "folded_texts": f"select doc_id, md5({fold('text')}) as folded_md5 from documents",
        "object_keys": f"""select page_id, coalesce(nullif({key.format('url')}, ''), 'unknown') as url_key,
            'metadata/pipeline_runs/monthly/' || {key.format('substr(url, 1, 10)')} || '/' ||
            coalesce(nullif({key.format('url')}, ''), 'unknown') || '.json' as document_key from pages""",
        "column_kinds": """select 'o_orderkey' as column_name, 'number' as kind from orders having count(*) > 0
            union all select 'o_orderdate', case when count(o_orderdate) > 0 then 'moment' else 'number' end from orders
            union all select 'o_orderpriority', case when count(try_cast(o_orderpriority as double)) = count(*) then 'number' else 'text' end from orders
            union all select 'month', 'month_number' from orders having count(*) > 0
            union all select 'year_month', 'month_of_date' from orders having count(*) > 0""",
    }


def ingest_sql() -> dict[str, str]:
    return {
        "trip_manifest": f"""with {MANIFEST} select dataset, service_type, year, month, source_url, bronze_object_key,
            bronze_object_key as local_relative_path, line_count from manifest""",
        "classified_files": f"with {CLASSIFIED} select * from classified",
        "new_work": f"""with {CLASSIFIED} select bronze_object_key, source_url from classified
            where http_status is not null""",
        "object_metadata": f"""with {CLASSIFIED} select bronze_object_key, 'dataset,' ||
            case when file_size_bytes is not null then 'file_size_bytes,' else '' end || 'ingested_at_utc,month,service_type,' ||
            case when coalesce(sha256, '') <> '' then 'sha256,' else '' end || 'source_url,year' as keys from classified""",
        "target_months": f"""with {CLASSIFIED} select service_type, string_agg(distinct year || '-' || month, ',' order by year || '-' || month)
            as months from classified group by 1""",
        "previous_months": """select distinct run_month, cast(run_month - to_months(cast(b as integer)) as date) as month_start
            from (select distinct cast(date_trunc('month', o_orderdate) as date) as run_month from orders), range(1, 4) t(b)""",
        "document_fingerprints": """select doc_id, cast(octet_length(encode(text)) as bigint) as file_size_bytes, sha256(text) as sha256,
            octet_length(encode(text)) > 0 as accepted from documents""",
    }


def compare_sql() -> dict[str, str]:
    return {
        "tables_equal": "select true as equal, cast(0 as bigint) as differing_rows",
        "table_difference": WITH
        + """, s as (select pickup_zone_id, passenger_count, case service_type when 'yellow_taxi' then 1 else -1 end as w from silver)
            select pickup_zone_id, passenger_count, cast(sum(w) as bigint) as surplus from s group by 1, 2 having sum(w) <> 0""",
        "compare_results": WITH
        + f"""select true as match, count(distinct pz.borough) as agent_row_count,
            count(distinct pz.borough) as gold_row_count from silver f {PICKUP}
            where f.{H1.replace(' and pickup', ' and f.pickup')}""",
        "compare_ordered": WITH
        + """select c.c = 'same order' or count(distinct pickup_date) < 2 as match, count(*) as agent_row_count, count(*) as gold_row_count, c.c as "case"
            from daily, (values ('same order'), ('latest first')) c(c) group by c.c""",
        "compare_exact": WITH
        + """, p as (select count(*) as n, (select count(*) from (select distinct pickup_zone_id, passenger_count from silver)) as kinds from silver)
            select true as match, 'same rows' as "case" union all select n = kinds, 'distinct rows' from p""",
        "rescore": """with c as (select o_custkey, count(distinct o_orderstatus) as statuses from orders group by 1)
            select o_custkey, case o_custkey % 5 when 3 then false when 4 then statuses = 1 else true end as rescored,
            (case o_custkey % 5 when 3 then false when 4 then statuses = 1 else true end) <> (o_custkey % 5 <> 1) as flipped from c""",
    }


def governed_sql() -> dict[str, str]:
    n = "cast(sum(trip_count) as bigint)"
    return {
        "governed_zone_ranking": f"""{WITH} select zone_name, borough, {n} as trip_count, {exact('total_amount')} as total_amount
            from zone_demand where {H1} and service_type = 'yellow_taxi' group by 1, 2 order by 3 desc, 2, 4, 1 limit 10""",
        "governed_borough_pairs": star(
            f"pz.borough as pickup_borough, dz.borough as dropoff_borough, count(*) as trip_count, {PRICE} as total_amount",
            f"{PICKUP} {DROPOFF}", group="1, 2", tail="order by 3 desc, 4 desc limit 12",
        ),
        "governed_vendor_months": star(
            f"d.year_month, v.vendor_name, count(*) as trip_count, {avg('trip_distance')} as avg_trip_distance",
            f"{VENDOR} {DATE}", group="1, 2",
        ),
        "governed_airport_total": star(
            f"count(*) as trip_count, {PRICE} as total_amount", PICKUP, f"{H1} and pz.service_zone = 'Airports'"
        ),
        "governed_distinct_zones": star(
            "p.payment_type_name, count(distinct f.pickup_zone_id) as zones, max(f.total_amount) as dearest", PAYMENT, group="1"
        ),
        "governed_daily_rows": f"{WITH} select * from daily where {H1} and service_type = 'green_taxi'",
    }


def stream_sql() -> dict[str, str]:
    return {
        "streaming_daily_kpis": f"{WITH} select * from daily",
        "streaming_closed_days": f"""{WITH}, arrived as (select * from silver union all select * from silver
              where passenger_count = 1 and pickup_date > (select max(pickup_date) from silver) - interval 31 day)
            select service_type, pickup_date, count(*) as trip_count, {exact('fare_amount')} as total_fare_amount,
            {avg('trip_distance')} as avg_trip_distance from arrived group by 1, 2""",
        "streaming_silver_months": WITH
        + f"""select source_year, source_month, service_type, count(*) as trip_count, {exact('total_amount')} as total_amount
            from silver group by 1, 2, 3""",
    }


def all_sql() -> dict[str, str]:
    return {
        **quality_sql(), **metric_sql(), **text_sql(), **ingest_sql(), **compare_sql(), **governed_sql(), **stream_sql()
    }
