import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from fareloom.functions.dates import DateWindow, month_start_with_lag, previous_month_starts
from fareloom.functions.text import fold_text, key_part, run_document_key
from fareloom.operators import compare, ingest, matching, metrics, quality, ranking, selection, typing
from fareloom.plans.catalog import gold_catalog, load_catalog, name_differences
from fareloom.sources import documents, sinks


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


# Dates and text


def test_month_arithmetic(spark):
    days = column(spark, [date(2026, 4, 24), date(2026, 1, 1)], "date")
    assert [r[0] for r in days.select(month_start_with_lag(F.col("v"), 2)).collect()] == [date(2026, 2, 1), date(2025, 11, 1)]
    row = column(spark, [date(2026, 4, 15)], "date").select(previous_month_starts(F.col("v"), 3)).first()[0]
    assert row == [date(2026, 1, 1), date(2026, 2, 1), date(2026, 3, 1)]
    with pytest.raises(ValueError):
        month_start_with_lag(F.col("v"), -1)
    with pytest.raises(ValueError):
        previous_month_starts(F.col("v"), 0)


def test_windows_roll_over_december():
    assert DateWindow.month(2024, 12).end == date(2025, 1, 1)
    assert DateWindow.first_half(2024).end == date(2024, 7, 1)


def test_folding(spark):
    texts = ["  Số chuyến ĐÓN ", "ﬁne ½ Ⅳ", "Ä‘i", "Ä", "日本 x"]
    got = [r[0] for r in column(spark, texts).select(fold_text(F.col("v"))).collect()]
    # A fraction slash is not ASCII, so one half folds to its two digits.
    assert got == ["so chuyen don", "fine 12 iv", "di", "a", "x"]


def test_folding_equals_unicode_decomposition_for_every_character(spark):
    import unicodedata

    blocks = ["".join(chr(c) for c in range(a, a + 256) if not 0xD800 <= c <= 0xDFFF) for a in range(0, 0x30000, 256)]
    texts = [b for b in blocks if b] + ["a Ä\u0090 b", "Ä‘Ä", "plain ASCII  "]

    def folded(text):
        text = text.replace("đ", "d").replace("Đ", "D").replace("Ä‘", "d").replace("Ä\u0090", "D")
        return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii").lower().strip()

    rows = column(spark, texts).select("v", fold_text(F.col("v")).alias("f")).collect()
    assert [r.v for r in rows if r.f != folded(r.v)] == []


def test_keys(spark):
    got = [r[0] for r in column(spark, [" a b/c ", "__", "x=1.y-z"]).select(key_part(F.col("v"))).collect()]
    assert got == ["a_b_c", "unknown", "x=1.y-z"]
    row = spark.range(1).select(
        run_document_key(F.lit("job"), F.lit("manual__2024+x"), F.lit("2024-01-05T00:00")).alias("a"),
        run_document_key(F.lit("job"), F.lit("r"), F.lit(None).cast("string")).alias("b"),
    ).first()
    assert row.a == "metadata/pipeline_runs/job/2024-01-05/manual__2024_x.json"
    assert row.b == "metadata/pipeline_runs/job/r.json"


# Ingestion


def manifest(spark, months, base="https://example.org"):
    starts = column(spark, months, "date").withColumnRenamed("v", "month_start")
    return ingest.trip_manifest(starts, "month_start", base)


def test_manifest_keys(spark):
    rows = {r.dataset: r for r in manifest(spark, [date(2024, 3, 1)]).collect()}
    assert rows["yellow"].source_url == "https://example.org/trip-data/yellow_tripdata_2024-03.parquet"
    assert rows["green"].bronze_object_key == "bronze/green_taxi/year=2024/month=03/green_tripdata_2024-03.parquet"
    lookup = ingest.lookup_manifest(spark, "https://example.org").first()
    assert lookup.year is None and lookup.source_url.endswith("/misc/taxi_zone_lookup.csv")


def classified(spark, listing_rows, fetched_rows, month=date(2024, 1, 1), checked=date(2024, 5, 1)):
    m = manifest(spark, [month]).where("dataset = 'yellow'")
    listing = spark.createDataFrame(listing_rows, "bronze_object_key string, content_length long, metadata map<string,string>")
    fetched = spark.createDataFrame(fetched_rows, "source_url string, http_status int, file_size_bytes long, sha256 string")
    return ingest.classify(m, listing, fetched, F.lit(checked)).first()


KEY = "bronze/yellow_taxi/year=2024/month=01/yellow_tripdata_2024-01.parquet"
URL = "https://example.org/trip-data/yellow_tripdata_2024-01.parquet"


@pytest.mark.parametrize(
    ("noted", "status"),
    [
        ({"file_size_bytes": "10", "sha256": "x", "source_url": URL}, "skipped_existing_verified"),
        ({}, "skipped_existing_unverified"),
        ({"sha256": "x"}, "skipped_existing_unverified"),
        ({"file_size_bytes": "11", "sha256": "x"}, "failed_existing_metadata_mismatch"),
        ({"source_url": "https://elsewhere"}, "failed_existing_metadata_mismatch"),
    ],
)
def test_existing_objects(spark, noted, status):
    row = classified(spark, [(KEY, 10, noted)], [])
    assert row.status == status and row.file_size_bytes == "10"


@pytest.mark.parametrize(
    ("checked", "code", "status"),
    [
        (date(2024, 5, 1), 404, "failed_source_missing_historical"),
        (date(2024, 4, 30), 404, "skipped_source_unavailable_recent"),
        (date(2024, 5, 1), 403, "failed_source_missing_historical"),
        (date(2024, 5, 1), 200, "uploaded"),
        (date(2024, 5, 1), 500, "failed_source_error"),
    ],
)
def test_missing_objects(spark, checked, code, status):
    assert classified(spark, [], [(URL, code, 5, "s")], checked=checked).status == status


def test_empty_file_is_refused_and_lookup_is_never_historical(spark):
    assert classified(spark, [], [(URL, 200, 0, "s")]).status == "failed_empty_file"
    m = ingest.lookup_manifest(spark, "https://example.org")
    listing = spark.createDataFrame([], "bronze_object_key string, content_length long, metadata map<string,string>")
    fetched = spark.createDataFrame(
        [("https://example.org/misc/taxi_zone_lookup.csv", 404, None, None)],
        "source_url string, http_status int, file_size_bytes long, sha256 string",
    )
    assert ingest.classify(m, listing, fetched, F.lit(date(2030, 1, 1))).first().status == "skipped_source_unavailable_recent"


def test_file_fingerprints_and_listing(spark, tmp_path):
    import hashlib

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"abc" * 700_000)
    (tmp_path / "empty.bin").write_bytes(b"")
    prints = ingest.file_fingerprints(spark, str(tmp_path))
    rows = {r.path.rsplit("/", 1)[1]: r for r in prints.collect()}
    assert rows["x.bin"].sha256 == hashlib.sha256(b"abc" * 700_000).hexdigest()
    assert rows["x.bin"].file_size_bytes == 2_100_000 and rows["x.bin"].accepted
    expected = spark.createDataFrame([(f"file:{tmp_path}/{n}",) for n in ("a/x.bin", "empty.bin")], "path string")
    assert [r.path.rsplit("/", 1)[1] for r in ingest.refused_files(expected, prints).collect()] == ["empty.bin"]
    notes = spark.createDataFrame([("a/x.bin", {"sha256": "s"})], "bronze_object_key string, metadata map<string,string>")
    listed = {r.bronze_object_key: r for r in ingest.object_listing(spark, str(tmp_path), notes).collect()}
    assert listed["a/x.bin"].content_length == 2_100_000 and listed["a/x.bin"].metadata == {"sha256": "s"}
    assert set(listed) == {"a/x.bin"}


# Gate and run documents


def layers(spark, **counts):
    full = {"pass": 1, "warn": 0, "error": 0, "skip": 0, **counts}
    return spark.createDataFrame(
        [("silver", "success", tuple(full.values()))], "layer string, status string, counts struct<pass:long,warn:long,error:long,skip:long>"
    )


def ingestion(spark, *statuses):
    return spark.createDataFrame(
        [("yellow", s, URL, KEY, "2024", "01", "10", "sha") for s in statuses],
        "dataset string, status string, source_url string, bronze_object_key string, year string, month string, file_size_bytes string, sha256 string",
    )


@pytest.mark.parametrize(
    ("statuses", "counts", "gate"),
    [
        (["uploaded"], {}, "passed"),
        (["uploaded"], {"warn": 2}, "passed_with_warnings"),
        (["uploaded"], {"error": 1, "warn": 1}, "failed_blocking"),
        (["uploaded", "failed_source_missing_historical"], {}, "failed_blocking"),
        (["failed_existing_metadata_mismatch"], {"warn": 1}, "failed_blocking"),
        (["skipped_source_unavailable_recent"], {}, "passed"),
    ],
)
def test_gate(spark, statuses, counts, gate):
    row = quality.quality_gate(ingestion(spark, *statuses), layers(spark, **counts)).first()
    assert row.status == gate
    assert len(row.blocking_ingestion_statuses) == sum(s in quality.BLOCKING_STATUSES for s in statuses)


def test_run_document_round_trip(spark, tmp_path):
    doc = quality.run_summary(
        ingestion(spark, "uploaded", "skipped_existing_verified"), layers(spark, warn=1), job="job", run_id="run/1",
        run_mode="manual", logical_date="2024-02-01T00:00", created_at_utc="2024-02-01T00:00:00+00:00",
    )
    key = sinks.write_run_document(doc, str(tmp_path))
    assert key == "metadata/pipeline_runs/job/2024-02-01/run_1.json"
    docs = documents.read_run_documents(spark, str(tmp_path), "job").where("file_name not like '_SUCCESS%'")
    found = documents.find_run(docs, "run/1")
    checked = quality.validate_summaries(found, "doc", F.lit("run/1"), F.lit("job")).first()
    assert sinks.document_metadata(doc).first().metadata == {
        "dag_id": "job", "run_id": "run/1", "quality_gate": "passed_with_warnings"
    }
    assert checked.failures == []
    body = json.loads(checked.doc)
    assert body["target_months"] == ["2024-01"] and body["quality_gate"]["status"] == "passed_with_warnings"
    newest = documents.latest_documents(docs, F.get_json_object("doc", "$.run_id")).collect()
    assert [r.key for r in newest] == ["run/1"]


def test_flawed_run_documents_are_explained(spark):
    good = {
        "schema_version": "1.0", "dag_id": "job", "run_id": "r", "run_mode": "manual", "target_months": ["2024-01"],
        "ingestion_results": [{"dataset": "y", "status": "uploaded", "source_url": "u", "object_key": "k", "checksum_sha256": "s", "size_bytes": 3}],
        "dbt_results": [{"layer": "silver"}],
        "quality_gate": {"status": "passed", "dbt_counts": {"pass": 1, "warn": 0, "error": 0, "skip": 0}, "blocking_ingestion_statuses": []},
        "created_at_utc": "t",
    }
    bad_item = {"dataset": "", "status": "skipped_existing_verified", "source_url": "u"}
    cases = [
        (good, []),
        ({**good, "dag_id": "other"}, ["Expected dag_id=job, found other"]),
        ({**good, "run_mode": "x", "target_months": []}, ["run_mode must be manual or scheduled", "target_months must be a non-empty list"]),
        ({**good, "ingestion_results": {}}, ["ingestion_results must be a non-empty list"]),
        (
            {**good, "ingestion_results": [good["ingestion_results"][0], bad_item]},
            [
                "ingestion_results[1] missing dataset", "ingestion_results[1] missing bronze_object_key/object_key",
                "ingestion_results[1] missing checksum for verified/uploaded object",
                "ingestion_results[1] missing file size for verified/uploaded object",
            ],
        ),
        ({**good, "ingestion_results": [{"dataset": "y", "status": "skipped_source_unavailable_recent", "source_url": "u"}]}, []),
        ({**good, "dbt_results": []}, ["dbt_results must be a non-empty list"]),
        ({**good, "quality_gate": "passed"}, ["quality_gate must be an object"]),
        (
            {**good, "quality_gate": {"status": "odd", "dbt_counts": {"pass": 1}}},
            [
                "quality_gate missing fields: blocking_ingestion_statuses", "quality_gate.status has an unexpected value",
                "quality_gate.dbt_counts missing: error, skip, warn",
            ],
        ),
        ({k: v for k, v in good.items() if k not in ("created_at_utc", "run_mode")},
         ["Missing top-level fields: created_at_utc, run_mode", "run_mode must be manual or scheduled"]),
    ]
    docs = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(cases)], "i int, doc string")
    got = {r.i: r.failures for r in quality.validate_summaries(docs, "doc", F.lit("r"), F.lit("job")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_status_words(spark, tmp_path):
    path = tmp_path / "results.json"
    path.write_text(json.dumps({"metadata": {"invocation_id": "i"}, "results": [{"status": s} for s in ("success", "warn", "error", "skipped", "odd", "FAIL")]}))
    row = quality.status_counts(documents.read_run_results(spark, str(path))).first()
    assert (row["pass"], row["warn"], row["error"], row["skip"], row["status"]) == (1, 1, 3, 1, "error")


# Checks


def test_quality_report_finds_planted_faults(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (3, "b"), (3, "z"), (None, None)], "pid int, tag string")
    checks = (
        quality.TableChecks("parent", ("id",), ("id",)),
        quality.TableChecks("child", ("tag",), (), (("tag", ("a", "b")),), (("pid", "parent", "id"),), not_empty=True),
    )
    rows = {(r.table_name, r.check_name): r for r in quality.quality_report({"parent": parent, "child": child}, checks).collect()}
    assert rows["parent", "unique"].failures == 1 and rows["parent", "not_null"].status == "pass"
    assert rows["child", "not_null"].failures == 1 and rows["child", "accepted_values"].failures == 1
    assert rows["child", "relationships"].failures == 2 and rows["child", "relationships"].status == "error"
    assert rows["child", "not_empty"].status == "pass"
    assert quality.is_empty(parent.where("id > 9")).first()[0] == 1


def test_keys_of_all_tables_meet_in_one_pass(spark, tmp_path):
    ids = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.5), (2, None, None), (None, None, 1.0)], "id int, code string, size double")
    uses = spark.createDataFrame([(1, "a", 1), (2, "c", 2), (7, None, None), (7, "c", 1)], "pid long, code string, size int")
    tables = {}
    for name, frame in {"ids": ids, "uses": uses, "nothing": uses.limit(0)}.items():
        frame.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    related = (("pid", "ids", "id"), ("code", "ids", "code"), ("size", "ids", "size"))
    checks = (
        quality.TableChecks("ids", ("id",), ("id", "code", "size")),
        quality.TableChecks("uses", ("code",), ("pid",), related=related),
        quality.TableChecks("nothing", (), ("pid",), related=related, not_empty=True),
    )
    report = quality.quality_report(tables, checks)
    got = {(r.table_name, r.column_name, r.check_name): r.failures for r in report.collect()}
    assert got == {
        ("ids", "id", "not_null"): 1, ("ids", "id", "unique"): 1, ("ids", "code", "unique"): 0, ("ids", "size", "unique"): 1,
        ("uses", "code", "not_null"): 1, ("uses", "pid", "unique"): 1,
        # whole numbers of both widths are compared as one type, and so are 1 and 1.0
        ("uses", "pid", "relationships"): 2, ("uses", "code", "relationships"): 2, ("uses", "size", "relationships"): 1,
        ("nothing", "pid", "unique"): 0, ("nothing", "*", "not_empty"): 1,
        **{("nothing", c, "relationships"): 0 for c in ("pid", "code", "size")},
    }
    scans = report._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    assert scans == 6


def test_planted_faults_fail_their_checks(spark, small):
    import __spark_entry__ as entry

    found = {(r.table_name, r.column_name, r.check_name) for r in entry.queries()["quality_report_planted"](spark, small).where("failures > 0").collect()}
    assert found >= {
        ("fact_trips", "pickup_zone_id", "relationships"), ("fact_trips", "dropoff_zone_id", "relationships"),
        ("fact_trips", "pickup_date", "relationships"), ("gold_zone_demand", "zone_id", "relationships"),
        ("dim_vendor", "vendor_id", "unique"), ("dim_payment_type", "payment_type", "not_null"),
        ("dim_date", "month", "accepted_values"), ("gold_daily_kpis", "*", "anomalies"),
    }


def test_result_warnings(spark):
    df = spark.createDataFrame([(date(2031, 1, 1), -1.0), (date(2020, 1, 1), 2.0)], "d date, amount double")
    got = {r[0] for r in quality.result_warnings(df, 2, ("month",)).collect()}
    assert got == {
        "The result reached the max row limit; increase max rows for more detail.", "`amount` contains negative values.",
        "`d` has an unusual date range: 2020-01-01 to 2031-01-01.", "Expected grouping `month` was not present in the result.",
    }
    assert [r[0] for r in quality.result_warnings(df.limit(0), 5).collect()] == ["The query returned no rows."]


# Order statistics, rates, ranking


def test_exact_percentiles_against_sorting(spark):
    import random

    rng = random.Random(1)
    data = {"hot": [7.25] * 3000 + [rng.uniform(-1e9, 1e9) for _ in range(500)], "one": [5.0], None: [-1.0, 2.0, 3.5, -9.75]}
    rows = [(g, round(v, 2)) for g, vs in data.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ranks = {"p50": selection.nearest_rank(50), "p95": selection.nearest_rank(95), "r95": selection.rounded_rank(95), "max": "n"}
    got = {r.g: r for r in selection.exact_percentiles(df, "v", ranks, ["g"]).collect()}
    for g, values in data.items():
        s = sorted(round(v, 2) for v in values)
        n = len(s)
        assert got[g].p50 == s[max(0, -(-50 * n // 100) - 1)]
        assert got[g].p95 == s[max(0, -(-95 * n // 100) - 1)]
        assert got[g].r95 == s[min(n - 1, int(round(0.95 * (n - 1))))]
        assert got[g].max == s[-1]
    median = selection.exact_median(df.where("g is null"), "v", "m").first().m
    assert median == 0.5


def test_rates_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "surface string, ok boolean")
    row = metrics.accuracy_by(empty, "surface", F.col("ok")).collect()
    assert [(r.scope, r.accuracy) for r in row] == [("overall", 0.0)]


def test_bounds(spark):
    df = spark.range(50).toDF("n")
    assert ranking.bounded(df, 10).count() == 10
    assert ranking.bounded(df, 10, asked=3).count() == 3
    assert ranking.bounded(df, 10, asked=40).count() == 10
    assert ranking.bounded(df, 10, scalar=True).count() == 50
    with pytest.raises(ValueError):
        ranking.bounded(df, 1001)


def test_key_finding_breaks_ties_and_handles_no_metric(spark):
    df = spark.createDataFrame([("b", 5, 1), ("a", 5, 2), ("c", 1, 3)], "zone string, trip_count long, x int")
    row = ranking.key_finding(df).first()
    assert (row.metric, row.highest, row.zone, row.x) == ("trip_count", 5.0, "a", "2")
    assert ranking.key_finding(df.select("zone")).count() == 0


def test_prepared_columns(spark):
    df = spark.createDataFrame(
        [("3", "2024-01-05", "x", "1.5", "2024-03-01"), ("11", "bad", None, "2", "2024-04-01")],
        "month string, pickup_date string, name string, amount string, year_month string",
    )
    out = typing.prepare_result(df)
    assert dict(out.dtypes) == {
        "month": "string", "pickup_date": "timestamp_ntz", "name": "string", "amount": "double", "year_month": "string"
    }
    assert [(r.month, r.year_month) for r in out.collect()] == [("03", "2024-03"), ("11", "2024-04")]


# Comparison


def test_tables_equal_counts_duplicates(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "n int, s string")
    assert compare.tables_equal(a, a).first().equal
    row = compare.tables_equal(a, a.distinct()).first()
    assert not row.equal and row.differing_rows == 1


def match(spark, agent, gold, ordered=False):
    return matching.compare_results(agent, gold, ordered).first().match


def test_result_comparison(spark):
    gold = spark.createDataFrame([("US", 2.0), ("UK", 1.0)], "country string, n double")
    swapped = gold.select(F.col("n").alias("total"), F.col("country").alias("c"))
    noisy = gold.withColumn("n", F.col("n") * (1 + 1e-9))
    assert match(spark, gold, gold) and match(spark, swapped, gold) and match(spark, noisy, gold)
    assert match(spark, gold.withColumn("extra", F.lit(7)), gold)
    assert not match(spark, gold.withColumn("n", F.col("n") + 0.01), gold)
    assert not match(spark, gold.select("country"), gold)
    assert not match(spark, gold.limit(1), gold)
    assert match(spark, gold.orderBy("n"), gold) and not match(spark, gold.orderBy("n"), gold.orderBy(F.desc("n")), True)
    assert match(spark, gold.orderBy("n"), gold.orderBy("n"), True)


def test_exact_comparison(spark):
    gold = spark.createDataFrame([("US", 2), ("UK", 1)], "country string, n int")

    def same(a, b, ordered=False):
        return matching.results_identical(a, b, ordered).first().match

    assert same(gold, gold) and same(gold.orderBy("n"), gold)
    assert not same(gold.select("n", "country"), gold) and not same(gold.select("country"), gold)
    assert same(gold.orderBy("n"), gold.orderBy("n"), True) and not same(gold.orderBy(F.desc("n")), gold.orderBy("n"), True)


def test_wide_results_match_by_content(spark):
    gold = spark.createDataFrame([(1, 2)], "a int, b int")
    wide = gold.select("*", *[F.lit(i).alias(f"c{i}") for i in range(8)])
    assert match(spark, wide, gold)
    assert match(spark, wide.withColumnRenamed("a", "z"), gold)
    assert not match(spark, wide.drop("a", "c1"), gold)


def test_close_rows_are_matched_even_when_sorting_would_mislead(spark):
    agent = spark.createDataFrame([(1.0, 9.0), (1.0000000001, 5.0)], "x double, y double")
    gold = spark.createDataFrame([(1.0, 5.0), (1.0000000001, 9.0)], "x double, y double")
    assert match(spark, agent, gold)


def test_large_results_with_many_columns(spark):
    rows = spark.range(100_000)
    gold = rows.select(*[(F.col("id") * (i + 1) % 977 + F.lit(i) / 7).alias(f"n{i}") for i in range(10)], F.lit("same").alias("t"), F.col("id").cast("string").alias("k"))
    noisy = gold.select(*[F.col(c) if c in "tk" else (F.col(c) * (1 + 3e-8)).alias(c) for c in reversed(gold.columns)])
    assert match(spark, noisy, gold)
    assert not match(spark, noisy.withColumn("n3", F.when(F.col("k") == "777", -1.0).otherwise(F.col("n3"))), gold)
    equal = spark.range(100_000).select(*[F.lit(i).alias(f"c{i}") for i in range(12)])
    assert match(spark, equal, equal) and not match(spark, equal.limit(99_999), equal)


def test_odd_numbers_nulls_and_types_in_comparison(spark):
    odd = spark.createDataFrame([(float("nan"), None, "a"), (float("inf"), None, None), (None, None, ""), (-0.0, None, "a")], "x double, none int, s string")
    noisy = odd.select("s", F.col("none").cast("string").alias("z"), F.col("x") + 1e-9)
    assert match(spark, noisy, odd) and matching.results_identical(odd, odd).first().match
    assert not match(spark, odd.withColumn("x", F.when(F.col("x") == float("inf"), 5.0).otherwise(F.col("x"))), odd)
    assert match(spark, odd.limit(0), odd.limit(0)) and not match(spark, odd.limit(0).select("x"), odd.limit(0))
    one = spark.createDataFrame([(1,)], "n int")
    assert not matching.results_identical(one, one.select(F.col("n").cast("string"))).first().match


def test_close_rows_in_several_rounds(spark):
    agent = spark.createDataFrame([(x,) for x in (1.0, 1.0, 1.0000004, 1.0000009)], "x double")
    gold = spark.createDataFrame([(x,) for x in (1.0000001, 1.0000001, 1.0000005, 1.0000008)], "x double")
    assert match(spark, agent, gold)
    assert not match(spark, agent, gold.where("x < 1.0000003").union(gold.where("x < 1.0000003")).withColumn("x", F.col("x") - 1e-5))
    twice = agent.select("x", F.col("x").alias("y"))
    assert match(spark, twice, gold.select("x", F.col("x").alias("y")))


def test_query_verification(spark):
    named = {
        "good": lambda: spark.range(1),
        "none": lambda: spark.range(0),
        "bad": lambda: spark.sql("select nope from nothing"),
    }
    got = {r["query"]: r.outcome for r in compare.verify_queries(spark, named).collect()}
    assert got == {"good": "ran", "none": "empty", "bad": "failed"}


# Catalog and sinks


def test_catalog_files_and_defaults(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps({"tables": [{"name": "t", "fields": [{"name": "a"}]}]}))
    table = load_catalog(path).get("t")
    assert table.table_type == "aggregate_mart" and not table.execution_enabled and table.columns == {"a"}
    assert load_catalog(path).enabled().names() == []
    frame = gold_catalog().to_frame(spark)
    assert frame.count() == 8 and frame.select(F.explode("allowed_joins")).count() == 6


def test_catalog_name_differences(spark):
    models = spark.createDataFrame([("a",), ("b",)], "name string")
    cataloged = spark.createDataFrame([("b",), ("c",)], "name string")
    got = {(r.name, r.missing_from) for r in name_differences(models, cataloged).collect()}
    assert got == {("a", "catalog"), ("c", "models")}


def test_exports_and_serving_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "n int, s string")
    assert sinks.export(df, str(tmp_path), "report") == 2
    assert spark.read.csv(f"{tmp_path}/report.csv", header=True).count() == 2
    assert sinks.build_serving_tables({"one": df, "two": df.limit(1)}, str(tmp_path / "serve")) == {"one": 2, "two": 1}
    assert sinks.build_serving_tables({"one": df.limit(1)}, str(tmp_path / "serve")) == {"one": 1}


def test_serving_tables_are_replaced_behind_their_names(spark, tmp_path):
    root = str(tmp_path / "it's here")
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, tag string")
    assert sinks.serve_tables(spark, {"one": df, "two": df.limit(0)}, "bi_test", root) == {"one": 2, "two": 0}
    before = spark.table("bi_test.one")
    assert sinks.serve_tables(spark, {"one": df.where("id = 2")}, "bi_test", root) == {"one": 1}
    assert [tuple(r) for r in spark.sql("select * from bi_test.one").collect()] == [(2, None)]
    # what was resolved before goes on with the rows it found, and the other table is as it was
    assert before.count() == 2 and spark.table("bi_test.two").count() == 0
    sinks.serve_tables(spark, {"one": df.select(F.col("id").cast("long").alias("key"))}, "bi_test", root)
    assert spark.table("bi_test.one").dtypes == [("key", "bigint")] and spark.table("bi_test.one").count() == 2
    broken = df.select(F.raise_error(F.lit("no rows today")).cast("long").alias("key"))
    with pytest.raises(Exception, match="no rows today"):
        sinks.serve_tables(spark, {"one": broken}, "bi_test", root)
    assert spark.table("bi_test.one").count() == 2
    spark.sql("drop database bi_test cascade")


def test_small_and_large_files_have_the_same_fingerprints(spark, tmp_path):
    for i, size in enumerate((1, 1000, 3 << 20)):
        (tmp_path / f"f{i}.bin").write_bytes(bytes(range(256)) * (size // 256) + b"x" * (size % 256))
    want = {(f"f{i}.bin", p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for i, p in enumerate(sorted(tmp_path.glob("*.bin")))}
    for bound in (0, 1000, 1 << 30):
        found = ingest.file_fingerprints(spark, str(tmp_path), bound)
        assert {(r.path.rsplit("/", 1)[1], r.file_size_bytes, r.sha256) for r in found.collect()} == want
    plan = ingest.file_fingerprints(spark, str(tmp_path), 1000)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,1000)" in plan and "GreaterThan(length,1000)" in plan


def test_audit_keeps_no_result_rows_and_never_fails_the_query(spark, tmp_path):
    asked = spark.createDataFrame([("t", "success", "q", 5, [1, 2])], "timestamp string, status string, question string, execution_ms long, rows array<int>")
    assert sinks.append_audit(asked, f"{tmp_path}/audit") and sinks.append_audit(asked, f"{tmp_path}/audit")
    events = documents.read_audit_log(spark, f"{tmp_path}/audit")
    assert events.count() == 2 and "rows" not in events.columns and events.first().warnings == []
    blocked = tmp_path / "file"
    blocked.write_text("x")
    assert not sinks.append_audit(asked, f"{blocked}/audit")


def test_text_that_looks_like_a_number_is_text(spark):
    from fareloom.operators.matching import compare_results

    left = spark.createDataFrame([("01", 1.0)], "code string, amount double")
    same = left.select("code", (F.col("amount") + 1e-9).alias("amount"))
    other = spark.createDataFrame([("1", 1.0)], "code string, amount double")
    assert compare_results(left, same).first()[0] is True
    assert compare_results(left, other).first()[0] is False


def test_emptied_partitions_go(spark, tmp_path):
    from fareloom.workspace import replace_partitions

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b"), (2024, 3, "c")], "y int, m int, v string")
    rows.write.partitionBy("y", "m").parquet(path)
    replace_partitions(rows.where("m = 2").withColumn("v", F.lit("new")), path, ("y", "m"), [(2024, 1), (2024, 2)])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["c", "new"]


def test_rescoring_by_symbols(spark):
    from fareloom.operators.rescoring import rescore

    two = [["a", "1"], ["b", "2"]]
    cases = [
        (1, [["1.0000000001", "a"], ["2", "b"]], two, "select", True),  # columns swapped, noise
        (2, [["x", "b", "2"], ["y", "a", "1"]], two, "select", True),  # an extra column, other order
        (3, [["b", "2"], ["a", "1"]], two, "select x order by 1 limit 5", False),  # order counts
        (4, [["a", "2"], ["b", "1"]], two, "select", False),  # right columns, wrong rows
        (5, [["a", "1"]], two, "select", False),
        (6, [], [], "select", True),
        (7, [["1", "1", "2"], ["2", "1", "1"], ["3", "2", "1"]], [["1", "2"], ["1", "1"], ["2", "1"]], "select", True),  # look-alikes
        (8, [["1", "1"], ["2", "2"]], [["1", "1"], ["2", "2"]], "select", True),
        (9, [["1", "9"], ["2", "9"]], [["1", "1"], ["2", "2"]], "select", False),
        (10, [["a", None]], [["a", ""]], "select", False),
        (11, [["a", "1.001"]], [["a", "1"]], "select", False),
    ]
    rows = [(n, a, [f"c{i}" for i in range(max(map(len, a), default=2))], g, [f"d{i}" for i in range(max(map(len, g), default=2))], s, True) for n, a, g, s, _ in cases]
    saved = spark.createDataFrame(rows, "n int, agent_rows array<array<string>>, agent_cols array<string>, gold_rows array<array<string>>, gold_cols array<string>, gold_sql string, match boolean")
    got = {r.n: (r.rescored, r.flipped) for r in rescore(saved).collect()}
    assert got == {n: (want, not want) for n, *_, want in cases}


def test_shuffled_look_alike_columns_need_few_comparisons(spark):
    rows = spark.range(60)
    gold = rows.select(*[((F.col("id") * (2 * i + 7) + i) % 60).cast("double").alias(f"c{i}") for i in (0, 3, 5, 8, 11)])
    turned = gold.select(*[F.col(c).alias(f"x{i}") for i, c in enumerate(reversed(gold.columns))])
    assert match(spark, turned, gold)
    assert not match(spark, turned.withColumn("x2", (F.col("x2") + 1) % 60), gold)


def test_numbers_and_truth_values_of_different_types(spark):
    from fareloom.operators.matching import compare_results, results_identical

    def one(text):
        return spark.sql(f"select {text} as v")

    same = lambda a, b: results_identical(one(a), one(b)).first()[0]
    assert same("1", "1.0D") and same("1.00BD", "1") and same("1.50BD", "1.5D") and same("cast(1 as tinyint)", "1L") and same("-0.0D", "0")
    assert not same("9007199254740993L", "9007199254740992L") and not same("1", "'1'") and not same("true", "'true'") and not same("true", "1")
    assert same("1e-30D", "1e-30D") and not same("1e-30D", "0") and same("100.0D", "100") and not same("100", "1")
    assert same("cast('NaN' as double)", "cast('NaN' as double)") and not same("cast('NaN' as double)", "cast('Infinity' as double)")
    assert same("cast(null as int)", "cast(null as double)")
    close = lambda a, b: compare_results(one(a), one(b)).first().match
    assert not close("true", "'true'") and close("true", "true") and not close("true", "false") and close("1", "1.0D")
