"""Sums of doubles: next to the exact sum, whatever the order of rows and the partial sums they pass through."""

import io
import math
import random
import struct
import sys
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from fareloom.functions.numbers import exact_mean, exact_sum, merged_state, state_value, sum_state
from fareloom.operators import gold, selection
from fareloom.operators.selection import MEDIAN_HIGH, MEDIAN_LOW, exact_median, exact_percentiles
from fareloom.operators.star import mean, star_rollup, total


def frame(spark, values):
    return spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "k int, x double").repartition(5)


@pytest.mark.parametrize(
    "draw",
    [
        lambda r: round(r.uniform(-500, 500), 2),
        lambda r: r.uniform(0, 1) * r.uniform(0, 1),
        lambda r: r.choice([1e9, -1e9]) + r.random(),
        lambda r: r.choice([-1, 1]) * r.random() * 2.0 ** r.randint(-16, 40),
    ],
)
def test_sum_equals_the_exact_sum_in_any_order(spark, draw):
    rand = random.Random(4)
    values = [draw(rand) for _ in range(3000)] + [None]
    df = frame(spark, values)
    want = math.fsum(v for v in values if v is not None)
    assert df.agg(exact_sum(F.col("x"))).first()[0] == want
    halves = df.groupBy("k").agg(sum_state(F.col("x")).alias("s"))
    assert halves.agg(state_value(merged_state("s"))).first()[0] == want
    assert df.agg(exact_mean(F.col("x"))).first()[0] == want / 3000


def test_small_amounts_are_not_rounded_away(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert tuple(df.agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first()) == (4.0, 0.004)
    assert spark.range(10).select(F.lit(1e-30).alias("x")).agg(exact_sum(F.col("x"))).first()[0] == pytest.approx(1e-29)


def test_values_beyond_the_limbs(spark):
    total_of = lambda *v: spark.createDataFrame([(x,) for x in v], "x double").agg(exact_sum(F.col("x"))).first()[0]
    assert math.isnan(total_of(1.0, math.nan)) and math.isnan(total_of(math.inf, -math.inf))
    assert total_of(1.0, math.inf) == math.inf and total_of(1e300, 1.0) == 1e300
    assert total_of(2.0**60, 0.5, -(2.0**60)) == 0.5
    assert total_of(None, None) is None and total_of() is None and total_of(-0.25, -0.5) == -0.75


def test_rollup_and_mart_take_a_nan_fare(spark):
    rows = [("a", 1, 0.004, 1.5)] * 1000 + [("b", 1, math.nan, 0.1), ("b", 1, 1.0, 0.2)]
    fact = spark.createDataFrame(rows, "service_type string, pickup_date int, fare_amount double, trip_distance double")
    mart = {r.service_type: r for r in gold.daily_kpis(fact).collect()}
    assert mart["a"].total_fare_amount == 4.0 and mart["a"].avg_trip_distance == 1.5
    assert math.isnan(mart["b"].total_fare_amount) and mart["b"].avg_trip_distance == math.fsum([0.1, 0.2]) / 2
    rolled = star_rollup(fact, [total("fares", "fare_amount"), mean("far", "trip_distance")], (), ["service_type"])
    assert {r.service_type: r.far for r in rolled.collect()} == {"a": 1.5, "b": math.fsum([0.1, 0.2]) / 2}


def test_percentiles_are_values_of_the_column(spark):
    rand = random.Random(9)
    values = [rand.uniform(-1, 1) * 10.0 ** rand.randint(-12, 12) for _ in range(801)] + [1e300, -1e300, math.inf]
    df = frame(spark, values)
    ranks = {"low": MEDIAN_LOW, "high": MEDIAN_HIGH, "first": "1L", "tenth": "10L", "last": "n"}
    got = exact_percentiles(df, "x", ranks).first()
    ordered = sorted(values)
    n = len(ordered)
    assert tuple(got) == (ordered[(n + 1) // 2 - 1], ordered[n // 2], ordered[0], ordered[9], math.inf)
    assert exact_median(df, "x", "m").first().m == (ordered[(n + 1) // 2 - 1] + ordered[n // 2]) / 2
    near = [1 + i * 1e-12 for i in range(101)]
    assert exact_median(frame(spark, near), "x", "m").first().m == near[50]


def test_order_codes_are_the_doubles_own_and_sort_as_they_do(spark):
    rand = random.Random(4)
    powers = [2.0**e for e in range(-1074, 1024, 3)]
    values = [math.nextafter(p, to) for p in powers for to in (0, math.inf)] + powers
    values += [struct.unpack("<d", struct.pack("<Q", rand.getrandbits(63)))[0] for _ in range(5000)]
    values += [0.0, 5e-324, sys.float_info.min, math.nextafter(sys.float_info.min, 0), sys.float_info.max, math.inf]
    values = [sign * x for x in values if not math.isnan(x) for sign in (1, -1)] + [math.nan]
    coded = selection.with_order_digits(frame(spark, values).withColumnRenamed("x", "_x"))
    rows = coded.select("_x", selection.joined_digits().alias("code"), selection.code_value(selection.joined_digits()).alias("back")).collect()
    for x, code, back in rows:
        assert back == x or (math.isnan(x) and math.isnan(back))
        if x > 0:
            assert code == struct.unpack("<q", struct.pack("<d", x))[0]
    by_code = [r[0] for r in sorted(rows, key=lambda r: r.code)]
    assert by_code[:-1] == sorted(x for x in values if not math.isnan(x)) and math.isnan(by_code[-1])


def test_mean_comes_with_the_percentiles(spark):
    rows = [("a", 0.1)] * 10 + [("a", None), ("b", math.nan), ("b", 1.0), ("c", None), (None, 5e-324), (None, -2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in exact_percentiles(df, "x", {"last": "n", "first": "1"}, ["g"], mean="m").collect()}
    assert set(got) == {"a", "b", None}
    assert (got["a"].first, got["a"].last, got["a"].m) == (0.1, 0.1, 0.1)
    assert math.isnan(got["b"].last) and got["b"].first == 1.0 and math.isnan(got["b"].m)
    assert (got[None].first, got[None].last, got[None].m) == (-2.0, 5e-324, -1.0)
    assert tuple(exact_median(df.limit(0), "x", "m", mean="a").first()) == (None, None)


@pytest.mark.parametrize("few", [selection.FEW_GROUPS, 0])
def test_percentiles_shuffle_no_value(spark, monkeypatch, few):
    monkeypatch.setattr(selection, "FEW_GROUPS", few)
    df = spark.range(4000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.sqrt("id")).alias("x"))
    found = exact_percentiles(df, "x", {"p50": selection.nearest_rank(50)}, ["g"])
    out = io.StringIO()
    with redirect_stdout(out):
        found.explain("formatted")
    arguments = [line for line in out.getvalue().splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert arguments and not any("_x" in line or "_value" in line for line in arguments)
    if few:
        # rows are joined where they lie: what is shuffled has been counted by digit
        assert "SortMergeJoin" not in out.getvalue()
    want = {g: sorted(7.5 if i % 3 == 0 else math.sqrt(i) for i in range(4000) if i % 3 == g) for g in range(3)}
    assert {r.g: r.p50 for r in found.collect()} == {g: v[(len(v) + 1) // 2 - 1] for g, v in want.items()}
