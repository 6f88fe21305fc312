"""Exact order statistics without gathering a group in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from fareloom.functions.numbers import merged_state, safe_divide, state_value, sum_state
from fareloom.workspace import materialize

DIGIT_BITS = 16
DIGITS = [f"_d{i}" for i in range(64 // DIGIT_BITS)]

#: Up to this many groups the prefixes looked for, one row per group and rank, are broadcast to the rows.
FEW_GROUPS = 10_000


def exact_percentiles(
    df: DataFrame,
    value: str,
    ranks: dict[str, str],
    group_by: list[str] | None = None,
    mean: str | None = None,
) -> DataFrame:
    """For each group, the values at given 1-based ranks of the sorted non-null values; NaN sorts last.

    ``ranks`` maps an output column to an SQL expression of ``n``, the group's row count; ``mean`` names a column for the
    exact mean, which the first pass sums along. Groups without a value are left out.

    Every double has a whole number of 64 bits that sorts as it does (``order_code``). The number of a rank is found by its
    four digits of 16 bits: counting a group's rows per first digit tells under which digit the rank lies, then only rows
    of that digit are counted by the next. Rows are summed up in their own task before anything is shuffled, so a step
    moves at most 65,536 counts per group, rank and task, however many rows or different values there are; no shuffle has
    the value as its key. The digits found are the value itself, so results are values of the column.

    The first pass runs at once and stores one row per group and prefix; with at most ``FEW_GROUPS`` groups these are
    broadcast to the rows in the later passes, as no later step has more of them. Beyond that Spark plans the join.
    """
    groups = list(group_by or [])
    coded = with_order_digits(df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_x")))
    first = coded.groupBy(*groups, DIGITS[0]).agg(F.count("*").alias("_n"), *([sum_state(F.col("_x")).alias("_sum")] if mean else []))
    whole = Window.partitionBy(*groups)
    first = first.withColumn("n", F.sum("_n").over(whole))
    carried = []
    if mean:
        carried = ["_mean"]
        first = first.withColumn("_mean", safe_divide(state_value(merged_state("_sum", whole)), F.col("n"))).drop("_sum")
    named = [F.struct(F.lit(k).alias("_name"), F.expr(e).cast("long").alias("_rank")) for k, e in ranks.items()]
    first = first.select("*", F.inline(F.array(*named))).drop("n")
    seen = Observation()
    found = _holding(first, [*groups, *carried], DIGITS[0]).observe(seen, F.count(F.lit(1)).alias("rows"))
    wanted = materialize(found, "percentile_digits", rebalance=False)
    few = seen.get["rows"] <= FEW_GROUPS * len(ranks)
    for i in range(1, len(DIGITS)):
        known = [*groups, *DIGITS[:i]]
        asked = F.collect_list(F.struct("_name", "_rank")).alias("_asked")
        prefixes = wanted.groupBy(*known, *carried).agg(F.sort_array(asked).alias("_asked"))
        under = _join_nulls(F.broadcast(prefixes) if few else prefixes, coded.select(*known, DIGITS[i]), known)
        level = under.groupBy(*known, *carried, "_asked", DIGITS[i]).agg(F.count("*").alias("_n"))
        level = level.select("*", F.inline("_asked")).drop("_asked")
        wanted = _holding(level, [*known, *carried], DIGITS[i])
    result = wanted.select(*groups, *carried, "_name", code_value(joined_digits()).alias("_value"))
    picked = [F.max(F.when(F.col("_name") == k, F.col("_value"))).alias(k) for k in ranks]
    return result.groupBy(*groups).agg(*picked, *([F.max("_mean").alias(mean)] if mean else []))


_MANTISSA = 52
_MANTISSA_MASK = (1 << _MANTISSA) - 1
_SMALLEST_NORMAL = 2.0**-1022


def with_order_digits(df: DataFrame) -> DataFrame:
    """Turn the double column ``_x`` into the digits of its order code, keeping it and the other columns.

    The code of a number is its exponent and mantissa as one whole number, negative for numbers below zero; both zeros
    have code 0. Scaling by powers of two is exact, so the code is too. The logarithm may be off by one next to a power of
    two, which the scaled number shows.
    """
    size = F.abs(F.col("_x"))
    finite = (size > 0) & (size < float("inf"))
    normal = finite & (size >= _SMALLEST_NORMAL)
    guess = F.when(normal, F.greatest(F.least(F.floor(F.log2(size)), F.lit(1022)), F.lit(-1022)).cast("int")).otherwise(0)
    df = df.withColumn("_e", guess)
    df = df.withColumn("_m", F.when(normal, size * F.pow(F.lit(2.0), -F.col("_e"))).otherwise(1.0))
    off = F.when(F.col("_m") >= 2, 1).when(F.col("_m") < 1, -1).otherwise(0)
    fraction = F.when(off == 1, F.col("_m") / 2).when(off == -1, F.col("_m") * 2).otherwise(F.col("_m")) - 1
    code = F.shiftleft((F.col("_e") + off + 1023).cast("long"), _MANTISSA) + (fraction * 2.0**_MANTISSA).cast("long")
    code = (
        F.when(normal, code)
        .when(finite, (size * 2.0**537 * 2.0**537).cast("long"))
        .when(F.isnan("_x"), F.lit((2047 << _MANTISSA) + (1 << (_MANTISSA - 1))))
        .when(size > 0, F.lit(2047 << _MANTISSA))
        .otherwise(F.lit(0))
    )
    df = df.withColumn("_code", F.when(F.col("_x") < 0, -code).otherwise(code).cast("long"))
    last = len(DIGITS) - 1
    digits = {DIGITS[0]: F.shiftright("_code", DIGIT_BITS * last)}
    for i in range(1, last + 1):
        digits[DIGITS[i]] = F.shiftright("_code", DIGIT_BITS * (last - i)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
    return df.withColumns({name: digit.cast("int") for name, digit in digits.items()}).drop("_e", "_m", "_code")


def joined_digits() -> Column:
    """The order code from its digits."""
    code = F.col(DIGITS[0]).cast("long")
    for name in DIGITS[1:]:
        code = F.shiftleft(code, DIGIT_BITS).bitwiseOR(F.col(name).cast("long"))
    return code


def code_value(code: Column) -> Column:
    """The double of an order code."""
    size = F.abs(code)
    exponent = F.shiftright(size, _MANTISSA)
    fraction = size.bitwiseAND(F.lit(_MANTISSA_MASK)).cast("double")
    value = (
        F.when(exponent == 0, fraction * 2.0**-537 * 2.0**-537)
        .when(exponent < 2047, (fraction * 2.0**-_MANTISSA + 1) * F.pow(F.lit(2.0), (exponent - 1023).cast("double")))
        .when(fraction == 0, F.lit(float("inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(code < 0, -value).otherwise(value)


def _holding(level: DataFrame, keys: list[str], digit: str) -> DataFrame:
    """The digit each wanted rank falls under, with the rank counted from that digit's first row."""
    smaller = Window.partitionBy(*keys, "_name").orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    placed = level.withColumn("_before", F.coalesce(F.sum("_n").over(smaller), F.lit(0)))
    kept = placed.where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
    return kept.withColumn("_rank", F.col("_rank") - F.col("_before")).drop("_before", "_n")


def _join_nulls(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equi-join in which NULL keys match each other."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])


# Rank rules, as SQL over the group's row count n.
MEDIAN_LOW = "cast((n + 1) div 2 as bigint)"
MEDIAN_HIGH = "cast(n div 2 + 1 as bigint)"


def nearest_rank(percent: int) -> str:
    """The smallest rank covering the percentage: ceil(p * n), computed on whole numbers."""
    return f"greatest(1, least(n, (n * {percent} + 99) div 100))"


def rounded_rank(percent: int) -> str:
    """The rank at the rounded position p * (n - 1), halves going to the even position."""
    return f"least(n, cast(rint({percent} / 100.0D * (n - 1)) as bigint) + 1)"


def exact_median(df: DataFrame, value: str, name: str, group_by: list[str] | None = None, mean: str | None = None) -> DataFrame:
    """The middle value, or the mean of the two middle ones; ``mean`` names a column for the exact mean of all."""
    pair = exact_percentiles(df, value, {"_low": MEDIAN_LOW, "_high": MEDIAN_HIGH}, group_by, mean)
    return pair.select(*(group_by or []), ((F.col("_low") + F.col("_high")) / 2).alias(name), *([mean] if mean else []))
