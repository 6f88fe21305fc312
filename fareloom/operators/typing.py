"""Deciding what a text column of a result holds: numbers, dates, month buckets or text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names with a calendar meaning.
MONTH_COLUMNS = ("month", "year_month", "pickup_month", "dropoff_month")
DATE_PARTS = ("year", "month", "day", "quarter", "day_of_week")
DATE_HINTS = ("date", "_at", "timestamp", "datetime")


def _number(col: Column) -> Column:
    return col.cast("string").try_cast("double")


def _moment(col: Column) -> Column:
    return col.cast("string").try_cast("timestamp_ntz")


def is_date_like(name: str) -> bool:
    lowered = name.lower()
    return lowered not in DATE_PARTS and lowered not in MONTH_COLUMNS and any(h in lowered for h in DATE_HINTS)


def column_kinds(df: DataFrame) -> DataFrame:
    """One row per column with its kind, from one pass over the result."""
    kinds = []
    for name in df.columns:
        col = F.col(name)
        filled, numbers, moments = F.count(col), F.count(_number(col)), F.count(_moment(col))
        if name.lower() in MONTH_COLUMNS:
            in_year = F.count_if(~_number(col).between(1, 12)) == 0
            kind = (
                F.when((filled > 0) & (numbers == filled) & in_year, "month_number")
                .when((filled > 0) & (numbers == filled), "text")
                .when((filled > 0) & (moments == filled), "month_of_date")
                .otherwise("text")
            )
        else:
            kind = F.when(numbers == filled, "number")
            if is_date_like(name):
                kind = kind.when(moments > 0, "moment")
            kind = kind.otherwise("text")
        kinds.append(F.struct(F.lit(name).alias("column_name"), kind.alias("kind")))
    return df.agg(F.array(*kinds).alias("kinds")).select(F.inline("kinds"))


def prepare_result(df: DataFrame) -> DataFrame:
    """The result with each column cast to its kind. One small row per column reaches the driver."""
    kinds = {r["column_name"]: r["kind"] for r in column_kinds(df).collect()}
    casts = {
        "number": _number,
        "moment": _moment,
        "month_number": lambda c: F.lpad(_number(c).cast("int").cast("string"), 2, "0"),
        "month_of_date": lambda c: F.date_format(_moment(c), "yyyy-MM"),
        "text": lambda c: c.cast("string"),
    }
    return df.select(*[casts[kinds[c]](F.col(c)).alias(c) for c in df.columns])
