"""Star joins that aggregate the fact before it meets a dimension."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.numbers import merged_state, safe_divide, state_value, sum_state


@dataclass(frozen=True)
class Lookup:
    """A dimension, the fact column that points at it, and the labels wanted from it.

    ``labels`` maps output names to dimension columns. A dimension may be used in several roles.
    """

    table: DataFrame
    on: str
    key: str
    labels: dict[str, str] = field(default_factory=dict)
    how: str = "inner"
    where: Column | None = None
    default: str | None = None


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str
    column: str | None = None
    whole: bool = False  # a column of whole numbers, summed as it is


def count(name: str) -> Measure:
    return Measure(name, "count")


def total(name: str, column: str) -> Measure:
    return Measure(name, "sum", column)


def mean(name: str, column: str) -> Measure:
    return Measure(name, "mean", column)


def star_rollup(
    fact: DataFrame,
    measures: list[Measure],
    lookups: tuple[Lookup, ...] | list[Lookup] = (),
    group_by: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """Group a fact by its own columns and by dimension labels.

    The fact is first reduced to one row per combination of keys, so only partial results are
    shuffled and joined. A key with a third of the rows costs one row per map task, and no
    dimension has to be small enough to broadcast.
    """
    keys = list(dict.fromkeys([*group_by, *(l.on for l in lookups)]))
    partial = fact.groupBy(*keys).agg(*_partial_columns(measures))
    labels: list[str] = []
    for number, lookup in enumerate(lookups):
        dim = lookup.table if lookup.where is None else lookup.table.where(lookup.where)
        join_key = f"_key_{number}"
        dim = dim.select(
            F.col(lookup.key).alias(join_key), *[F.col(c).alias(f"_l{number}_{n}") for n, c in lookup.labels.items()]
        )
        partial = partial.join(dim, partial[lookup.on] == dim[join_key], lookup.how).drop(join_key)
        for name in lookup.labels:
            value = F.col(f"_l{number}_{name}")
            if lookup.default is not None:
                value = F.coalesce(value, F.lit(lookup.default))
            labels.append((name, value))
    group_columns = [F.col(c) for c in group_by] + [value.alias(name) for name, value in labels]
    return partial.groupBy(*group_columns).agg(*[_final_column(m) for m in measures])


def _partial_columns(measures: list[Measure]) -> list[Column]:
    columns = {"_rows": F.count("*").alias("_rows")}
    for m in measures:
        if m.kind != "count":
            columns[f"_sum_{m.column}"] = (F.sum(m.column) if m.whole else sum_state(F.col(m.column))).alias(f"_sum_{m.column}")
        if m.kind == "mean":
            columns[f"_count_{m.column}"] = F.count(m.column).alias(f"_count_{m.column}")
    return list(columns.values())


def _final_column(m: Measure) -> Column:
    if m.kind == "count":
        return F.coalesce(F.sum("_rows"), F.lit(0)).alias(m.name)
    value = F.sum(f"_sum_{m.column}") if m.whole else state_value(merged_state(f"_sum_{m.column}"))
    if m.kind == "mean":
        value = safe_divide(value, F.sum(f"_count_{m.column}"))
    return value.alias(m.name)
