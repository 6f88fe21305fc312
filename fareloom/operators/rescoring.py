"""Scoring saved results again, as tables keyed by case.

Every cell becomes a symbol: within a case, numbers in order get a new symbol wherever the step from one to the next is
beyond the tolerance, and a text is its own symbol. Tolerant comparison is then plain equality of symbols. Columns that
may stand for an expected column are found by the rows they make together with the columns fixed before, one expected
column after another, so look-alike columns are told apart early; equal columns count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.functions.numbers import close_to
from fareloom.workspace import materialize

_NONE = "-"


def _cells(saved: DataFrame, rows: str, side: str) -> DataFrame:
    lines = saved.select("case_no", F.posexplode(rows).alias("row", "cells"))
    return lines.select("case_no", F.lit(side).alias("side"), "row", F.posexplode("cells").alias("col", "value"))


def _symbols(cells: DataFrame) -> DataFrame:
    """Cells with their symbol; numbers are neighbours within one saved case only."""
    known = cells.withColumn("number", F.col("value").try_cast("double"))
    by_size = Window.partitionBy("case_no", F.col("number").isNull()).orderBy("number")
    step = (~close_to(F.col("number"), F.lag("number").over(by_size))).cast("int")
    steps = known.withColumn("step", step)
    place = F.sum("step").over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    symbol = F.when(F.col("number").isNotNull(), F.concat(F.lit("#"), F.coalesce(place, F.lit(0)).cast("string")))
    return steps.withColumn("symbol", F.coalesce(symbol, F.concat(F.lit("'"), F.col("value")), F.lit(_NONE)))


def _columns(symbols: DataFrame) -> DataFrame:
    """Of each case and side the columns, each a map from row to symbol."""
    one = symbols.groupBy("case_no", "side", "col").agg(F.map_from_entries(F.collect_list(F.struct("row", "symbol"))).alias("cells"))
    listed = one.groupBy("case_no").pivot("side", ["agent", "gold"]).agg(F.array_sort(F.collect_list(F.struct("col", F.map_entries("cells").alias("cells")))))
    return listed


def _filled(columns: Column, rows: Column) -> Column:
    """Columns as arrays of symbols by row, a lacking cell being none."""
    def one(column: Column) -> Column:
        held = F.map_from_entries(column["cells"])
        return F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.coalesce(F.try_element_at(held, r), F.lit(_NONE)))

    return F.coalesce(F.transform(columns, one), F.array().cast("array<array<string>>"))


def _joint(columns: Column, picked: Column, rows: Column) -> Column:
    """The rows that the picked columns make, as a sorted list."""
    return F.array_sort(F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.transform(picked, lambda c: F.get(F.get(columns, c), r))))


def _in_any_order(agent: Column, gold: Column, rows: Column) -> Column:
    places = F.sequence(F.lit(0), F.size(agent) - 1)

    def fits(picked: Column, wanted: Column) -> Column:
        def usable(i: Column) -> Column:
            same_before = F.exists(places, lambda k: (k < i) & ~F.array_contains(picked, k) & (F.get(agent, k) == F.get(agent, i)))
            return ~F.array_contains(picked, i) & ~same_before & (_joint(agent, F.concat(picked, F.array(i)), rows) == wanted)

        return F.transform(F.filter(places, usable), lambda i: F.concat(picked, F.array(i)))

    def one_more(state: Column, j: Column) -> Column:
        wanted = _joint(gold, F.sequence(F.lit(0), j), rows)
        return F.flatten(F.transform(state, lambda picked: fits(picked, wanted)))

    start = F.array(F.array().cast("array<int>"))
    return F.size(F.aggregate(F.sequence(F.lit(0), F.size(gold) - 1), start, one_more)) > 0


def _in_order(agent: Column, gold: Column) -> Column:
    """With fixed rows equal columns are interchangeable, so each needs only to be there often enough."""
    often = lambda columns, one: F.size(F.filter(columns, lambda c: c == one))
    return F.forall(F.array_distinct(gold), lambda one: often(agent, one) >= often(gold, one))


def rescore(saved: DataFrame) -> DataFrame:
    """Score saved results again (``rescored``) and mark those whose stored verdict ``match`` flips (``flipped``).

    ``saved`` has the cells of both results as text: agent_rows, agent_cols, gold_rows, gold_cols, and gold_sql. An answer
    matches when some selection of its columns reproduces the expected rows; names do not count and extra columns are
    allowed. Order counts only if the expected query both sorts and cuts. Two empty results match when the answer has
    columns enough. Numbers that a chain of close ones connects count as close.
    """
    numbered = materialize(saved.withColumn("case_no", F.monotonically_increasing_id()), "saved", rebalance=False)
    cells = _cells(numbered, "agent_rows", "agent").unionByName(_cells(numbered, "gold_rows", "gold"))
    rows = F.size("gold_rows")
    joined = numbered.join(_columns(_symbols(cells)), "case_no", "left")
    joined = joined.withColumns({"agent": F.when(rows > 0, _filled(F.col("agent"), rows)), "gold": F.when(rows > 0, _filled(F.col("gold"), rows))})
    text = F.lower(F.coalesce("gold_sql", F.lit("")))
    ranking = text.rlike(r"\border\s+by\b") & text.rlike(r"\blimit\b")
    agent, gold = F.col("agent"), F.col("gold")
    verdict = (
        F.when(F.size("agent_rows") != rows, False)
        .when(F.size("agent_cols") < F.size("gold_cols"), False)
        .when((rows == 0) | (F.size(gold) == 0), True)
        .when(F.size(agent) == 0, False)
        .when(ranking, _in_order(agent, gold))
        .otherwise(_in_any_order(agent, gold, rows))
    )
    scored = joined.withColumn("rescored", F.coalesce(verdict, F.lit(False))).select(*saved.columns, "rescored")
    return scored.withColumn("flipped", F.col("rescored") != F.coalesce(F.col("match"), F.lit(False)))
