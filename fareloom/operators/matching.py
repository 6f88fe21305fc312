"""Comparing two results as tables, whatever their number of rows and columns.

Columns are matched by content: one aggregation per side profiles every column, and only pairs of columns with agreeing
profiles are tried. Rows are matched by counts: equal rows cancel in one grouping, the few that are merely close are joined
over their equal cells and a grid over their numbers. The driver sees profiles and counts, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from fareloom.functions.numbers import ABS_TOL, REL_TOL, close_to
from fareloom.operators.compare import table_difference
from fareloom.workspace import materialize

# A grid cell is this many tolerances wide, so few numbers lie near the edge of one.
_CELL = 16
_NO_CELL = -(10**15)


def _is_number(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")


def _cell(col: Column, kind: str) -> Column:
    if _is_number(kind):
        return col.cast("double")
    return F.when(col, "\u0001true").when(~col, "\u0001false") if kind == "boolean" else col.cast("string")


def _exact(col: Column, kind: str) -> Column:
    """A value as text, the same for equal numbers of all types and different for values of other kinds."""
    if not _is_number(kind):
        return F.concat(F.lit("'"), _cell(col, kind))
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    if whole:
        return col.cast("string")
    text = col if kind.startswith("decimal") else col.cast("double").try_cast("decimal(38,18)")
    plain = F.regexp_replace(F.regexp_replace(text.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    plain = F.when(plain == "-0", "0").otherwise(plain)
    if kind.startswith("decimal"):
        return plain
    # a double that 18 decimals do not hold keeps its own digits
    return F.when(text.cast("double") == col.cast("double"), plain).otherwise(col.cast("double").cast("string"))


def _cells(df: DataFrame, with_place: bool) -> tuple[DataFrame, list[bool]]:
    """The stored cells by position, numbers as DOUBLE and all else as text, and which columns are numbers.

    Only columns of a number type are numbers, so the text '01' is not '1', and a truth value is neither a number nor the
    text 'true'. ``place`` keeps the order of the rows.
    """
    kinds = [kind for _, kind in df.dtypes]
    numeric = [_is_number(kind) for kind in kinds]
    named = df.toDF(*[f"c{i}" for i in range(len(numeric))])
    cells = [_cell(F.col(f"c{i}"), kind).alias(f"c{i}") for i, kind in enumerate(kinds)]
    if not with_place:
        return materialize(named.select(*cells), "result"), numeric
    numbered = materialize(named.select(*cells, F.monotonically_increasing_id().alias("at")), "result", rebalance=False)
    part = F.shiftright("at", 33)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    firsts, total = [], 0
    for row in sizes:
        firsts += [F.lit(row.part), F.lit(total)]
        total += row.n
    first = F.element_at(F.create_map(*firsts), part) if firsts else F.lit(0)
    return numbered.withColumn("place", first + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at"), numeric


def _profiles(cells: DataFrame, numeric: list[bool]) -> tuple[int, list[Row]]:
    """Row count, and for each column what every matching column must share."""

    def profile(i: int) -> Column:
        col = F.col(f"c{i}")
        if not numeric[i]:
            return F.struct(F.count(col).alias("filled"), F.sum(F.xxhash64(col).cast("decimal(38,0)")).alias("hashes"))
        finite = F.abs(col) < float("inf")
        value = F.when(finite, col)
        odd = [F.count_if(F.isnan(col)), F.count_if(col == float("inf")), F.count_if(col == float("-inf"))]
        return F.struct(
            F.count(col).alias("filled"), F.array(*odd).alias("odd"), F.sum(value).alias("sum"), F.sum(F.abs(value)).alias("size"), F.min(value).alias("least"), F.max(value).alias("most")
        )

    row = cells.agg(F.count("*").alias("n"), *[profile(i).alias(f"p{i}") for i in range(len(numeric))]).first()
    return row.n, list(row[1:])


def _near(a: float | None, b: float | None, slack: float) -> bool:
    if a is None or b is None:
        return a is b
    return not abs(a - b) > slack


def _agree(a: Row, a_number: bool, b: Row, b_number: bool, rows: int) -> bool:
    """Whether two columns can hold the same cells: sums, least and greatest values of close numbers are close."""
    if a.filled != b.filled or a.filled == 0:
        return a.filled == b.filled
    if a_number != b_number:
        return False
    if not a_number:
        return a.hashes == b.hashes
    slack = 2 * (rows * ABS_TOL + REL_TOL * ((a["size"] or 0.0) + (b["size"] or 0.0)))
    ends = [2 * max(ABS_TOL, REL_TOL * abs(x or 0.0)) for x in (a.least, a.most)]
    return a.odd == b.odd and _near(a["sum"], b["sum"], slack) and _near(a.least, b.least, ends[0]) and _near(a.most, b.most, ends[1])


def _twins(cells: DataFrame, options: list[list[int]]) -> dict[int, int]:
    """For a column equal to an earlier one in every row, that earlier one; either may stand for the other."""
    pairs = sorted({(a, b) for fits in options for a in fits for b in fits if a < b})
    if not pairs:
        return {}
    differ = cells.agg(*[F.count_if(~F.col(f"c{a}").eqNullSafe(F.col(f"c{b}"))).alias(f"d{n}") for n, (a, b) in enumerate(pairs)]).first()
    return {b: a for n, (a, b) in reversed(list(enumerate(pairs))) if differ[n] == 0}


def _reproduces(left: DataFrame, right: DataFrame, numeric: tuple[list[bool], list[bool]], options: list[list[int]]) -> bool:
    """Whether some selection of the left columns makes the right rows.

    Columns are fixed one after another. Where one has several candidates, those stay that make the right rows together
    with the columns fixed so far, so look-alikes cost a comparison each and not one for each of their permutations.
    """
    twins = _twins(left, options)
    order = sorted(range(len(options)), key=lambda j: len(options[j]))
    picks: list[tuple[int, ...]] = [()]
    for n, j in enumerate(order):
        longer = []
        for pick in picks:
            fits = [i for i in options[j] if i not in pick and (twins.get(i) is None or twins[i] in pick or twins[i] not in options[j])]
            last = n + 1 == len(order)
            for i in fits:
                now = (*pick, i)
                if (not last and len(fits) == 1 and len(picks) == 1) or _selection_matches(left, right, numeric, now, order[: n + 1]):
                    longer.append(now)
                    if last:
                        return True
        picks = longer
    return False


def _grid(col: Column, shift: float) -> Column:
    """The cell of a number, moved by ``shift`` tolerances; the scale turns logarithmic where the tolerance turns relative."""
    size = F.abs(col)
    scaled = F.signum(col) * F.when(size <= 1, size).otherwise(1 + F.ln(F.greatest(size, F.lit(1.0)))) / REL_TOL
    odd = F.when(F.isnan(col), _NO_CELL - 1).when(col == float("inf"), _NO_CELL - 2).otherwise(_NO_CELL - 3)
    return F.when(col.isNull(), F.lit(_NO_CELL)).when(size < float("inf"), F.floor((scaled + shift) / _CELL)).otherwise(odd)


def _close_pairs(surplus: DataFrame, numeric: list[bool]) -> DataFrame:
    """Pairs of unmatched rows that are close, with how often each is left and how far they are apart."""
    names = surplus.columns[:-1]
    numbers = [c for c, n in zip(names, numeric) if n]
    a = surplus.where("surplus > 0").select(F.struct(*names).alias("a"), F.col("surplus").alias("a_left"), *names)
    b = surplus.where("surplus < 0").select(F.struct(*names).alias("b"), (-F.col("surplus")).alias("b_left"), *[F.col(c).alias(f"b_{c}") for c in names])
    for c in numbers:
        a = a.withColumn(f"g_{c}", F.explode(F.array_distinct(F.array(_grid(F.col(c), -1.01), _grid(F.col(c), 1.01)))))
        b = b.withColumn(f"bg_{c}", _grid(F.col(f"b_{c}"), 0.0))
    meet, apart = F.lit(True), F.lit(0.0)
    for c, n in zip(names, numeric):
        x, y = F.col(c), F.col(f"b_{c}")
        if n:
            meet = meet & (F.col(f"g_{c}") == F.col(f"bg_{c}")) & close_to(x, y)
            far = F.abs(x - y) / F.greatest(F.lit(1.0), F.abs(x), F.abs(y))
            apart = apart + F.coalesce(F.nanvl(far, F.lit(0.0)), F.lit(0.0))
        else:
            meet = meet & x.eqNullSafe(y)
    return a.join(b, meet).select("a", "b", "a_left", "b_left", apart.alias("apart"))


def _same_rows(left: DataFrame, right: DataFrame, numeric: list[bool]) -> bool:
    """Whether the rows pair off, each with a close one. Equal rows pair first, then mutually nearest ones, round by round."""
    surplus = materialize(table_difference(left, right), "surplus")
    open_rows = surplus.where("surplus > 0").agg(F.sum("surplus")).first()[0] or 0
    if not open_rows:
        return surplus.isEmpty()
    if not any(numeric):
        return False
    pairs = materialize(_close_pairs(surplus, numeric), "close_pairs")
    while open_rows:
        of_a = pairs.groupBy("a").agg(F.min(F.struct("apart", "b", "a_left", "b_left")).alias("m"))
        of_b = pairs.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("m"))
        nearest = of_a.select("a", F.col("m.b").alias("b"), F.least("m.a_left", "m.b_left").alias("n"))
        taken = materialize(nearest.join(of_b.select(F.col("m.a").alias("a"), "b"), ["a", "b"]), "taken")
        done = taken.agg(F.sum("n")).first()[0]
        if not done:
            return False
        open_rows -= done
        if open_rows:
            used_a, used_b = taken.select("a", F.col("n").alias("n_a")), taken.select("b", F.col("n").alias("n_b"))
            rest = pairs.join(used_a, "a", "left").join(used_b, "b", "left")
            a_left, b_left = (F.col(f"{s}_left") - F.coalesce(F.col(f"n_{s}"), F.lit(0)) for s in "ab")
            rest = rest.select("a", "b", a_left.alias("a_left"), b_left.alias("b_left"), "apart")
            pairs = materialize(rest.where("a_left > 0 and b_left > 0"), "close_pairs")
    return True


def _ordered_fits(agent: DataFrame, gold: DataFrame, numeric: tuple[list[bool], list[bool]], options: list[list[int]]) -> list[list[int]]:
    """The options that agree in every place. Both sides have the same places, so columns can be judged one by one."""
    tried = [(j, i) for j, fits in enumerate(options) for i in fits]
    if not tried:
        return options
    other = gold.select("place", *[F.col(f"c{j}").alias(f"gold_{j}") for j in range(len(options))])

    def same(i: int, j: int) -> Column:
        x, y = F.col(f"c{i}"), F.col(f"gold_{j}")
        return close_to(x, y) if numeric[0][i] and numeric[1][j] else x.cast("string").eqNullSafe(y.cast("string"))

    wrong = agent.join(other, "place").agg(*[F.count_if(~same(i, j)).alias(f"w{n}") for n, (j, i) in enumerate(tried)]).first()
    fits = [(j, i) for n, (j, i) in enumerate(tried) if wrong[n] == 0]
    return [[i for k, i in fits if k == j] for j in range(len(options))]


def _assignable(options: list[list[int]]) -> bool:
    """Whether every column can get an option of its own."""
    owner: dict[int, int] = {}

    def place(j: int, seen: set[int]) -> bool:
        for i in options[j]:
            if i not in seen:
                seen.add(i)
                if i not in owner or place(owner[i], seen):
                    owner[i] = j
                    return True
        return False

    return all(place(j, set()) for j in range(len(options)))


def _verdict(df: DataFrame, match: bool, agent: int, gold: int) -> DataFrame:
    row = [(match, agent, gold)]
    return df.sparkSession.createDataFrame(row, "match boolean, agent_row_count long, gold_row_count long")


def compare_results(agent: DataFrame, gold: DataFrame, ordered: bool = False) -> DataFrame:
    """Tolerant comparison, as one row: match, agent_row_count, gold_row_count.

    True when some selection of the agent's columns reproduces the gold rows: names do not count, extra columns are
    allowed, row counts must be equal, and order counts only if ``ordered``. Columns without any value match each
    other. Two empty results match when the agent has enough columns. Rows that are close to several others pair with the nearest first.
    """
    left, left_numbers = _cells(agent, ordered)
    right, right_numbers = _cells(gold, ordered)
    n_left, of_left = _profiles(left, left_numbers)
    n_right, of_right = _profiles(right, right_numbers)
    if n_left != n_right:
        return _verdict(agent, False, n_left, n_right)
    options = []
    for j, p in enumerate(of_right):
        fits = [i for i, a in enumerate(of_left) if _agree(a, left_numbers[i], p, right_numbers[j], n_left)]
        options.append(sorted(fits, key=lambda i: (agent.columns[i] != gold.columns[j], i)))
    match = _assignable(options)
    if match and n_left and ordered:
        match = _assignable(_ordered_fits(left, right, (left_numbers, right_numbers), options))
    elif match and n_left:
        match = _reproduces(left, right, (left_numbers, right_numbers), options)
    return _verdict(agent, match, n_left, n_right)


def _selection_matches(left: DataFrame, right: DataFrame, numeric: tuple[list[bool], list[bool]], pick: tuple[int, ...], wanted: list[int]) -> bool:
    """Whether the left columns ``pick`` make the rows of the right columns ``wanted``."""
    both = [numeric[0][i] and numeric[1][j] for i, j in zip(pick, wanted)]
    kinds = ["double" if n else "string" for n in both]
    chosen = left.select(*[F.col(f"c{i}").cast(k).alias(f"c{n}") for n, (i, k) in enumerate(zip(pick, kinds))])
    return _same_rows(chosen, right.select(*[F.col(f"c{j}").cast(k).alias(f"c{n}") for n, (j, k) in enumerate(zip(wanted, kinds))]), both)


def results_identical(agent: DataFrame, gold: DataFrame, ordered: bool = False) -> DataFrame:
    """Exact comparison, as one row ``match``: the same columns by position and the same rows equally often.

    In an ordered comparison the rows must also come in the same order. Numbers are compared as numbers, so 1, 1.0 and
    1.00 are the same and long whole numbers keep all digits. A number, a text and a truth value are never the same.
    """
    def marked(df: DataFrame) -> DataFrame:
        kinds = [kind for _, kind in df.dtypes]
        named = df.toDF(*[f"c{i}" for i in range(len(kinds))])
        cells = [_exact(F.col(f"c{i}"), k) for i, k in enumerate(kinds)]
        return _cells(named.select(*cells), ordered)[0]

    same = len(agent.columns) == len(gold.columns) and table_difference(marked(agent), marked(gold)).isEmpty()
    return agent.sparkSession.createDataFrame([(same,)], "match boolean")
