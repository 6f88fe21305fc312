"""Lexical audit of a log of query texts against the catalog. A report, not an enforcement point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.plans.catalog import MART, Catalog

# Words of the query language that are neither columns nor tables.
LANGUAGE_WORDS = (
    "select", "from", "where", "group", "by", "order", "having", "limit", "offset", "as", "on", "using", "join",
    "inner", "left", "right", "full", "outer", "cross", "and", "or", "not", "in", "is", "null", "like", "between",
    "case", "when", "then", "else", "end", "distinct", "all", "asc", "desc", "with", "over", "partition", "exists",
    "union", "intersect", "except", "date", "interval", "month", "year", "day", "true", "false", "cast", "integer",
    "varchar", "double", "rows", "range",
)


def policy_scan(df: DataFrame, text: str, catalog: Catalog) -> DataFrame:
    """Add ``reasons``, the rules a text breaks, and ``blocked``."""
    tables = catalog.names()
    details = [t.name for t in catalog.tables if t.table_type != MART]
    columns = sorted({c for t in catalog.tables for c in t.columns})
    owned = sorted({f"{t.name}.{c}" for t in catalog.tables for c in t.columns})
    disabled = [t.name for t in catalog.tables if not t.execution_enabled]
    paths = sorted(f"{j.left_table}.{j.left_column}={j.right_table}.{j.right_column}" for j in catalog.joins())

    bare = F.lower(F.regexp_replace(F.col(text), r"'(?:[^']|'')*'", "''"))
    base = df.withColumn("_sql", F.trim(F.regexp_replace(bare, r"\s+", " ")))
    sql = F.col("_sql")
    source = r"\b(?:from|join) (?:\w+\.)*(\w+)"
    followers = "|".join(("on", "join", "where", "group", "order", "left", "right", "inner", "cross", "full", "limit", "having", "union"))
    aliased = rf"\b(?:from|join) ((?:\w+\.)*\w+(?: as)? (?!(?:{followers})\b)\w+)"
    base = base.withColumns(
        {
            "_ctes": F.regexp_extract_all(sql, F.lit(r"(?:\bwith|,) (\w+) as \("), F.lit(1)),
            "_named": F.regexp_extract_all(sql, F.lit(source), F.lit(1)),
            "_pairs": F.regexp_extract_all(sql, F.lit(aliased), F.lit(1)),
            "_outputs": F.regexp_extract_all(sql, F.lit(r"\bas (\w+)"), F.lit(1)),
        }
    )
    base = base.withColumn("_tables", F.array_distinct(F.array_except(F.col("_named"), F.col("_ctes"))))
    base = base.withColumn("_aliases", _alias_map())
    base = base.withColumns(
        {
            "_links": F.transform(
                F.regexp_extract_all(sql, F.lit(r"(\w+\.\w+ ?= ?\w+\.\w+)"), F.lit(1)), _resolve_equality
            ),
            "_qualified": F.transform(F.regexp_extract_all(sql, F.lit(r"\b([a-z_]\w*\.\w+)"), F.lit(1)), _resolve),
            "_words": F.regexp_extract_all(sql, F.lit(r"(?<![\w.])([a-z_]\w*)\b(?![\w.]| ?\()"), F.lit(1)),
        }
    )
    joins = F.size(F.regexp_extract_all(sql, F.lit(r"\b(join)\b"), F.lit(1)))
    crosses = F.size(F.regexp_extract_all(sql, F.lit(r"\b(cross join)\b"), F.lit(1)))
    conditions = F.size(F.regexp_extract_all(sql, F.lit(r"\b(on)\b"), F.lit(1)))
    cte_joins = F.size(F.filter(F.regexp_extract_all(sql, F.lit(r"\bjoin (\w+)"), F.lit(1)), lambda n: F.array_contains("_ctes", n)))
    known = F.concat(F.lit([*LANGUAGE_WORDS, *columns, *tables]), F.col("_outputs"), F.col("_ctes"), F.map_keys("_aliases"))
    ctes = F.col("_ctes")
    rules = {
        "not a select": ~F.coalesce(F.regexp_extract(sql, r"^\(*(\w+)", 1).isin("select", "with"), F.lit(False)),
        "more than one statement": F.regexp_extract(sql, r";\s*(\S)", 1) != "",
        "set operation": sql.rlike(r"\b(union|intersect|except)\b"),
        "write or command word": sql.rlike(r"\b(insert|update|delete|drop|create|alter|attach|copy|install|pragma) "),
        "no gold table": F.size("_tables") == 0,
        "unknown table": F.size(F.array_except(F.col("_tables"), F.lit(tables))) > 0,
        "disabled table": F.arrays_overlap(F.col("_tables"), F.lit(disabled or ["-"])),
        "wildcard on detail table": sql.rlike(r"\bselect (distinct )?([\w.]+ ?, ?)*(\w+\.)?\*")
        & F.arrays_overlap(F.col("_tables"), F.lit(details)),
        "cross join": crosses > 0,
        "join without condition": joins - crosses > conditions,
        "join off the catalog paths": joins - crosses - cte_joins
        > F.size(F.array_intersect(F.array_distinct("_links"), F.lit(paths))),
        "unknown column": (F.size(F.array_except(F.col("_words"), known)) > 0)
        | F.exists(
            F.col("_qualified"),
            lambda c: ~F.array_contains(F.lit(owned), c) & ~F.array_contains(ctes, F.substring_index(c, ".", 1))
            & ~F.array_contains(F.lit(tables), F.substring_index(c, ".", -1)),
        ),
    }
    reasons = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    scanned = base.withColumn("reasons", reasons).withColumn("blocked", F.size("reasons") > 0)
    return scanned.drop(*[c for c in scanned.columns if c.startswith("_")])


def _alias_map() -> Column:
    """Alias to table, from texts like ``fact_trips as f``."""
    entries = F.transform(
        F.col("_pairs"),
        lambda p: F.struct(
            F.substring_index(p, " ", -1).alias("key"),
            F.substring_index(F.substring_index(p, " ", 1), ".", -1).alias("value"),
        ),
    )
    # The last use of an alias wins, as a map may hold a key only once.
    last = F.filter(
        entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"])
    )
    return F.map_from_entries(last)


def _resolve(qualified: Column) -> Column:
    owner = F.substring_index(qualified, ".", 1)
    table = F.coalesce(F.try_element_at(F.col("_aliases"), owner), owner)
    return F.concat(table, F.lit("."), F.substring_index(qualified, ".", -1))


def _resolve_equality(link: Column) -> Column:
    sides = F.split(F.replace(link, F.lit(" "), F.lit("")), "=")
    return F.concat(_resolve(F.get(sides, F.lit(0))), F.lit("="), _resolve(F.get(sides, F.lit(1))))
