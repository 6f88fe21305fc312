"""Exact duplicates by deterministic block naming, with DataFrame functions only.

A text is cut into blocks of ``BLOCK`` characters. The distinct blocks are sorted and numbered; then neighbouring names
are paired, the distinct pairs are sorted and numbered, and so on until one name is left of each text. Two texts have
the same number of blocks and the same last name exactly when they are equal; no hash decides.

Each level is one distinct (reduced before the shuffle), one sort and one join. The keys that most rows share, at most
``COMMON`` of them, are joined through a small broadcast table of their names, so no task gathers the rows of one key and
a key that is not among them has less than ``1 / COMMON`` of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import ROW_KEY, stored, with_row_key, without_white_space

BLOCK = 1024
COMMON = 500
OFTEN = 50


def _numbered(distinct: DataFrame, key: list[str], first: int) -> DataFrame:
    """Distinct keys with whole numbers as names: sorted in each partition, which gives the upper bits."""
    return distinct.sortWithinPartitions(*key).withColumn("name", F.monotonically_increasing_id() + F.lit(first))


def _named(rows: DataFrame, key: list[str], keep: list[str]) -> DataFrame:
    """``rows`` with the name of their key instead of the key; column ``h`` is a hash of the key."""
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > OFTEN)
    common = [r["h"] for r in counts.orderBy(F.desc("n"), "h").limit(COMMON).select("h").collect()]
    often = F.col("h").isin(common) if common else F.lit(False)

    def join(part: DataFrame, first: int, small: bool) -> DataFrame:
        names = _numbered(part.select(*key).distinct(), key, first)
        return part.join(F.broadcast(names) if small else names, key).select(*keep, "name")

    named = join(rows.where(~often), 0, False)
    return named.unionByName(join(rows.where(often), 1 << 62, True)) if common else named


def identities(docs: DataFrame, text: Column, carried: dict[str, Column]) -> DataFrame:
    """The carried columns and the identity (``blocks``, ``name``) of each row's text; an empty text has (0, 0)."""
    body = docs.select(F.coalesce(text, F.lit("")).alias("body"), F.struct(*(c.alias(k) for k, c in carried.items())).alias("carried"))
    parts = body.select("carried", F.regexp_extract_all("body", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("parts"))
    parts = parts.withColumn("row", F.monotonically_increasing_id()).withColumn("blocks", F.size("parts"))
    pieces = parts.select("row", "carried", "blocks", F.posexplode_outer("parts").alias("at", "block"))
    pieces = stored(
        pieces.select(
            "row", "blocks", "at", "block", F.xxhash64("block").alias("h"),
            F.when(F.coalesce("at", F.lit(0)) == 0, F.col("carried")).alias("carried"),
        ),
        "blocks",
    )
    texts = pieces.where(F.col("carried").isNotNull()).select("row", "blocks", "carried.*")
    most = pieces.agg(F.max("blocks")).first()[0] or 0
    work = stored(_named(pieces.where(F.col("blocks") > 0), ["block"], ["row", "blocks", "at"]), "names_1")
    done = pieces.where(F.col("blocks") == 0).select("row", F.lit(0).cast("long").alias("name"))
    width = 1
    while True:
        done = done.unionByName(work.where((F.col("blocks") <= width) & (F.col("blocks") > width // 2)).select("row", "name"))
        if width >= most:
            return texts.join(done, "row").drop("row")
        name = lambda side: F.coalesce(F.max(F.when(F.col("at") % 2 == side, F.col("name"))), F.lit(-1))
        pairs = (
            work.where(F.col("blocks") > width)
            .groupBy("row", "blocks", F.floor(F.col("at") / 2).cast("int").alias("half"))
            .agg(name(0).alias("left"), name(1).alias("right"))
            .select("row", "blocks", F.col("half").alias("at"), "left", "right", F.xxhash64("left", "right").alias("h"))
        )
        width *= 2
        work = stored(_named(stored(pairs, f"pairs_{width}"), ["left", "right"], ["row", "blocks", "at"]), f"names_{width}")


def exact_duplicates(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Groups of equal texts among the rows of ``docs`` (columns ``doc_id`` and ``text``).

    Texts are equal when they agree after white space is deleted; null is an empty text. The row with the most code
    points in its text stays, then the smallest id (null ids last), and of rows that also agree in this exactly one.
    Returns the columns named in ``carry``, doc_id, keep_id, group_size, kept, text_sha256, one row per row of ``docs``.
    An empty table gives an empty result; all other columns are left out, whatever their names.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    body = without_white_space(text)
    own = {f"carry_{i}": F.col(c) for i, c in enumerate(carry)}
    known = identities(docs, body, {**own, "doc_id": F.col("doc_id"), "chars": F.length(text), "text_sha256": F.sha2(body, 256)})
    known = stored(known.withColumn("row", F.monotonically_increasing_id()), "identities")
    order = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    groups = known.groupBy("blocks", "name").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    groups = stored(groups.select("blocks", "name", "n", "best.row", "best.doc_id").toDF("blocks", "name", "n", "best_row", "best_id"), "groups")
    alone = F.col("n").isNull()
    return known.join(groups, ["blocks", "name"], "left").select(
        *(F.col(k).alias(c) for k, c in zip(own, carry)),
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
        "text_sha256",
    )


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keyed = with_row_key(docs)
    kept = exact_duplicates(keyed, ROW_KEY).where("kept").select(*ROW_KEY)
    return keyed.join(kept, [*ROW_KEY], "left_semi").select(*docs.columns)
