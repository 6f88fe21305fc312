"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame functions only.

The words of a source are laid out in shards, each in a seeded order of its documents, and every shard is divided into
equal blocks of about ``BLOCK`` words. Seats, one for each block of words that the mix takes, go to sources by the highest
quotients target / (2k + 1), and a source's seats go to its shards in the same way. A shard with q seats and n
blocks takes every block q // n times and q % n of them once more: the run of blocks that starts at a seeded place. So
most documents are taken whole.

Only the sources and shards are ranked. All else is one sum over the documents of a shard, whose number of
documents is bounded: a source has as many shards as its size asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import ROW_KEY, WORD, stored, with_row_key

BLOCK = 16
SHARD_DOCS = 2_000
SEED = "mix-1"
MOST_TIMES = 3


def _draw(*parts: Column | str) -> Column:
    """32 seeded bits: the first eight hex digits of an MD5."""
    text = F.concat_ws("|", F.lit(SEED), *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def apportion(parties: DataFrame, group: list[str], party: str, votes: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: Sainte-Laguë seats of each party within its group.

    The seats of a group are given to the highest quotients votes / (2k + 1); equal quotients go to the smaller
    party. Every party surely has the seats that a slightly too small multiplier rounds it to, and at most those of a
    slightly too large one; only the quotients between, at most two for each party on average, have to be ranked.
    """
    own = Window.partitionBy(*group)
    low = (F.col(seats) - F.col("__n") / 2) / F.col("__all")
    high = (F.col(seats) + F.col("__n") / 2) / F.col("__all")
    rounded = lambda by: F.greatest(F.floor(F.col(votes) * by + F.lit(0.5)), F.lit(0)).cast("long")
    known = parties.withColumn("__all", F.sum(votes).over(own)).withColumn("__n", F.count(F.lit(1)).over(own))
    some = F.col("__all") > 0
    known = known.withColumn("__from", F.when(some, F.greatest(rounded(low) - 1, F.lit(0))).otherwise(F.lit(0)))
    known = known.withColumn("__to", F.when(some, rounded(high) + 1).otherwise(F.lit(0)))
    known = known.withColumn("__open", F.col(seats) - F.sum("__from").over(own))
    each = known.withColumn("__k", F.explode_outer(F.when(F.col("__to") > F.col("__from"), F.sequence(F.col("__from"), F.col("__to") - 1))))
    quotient = F.col(votes) / (2 * F.col("__k") + 1)
    rank = F.row_number().over(own.orderBy(quotient.desc_nulls_last(), F.col(party).asc_nulls_last(), "__k"))
    won = F.coalesce(((rank <= F.col("__open")) & F.col("__k").isNotNull()).cast("long"), F.lit(0))
    each = each.withColumn("__won", won)
    return each.groupBy(*parties.columns).agg((F.max("__from") + F.sum("__won")).alias("quota"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, source_size) with each source's ``target``.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share the sum of all sizes. A target stops at
    three times its source's size and the excess is shared again by weight: with sources ordered by size / weight,
    those before some place are full and the rest divide what is left.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("weight", (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    ranked = ranked.withColumn("cap", F.lit(MOST_TIMES) * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("weight"))
    order = everything.orderBy("fill", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / weights)
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "source", "level"))).over(everything)["level"]
    return ranked.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * level).alias("target"))


def mixed_documents(docs: DataFrame, carry: tuple[str, ...] = (), block: int = BLOCK, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """How many words of each document the mix takes; columns ``doc_id``, ``text`` and ``source`` are read.

    A document's size is its number of words; null and empty texts have size 0 and are taken 0 times. Null is a source of
    its own. What the mix takes of a source is a whole number of blocks, so less than half a block may be nothing. Rows with the same id and size share their places in a fixed but arbitrary order. An empty table gives
    an empty result. Returns the columns named in ``carry``, doc_id, size, source_size, target, taken, and where the
    part beyond whole copies lies: ``part_from`` and ``part_words`` (and the same for a second part, if the run of blocks
    goes over the shard's end within the document).
    """
    own = {f"carry_{i}": F.col(c) for i, c in enumerate(carry)}
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(*(c.alias(k) for k, c in own.items()), "doc_id", F.col("source").cast("string").alias("source"), size.alias("size"))
    sized = stored(sized.withColumn("mark", F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col("size").cast("string"))), "sizes")

    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = source_targets(sizes.select("source", "source_size")).withColumn("seats", F.lit(None).cast("long"))
    total = F.sum("target").over(Window.partitionBy(F.lit(0)))
    targets = targets.withColumn("seats", F.floor(total / block + F.lit(0.5))).withColumn("one", F.lit(0))
    quotas = apportion(targets, ["one"], "source", "target", "seats")
    same_source = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    plan = sizes.alias("s").join(quotas.alias("q"), same_source("s", "q")).select(
        "s.source", "s.source_size", "q.target", F.col("q.quota").alias("source_quota"), F.ceil(F.col("docs") / shard_docs).alias("shards")
    )
    plan = stored(plan, "source_plan")

    placed = sized.alias("d").join(plan.alias("p"), same_source("d", "p")).select("d.*", "p.source_size", "p.target", "p.source_quota", "p.shards")
    placed = placed.withColumn("shard", _draw(F.lit("shard"), F.col("mark")) % F.col("shards")).drop("shards")
    shards = placed.groupBy("source", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    shards = apportion(shards.withColumnRenamed("source_quota", "seats"), ["source"], "shard", "shard_size", "seats")
    shards = shards.withColumn("blocks", F.greatest(F.floor(F.col("shard_size") / block + F.lit(0.5)), F.lit(1)))
    shards = shards.withColumn("quota", F.least("quota", MOST_TIMES * F.col("blocks"))).where(F.col("shard_size") > 0)
    shards = shards.withColumn("times", F.floor(F.col("quota") / F.col("blocks"))).withColumn("more", F.col("quota") % F.col("blocks"))
    start = _draw(F.lit("start"), F.coalesce("source", F.lit("")), F.col("shard").cast("string")) % F.col("blocks")
    edge = lambda k: F.floor(k * F.col("shard_size") / F.col("blocks")).cast("long")
    shards = shards.withColumn("start", start)
    stop = F.col("start") + F.col("more")
    shards = shards.select(
        "source", "shard", "times",
        edge(F.col("start")).alias("run_from"), edge(F.least(stop, F.col("blocks"))).alias("run_to"),
        edge(F.greatest(stop - F.col("blocks"), F.lit(0))).alias("wrap_to"),
    )

    line = Window.partitionBy("source", "shard").orderBy(_draw(F.lit("order"), F.col("mark")), "mark")
    placed = placed.withColumn("ends", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    join = same_source("d", "h") & (F.col("d.shard") == F.col("h.shard"))
    taken = placed.alias("d").join(stored(shards, "shard_plan").alias("h"), join, "left").select("d.*", "h.times", "h.run_from", "h.run_to", "h.wrap_to")
    begins = F.col("ends") - F.col("size")
    overlap = lambda a, b: F.greatest(F.least(F.col("ends"), b) - F.greatest(begins, a), F.lit(0))
    run, wrap = overlap(F.col("run_from"), F.col("run_to")), overlap(F.lit(0), F.col("wrap_to"))
    return taken.select(
        *(F.col(k).alias(c) for k, c in zip(own, carry)),
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("times") * F.col("size") + run + wrap).cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.greatest(F.col("run_from") - begins, F.lit(0))).cast("long").alias("part_from"),
        F.when(F.col("size") > 0, run).cast("long").alias("part_words"),
        F.when(F.col("size") > 0, wrap).cast("long").alias("first_words"),
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: whole copies, and cut ones where a run of blocks starts or ends."""
    keyed = with_row_key(docs)
    plan = mixed_documents(keyed, ROW_KEY).where(F.col("taken") > 0)
    plan = plan.select(*ROW_KEY, *(F.col(c).alias(f"__{c}") for c in ("size", "taken", "part_from", "part_words", "first_words")))
    rows = keyed.join(plan, [*ROW_KEY])
    whole = F.floor((F.col("__taken") - F.col("__part_words") - F.col("__first_words")) / F.col("__size"))
    cut = lambda a, n: F.struct(a.cast("int").alias("a"), n.cast("int").alias("n"))
    uses = F.concat(
        F.array_repeat(cut(F.lit(0), F.col("__size")), whole.cast("int")),
        F.array(cut(F.col("__part_from"), F.col("__part_words")), cut(F.lit(0), F.col("__first_words"))),
    )
    rows = rows.withColumn("__use", F.explode(F.filter(uses, lambda u: u["n"] > 0)))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    text = F.when(F.col("__use.n") == F.col("__size"), F.col("text")).otherwise(F.array_join(F.slice(words, F.col("__use.a") + 1, F.col("__use.n")), " "))
    return rows.withColumn("text", text).select(*docs.columns)
