"""Audit of how sources differ within a language, by count-level bitmaps.

Terms that enough documents of a language hold are numbered, the commonest first, so that neighbours have like counts.
For each (source, count) of a language the numbers of its terms are a set of bits, in words of 64. Two sources' sets
are combined by AND, and the bits that remain are the terms which occur ``c`` times here and ``d`` times there: one
joint cell, worth the difference of the two shares, ``f(c, d)``. Terms of count zero are never stored; their set is the
complement of the others. The work is that of the cells, not of the terms: in a word of rare terms a few counts per
source stand for 64 terms.

Shares are whole billionths and all sums are of whole numbers, so results do not depend on the order of tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import stored

LEAST_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Terms that one task compares, and sources that it compares at once; more of either are more tasks.
SPAN = 1024
BUCKET = 256
#: Different terms that a task counts before it hands them on.
HELD = 400_000
#: Cells of one step.
CELLS = 1 << 21

_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by (lang, source); a null term stands for the group itself."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (words, docs) in held.items():
            terms = [None, *(w.decode() for w in words)]
            columns = [[lang] * len(terms), [source] * len(terms), terms, [0, *words.values()], [0, *(docs[w] for w in words)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns[:2]), batch.column(2)):
            terms = (text.as_py() or "").encode().translate(_TERM_BYTES).split()
            words, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words.update(terms)
            docs.update(set(terms))
        if sum(len(words) for words, _ in held.values()) > HELD:
            yield from flushed()
    yield from flushed()


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` of each term and its documents ``docs`` by (lang, source); every group has a row with a null term."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms))``, in decimals, so exact for any count; 1 without terms."""
    exact = lambda c: c.cast("decimal(20,0)")
    whole = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * exact(n + PRIOR), exact(F.greatest(total + PRIOR * terms, F.lit(1))))
    return F.lit(1) + F.when(terms > 0, whole).otherwise(0)


def joint_cells(table: pa.Table, bucket: int = BUCKET) -> pa.Table:
    """Of one span of terms and two buckets of sources: for each ordered pair of sources the sum over joint cells.

    Rows are the sets of one (source, count) in one word of terms; those with count 0 hold all terms of the word and get
    the complement of the source's other sets.
    """
    rows = {c: table[c].to_numpy() for c in ("word", "source_no", "n", "share", "bits")}
    lang, left, right = (table[c][0].as_py() for c in ("lang", "left", "right"))
    order = np.lexsort((rows["n"], rows["source_no"], rows["word"]))
    word, source, n, p, bits = (rows[c][order] for c in ("word", "source_no", "n", "share", "bits"))
    bits = bits.view(np.uint64).copy()
    zeros = np.flatnonzero(n == 0)  # the first row of each source in each word
    seen = bits.copy()
    seen[zeros] = 0
    bits[zeros] &= ~np.bitwise_or.reduceat(seen, zeros)
    sums: dict[tuple[int, int], int] = {}
    edges = np.flatnonzero(np.diff(word, prepend=word[0] - 1, append=word[-1] + 1))
    for a, b in zip(edges[:-1], edges[1:]):
        other = np.arange(a, b)[source[a:b] // bucket == right]
        starts = np.flatnonzero(np.diff(source[other], prepend=-1))
        mine = np.arange(a, b)[source[a:b] // bucket == left]
        step = max(1, CELLS // max(1, len(other)))
        for part in (mine[i : i + step] for i in range(0, len(mine), step)):
            both = np.bitwise_count(bits[part, None] & bits[None, other]).astype(np.int64)
            both *= np.abs(p[part, None] - p[None, other])
            both = np.add.reduceat(both, starts, axis=1)
            own = np.flatnonzero(np.diff(source[part], prepend=-1))
            both = np.add.reduceat(both, own, axis=0)
            for s, values in zip(source[part][own].tolist(), both.tolist()):
                for t, value in zip(source[other][starts].tolist(), values):
                    sums[s, t] = sums.get((s, t), 0) + value
    pairs = [(s, t, v) for (s, t), v in sums.items() if s != t]
    if left != right:
        pairs += [(t, s, v) for s, t, v in pairs]
    columns = list(zip(*pairs)) or [(), (), ()]
    return pa.table({"lang": pa.array([lang] * len(pairs), pa.string()), **{c: pa.array(v, pa.int64()) for c, v in zip(("source_no", "item_no", "value"), columns)}})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, span: int = SPAN, bucket: int = BUCKET) -> DataFrame:
    """How the sources of each language differ: lang, source, part, item, value, rank.

    Part ``pair`` has every other source of the language, with the sum over all kept terms of the difference of shares;
    part ``term`` the ``top`` kept terms of which the source has more than its language. Ranks go by value, then by item
    in UTF-8 order. A term is kept that occurs in ``least_docs`` documents of the language.

    Null lang, source and text count as empty strings, so they are a language, a source and a text without terms. Groups
    without terms take part with the share of count zero. A language without kept terms has pairs of value 0; one with a
    single source has no pair; an empty table gives an empty result. Repeated rows count as often as they occur; other
    columns are not read. A task holds the terms of one text, at most ``HELD`` counted terms beside it, and
    ``span`` terms (a multiple of 64) of two times ``bucket`` sources.
    """
    counts = stored(term_counts(docs), "term_counts")
    by_term = counts.where(F.col("term").isNotNull()).groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = by_term.where(F.col("docs") >= least_docs).select("lang", "term", "total").orderBy("lang", F.desc("total"), "term")
    kept = stored(kept.withColumn("id", F.monotonically_increasing_id()), "kept_terms")
    cells = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total", "id"), "cells")

    langs = counts.groupBy("lang").agg(F.lit(0).alias("none")).join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total")), "lang", "left")
    langs = langs.select("lang", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("v", "lang_total")))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    groups = counts.where(F.col("term").isNull()).select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang")
    numbered = Window.partitionBy("lang").orderBy("source")  # one row for each source
    groups = groups.select(
        "lang", "source", "v", "lang_total", F.coalesce("source_total", F.lit(0)).alias("source_total"), (F.row_number().over(numbered) - 1).cast("long").alias("source_no")
    )
    groups = stored(groups, "groups")

    shared = cells.join(groups, ["lang", "source"]).withColumn("share", share(F.col("n"), F.col("source_total"), F.col("v")))
    place = {"span": F.floor(F.col("id") / span), "word": F.floor(F.col("id") / 64)}
    bit = F.expr("shiftleft(1L, cast(id % 64 as int))")
    sets = shared.withColumns(place).groupBy("lang", "span", "word", "source_no", "n", "share").agg(F.bit_or(bit).alias("bits"))
    words = kept.withColumns(place).groupBy("lang", "span", "word").agg(F.bit_or(bit).alias("bits"))
    words = words.unionByName(langs.select("lang", F.lit(-1).cast("long").alias("span"), F.lit(-1).cast("long").alias("word"), F.lit(0).cast("long").alias("bits")))
    none = words.join(groups, "lang").select(
        "lang", "span", "word", "source_no", F.lit(0).cast("long").alias("n"), share(F.lit(0), F.col("source_total"), F.col("v")).alias("share"), "bits"
    )
    most = groups.groupBy("lang").agg(F.floor(F.max("source_no") / bucket).alias("last_bucket"))
    return _pairs(sets.unionByName(none).join(most, "lang"), groups, bucket).unionByName(_terms(shared, top))


def _pairs(sets: DataFrame, groups: DataFrame, bucket: int) -> DataFrame:
    own = F.floor(F.col("source_no") / bucket)
    partners = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("last_bucket")), lambda b: F.struct(F.least(own, b).alias("left"), F.greatest(own, b).alias("right"))
    )
    dealt = sets.withColumn("partner", F.explode(partners)).select("lang", "span", "partner.*", "word", "source_no", "n", "share", "bits")
    cells = dealt.groupBy("lang", "span", "left", "right").applyInArrow(lambda table: joint_cells(table, bucket), "lang string, source_no long, item_no long, value long")
    values = cells.groupBy("lang", "source_no", "item_no").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "source_no", "source")
    named = values.join(names, ["lang", "source_no"]).join(names.toDF("lang", "item_no", "item"), ["lang", "item_no"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(shared: DataFrame, top: int) -> DataFrame:
    more = F.col("share") - share(F.col("total"), F.col("lang_total"), F.col("v"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    rows = shared.select("lang", "source", "term", more.alias("value")).where(F.col("value") > 0).withColumn("rank", rank)
    return rows.where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
