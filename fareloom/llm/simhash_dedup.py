"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2 bits have a common variant at distance 1 or less from both. So every distinct
fingerprint emits itself and its 64 one-bit variants, and the variants are shuffled. All fingerprints that meet at one
variant are within 2 bits of each other, and there are at most 65 of them; each is linked to the smallest, which joins
the same documents as all pairs would. Links are verified by their bit distance and made distinct.

Equal fingerprints are one fingerprint from the start, so a group of copies of any size is one row in all of this.
Tasks first turn the links they hold into stars, at most ``LINKS_EACH`` in a task; what then remains beyond that number goes
through alternating large-star and small-star steps, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import ROW_KEY, stored, with_row_key

SHINGLE_WORDS = 3
SEED = 42
MOST_STEPS = 60
LINKS_EACH = 1 << 20


def fingerprint(text: bytes, words_each: int = SHINGLE_WORDS, held: int = 1 << 16) -> int:
    """64-bit SimHash of the word shingles of one text, a signed integer; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    k = min(words_each, len(words))
    starts, stops = starts[: len(words) - k + 1].tolist(), stops[k - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), held):
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[at : at + held], stops[at : at + held])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<i8")[0])


def _fingerprints(words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("__text"))
            prints = [fingerprint(t.as_py() or b"", words_each) for t in text]
            kept = [i for i, name in enumerate(batch.schema.names) if name != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(prints, pa.int64())], names=[*(batch.schema.names[i] for i in kept), "print"]
            )

    return run


def links(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints in ``prints`` that connect all those within ``bits`` bits."""
    if bits not in (0, 1, 2):
        raise ValueError("one-bit variants meet for distances up to 2")
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)))
    variants = prints.select("print", F.explode(F.transform(flips, lambda m: F.col("print").bitwiseXOR(m))).alias("variant"))
    pairs = variants.withColumn("a", F.min("print").over(Window.partitionBy("variant"))).where(F.col("a") < F.col("print"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("print"))) <= bits
    if bits < 2:  # members of a ball of radius 1 may then be too far from its smallest
        return _close_pairs(variants, bits)
    return pairs.where(near).select("a", F.col("print").alias("b")).distinct()


def _close_pairs(variants: DataFrame, bits: int) -> DataFrame:
    """Pairs at a variant that is one of the two; each fingerprint has at most 64 of them."""
    own = variants.where(F.col("variant") == F.col("print")).select("variant", F.col("print").alias("a"))
    pairs = variants.join(own, "variant").where(F.col("a") < F.col("print"))
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("print"))) <= bits).select("a", F.col("print").alias("b")).distinct()


def _stars(most: int):
    """Links as stars, ``most`` at a time: every node of those beside the smallest that they lead to."""

    def stars(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        nodes, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        (a, b), least = at.reshape(2, -1), np.arange(len(nodes))
        while (least[a] != least[b]).any():
            np.minimum.at(least, np.maximum(least[a], least[b]), np.minimum(least[a], least[b]))
            while (least[least] != least).any():
                least = least[least]
        for i in range(0, len(nodes), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + (1 << 16)]), pa.array(nodes[least[i : i + (1 << 16)]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, most):
                part = batch.slice(first, most)
                if size + part.num_rows > most:
                    yield from stars(held)
                    held, size = [], 0
                held.append(np.stack([part.column(i).to_numpy() for i in (0, 1)]))
                size += part.num_rows
        if held:
            yield from stars(held)

    return run


def components(edges: DataFrame, links_each: int = LINKS_EACH) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node of its component.

    Tasks first turn their links into stars, at most ``links_each`` at a time. As many are done by then; more go through
    large-star and small-star steps until they are settled or so few.
    """
    edges, before = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links"), None
    if edges.count() > links_each:
        edges = stored(edges.mapInArrow(_stars(links_each), "u long, v long").where(F.col("u") != F.col("v")).distinct(), "stars")
    for step in range(MOST_STEPS):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] <= links_each:
            return stored(edges.coalesce(1).mapInArrow(_stars(links_each), "u long, v long"), "roots").select(F.col("u").alias("node"), F.col("v").alias("root"))
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = state
        # Large star: a node's larger neighbours move to its smallest one.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        larger = both.where(F.col("v") > F.col("u")).join(least, "u")
        edges = stored(larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"large_{step}")
        # Small star: a node and its smaller neighbours move to the smallest of these.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(moved.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), f"small_{step}")
    raise RuntimeError(f"components still change after {MOST_STEPS} steps")


def near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS, bits: int = 2, carry: tuple[str, ...] = ()) -> DataFrame:
    """Fingerprint and component of every row of ``docs`` (columns ``doc_id`` and ``text``).

    Texts without words (null, empty, white space) have the fingerprint 0 and link like any other. ``component_id`` is
    the smallest id reachable, null ids aside; it is null where all ids reachable are null. Repeated rows get equal
    results. An empty table gives an empty result. Returns the columns named in ``carry``, doc_id, fingerprint,
    component_id, and ``print``, the fingerprint as a signed integer.
    """
    own = {f"carry_{i}": F.col(c) for i, c in enumerate(carry)}
    rows = docs.select(*(c.alias(k) for k, c in own.items()), "doc_id", F.col("text").cast("string").cast("binary").alias("__text"))
    kept = rows.drop("__text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", print long"
    rows = stored(rows.mapInArrow(_fingerprints(words_each), schema), "prints")
    prints = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct_prints")
    roots = components(links(prints.select("print"), bits))
    linked = prints.join(roots, F.col("print") == F.col("node")).groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = roots.join(linked, "root").select(F.col("node").alias("print"), "component_id")
    named = prints.join(linked.withColumn("found", F.lit(True)), "print", "left").select(
        "print", F.when(F.col("found"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id")
    )
    return rows.join(stored(named, "print_components"), "print").select(
        *(F.col(k).alias(c) for k, c in zip(own, carry)),
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
        "print",
    )


def without_near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS, bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the one with the longest text, then the smallest id."""
    keyed = with_row_key(docs).withColumn("__chars", F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)))
    found = near_duplicates(keyed, words_each, bits, (*ROW_KEY, "__chars"))
    # Rows without any id in reach have no component id; their fingerprints still group them.
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("print"))]
    order = F.struct((-F.col("__chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW_KEY)
    best = found.groupBy(*(g.alias(f"g{i}") for i, g in enumerate(group))).agg(F.min(order).alias("best")).select(*(F.col(f"best.{k}") for k in ROW_KEY))
    return keyed.join(best, [*ROW_KEY], "left_semi").select(*docs.columns)
