"""LM scoring with a log-frequency Bloom filter.

Counts of words and word pairs are quantised on a logarithmic scale. An n-gram of level q enters the filter q
times, once with each of the numbers 1 to q, and a reader finds its level by probing 1, 2, ... until a probe fails.
The filter is built in blocks, one for each range of n-gram hashes, so it is made by many tasks and no task holds
more than its block.

Smoothing: absolute discounting of pairs over add-one words. Discount and back-off weight belong to classes of
histories of similar count, whose pair statistics come from the pass that builds the filter.

A scorer broadcasts the filter in rounds of at most ``FILTER_BYTES``. Texts are read and cut into words once, in pieces
of many rows; the different n-grams of a piece are stored by the round whose blocks they fall into. A round reads its own
n-grams only and stores their levels, and at the end each piece meets its levels and is scored. So every n-gram of a piece
is probed in one round, whatever their number, and the scores are the same for any number of rounds.

The base score needs exact counts. The commonest words (at most ``HEAD_WORDS``) are broadcast; the rest of the words of
each document are looked up by a join, in which no word has more rows than its count, and that is below the head's.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import (
    SpanHasher,
    counted,
    lowered,
    mixed,
    pieces_of,
    split_by_block,
    stored,
    summed_rows,
    text_blocks,
    text_buffer,
    text_bytes,
    word_spans,
)
from fareloom.workspace import remove_folders, scratch_path

HEAD_WORDS = 1 << 19
FILTER_BYTES = 32 << 20
PIECE_BYTES = 8 << 20  # of text, whose different n-grams are probed once
BITS_PER_ENTRY = 10
PROBES = 7
LOG_BASE = 1.5
BLOCK_TEXT = 8 << 20  # bytes of text for which one block of the filter is planned
BUFFERED = 2_000_000  # n-grams that a task holds before it passes their counts on

END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LEVELS = np.arange(256, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
_LOW = np.uint64(0xFFFFFFFF)

#: Classes of histories: 0 a word outside the head, 1 to 61 the level of a head word's count, 62 a text's begin.
CLASSES = 64
_BEGIN_CLASS = 62
_CLASS_BITS = np.uint64(63)

#: Smallest count of each level: 1, then powers of the base, whole and rising.
LEVEL_FROM = np.unique(np.ceil(LOG_BASE ** np.arange(0, 107) - 1e-9).astype(np.float64)).astype(np.int64)
#: The middle of each level's counts; level 0 stands for "not there".
LEVEL_COUNT = np.concatenate(([0.0], (LEVEL_FROM[:-1] + LEVEL_FROM[1:] - 1) / 2))


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVEL_FROM, counts, "right").astype(np.int64)


# --- the filter ----------------------------------------------------------------------------------


def _hashes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of (n-gram, level) and the step from one probe's hash to the next."""
    h = mixed(keys ^ _LEVELS[level])
    return h, (h >> np.uint64(32)) | np.uint64(1)


def _bit(h: np.ndarray, sizes: np.ndarray | np.uint64) -> np.ndarray:
    """Where a probe's bit lies in its block of ``sizes`` bits."""
    return (((h & _LOW) * sizes) >> np.uint64(32)).astype(np.int64)


def filter_block(keys: np.ndarray, counts: np.ndarray, per_entry: int = BITS_PER_ENTRY) -> tuple[bytes, int]:
    """The bits of one block, and how many there are."""
    levels = level_of(counts)
    size = max(64, int(levels.sum()) * per_entry)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        h, step = _hashes(keys[levels >= level], level)
        for _ in range(PROBES):
            bits[_bit(h, np.uint64(size))] = True
            h = h + step
    return np.packbits(bits).tobytes(), size


class FilterPart:
    """The blocks of one kind of n-gram that a round holds."""

    def __init__(self, bits: int, blocks: Iterable[tuple[int, int, bytes]], most: int | None = None) -> None:
        """``blocks`` are (number, bits, data); from an iterator they are copied one by one into ``most`` bytes."""
        if most is None:
            blocks = list(blocks)
            most = sum(len(data) for *_, data in blocks)
        self.bits = bits
        self.sizes = np.zeros(1 << bits, np.uint64)
        self.starts = np.zeros(1 << bits, np.int64)
        self.data = np.zeros(max(1, most), np.uint8)
        at = 0
        for block, size, data in blocks:
            self.sizes[block], self.starts[block] = size, at * 8
            self.data[at : at + len(data)] = np.frombuffer(data, np.uint8)
            at += len(data)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each n-gram; 0 for one that is not there or not in this round."""
        block = (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        found = np.zeros(len(keys), np.uint8)
        alive = np.flatnonzero(self.sizes[block] > 0)
        keys, sizes, starts = keys[alive], self.sizes[block[alive]], self.starts[block[alive]]
        level = 1
        while len(alive) and level < 255:
            h, step = _hashes(keys, level)
            for _ in range(PROBES):
                at = _bit(h, sizes) + starts
                there = (self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                alive, keys, sizes, starts, h, step = (x[there] for x in (alive, keys, sizes, starts, h, step))
                if not len(alive):
                    break
                h = h + step
            found[alive] = level
            level += 1
        return found


# --- counting ------------------------------------------------------------------------------------


def _sequences(batch_text: pa.Array, hasher: SpanHasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: their tokens' hashes with an end after each row, and tokens in each row."""
    data, offsets = text_buffer(batch_text)
    for first, last in pieces_of(offsets):
        part = lowered(data[offsets[first] : offsets[last]])
        within = offsets[first : last + 1] - offsets[first]
        starts, stops, counts = word_spans(part, within)
        tokens = np.empty(len(starts) + len(counts), np.uint64)
        ends = np.cumsum(counts + 1) - 1
        word = np.ones(len(tokens), bool)
        word[ends] = False
        tokens[ends] = END
        tokens[word] = hasher(part, starts, stops)
        yield first, last, tokens, counts + 1


def _histories(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(counts) - counts] = BEGIN
    return before


def _classes(words: np.ndarray, head_keys: np.ndarray, head_levels: np.ndarray) -> np.ndarray:
    classes = np.zeros(len(words), np.uint64)
    if len(head_keys):
        at = np.minimum(np.searchsorted(head_keys, words), len(head_keys) - 1)
        hit = head_keys[at] == words
        classes[hit] = np.minimum(head_levels[at[hit]], _BEGIN_CLASS - 1)
    classes[words == BEGIN] = _BEGIN_CLASS
    return classes


def _history_classes(words: np.ndarray, at: np.ndarray, counts: np.ndarray, head_keys: np.ndarray, head_levels: np.ndarray) -> np.ndarray:
    """Class of each token's history; the head is searched once for each of the different ``words``, in their order."""
    classes = np.empty(len(at), np.uint64)
    classes[1:] = _classes(words, head_keys, head_levels)[at[:-1]]
    classes[np.cumsum(counts) - counts] = _BEGIN_CLASS
    return classes


def _pair_keys(before: np.ndarray, tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Hashes of pairs whose last six bits are the history's class."""
    return (mixed(before * _PAIR + tokens) & ~_CLASS_BITS) | classes


_COUNTS_SCHEMA = "block long, keys binary, counts binary"


def _flush(held: list[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    keys, counts = counted(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
    rows = [(b, keys[s].tobytes(), counts[s].astype("<u4").tobytes()) for b, s in split_by_block(keys, bits)]
    for i in range(0, len(rows), 256):
        part = rows[i : i + 256]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in part], pa.int64()), *(pa.array([r[j] for r in part], pa.binary()) for j in (1, 2))],
            names=["block", "keys", "counts"],
        )
    held.clear()


def _counting(bits: int, key_of):
    """A task's counts of what ``key_of(tokens, counts)`` names, split by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = SpanHasher(), [], 0
        for batch in batches:
            for _, _, tokens, counts in _sequences(batch.column(0), hasher):
                held.append(counted(key_of(tokens, counts)))
                size += len(held[-1][0])
                if size > BUFFERED:
                    yield from _flush(held, bits)
                    size = 0
        yield from _flush(held, bits)

    return run


def _merge(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.frombuffer(k.as_py(), "<u8") for k in table.column("keys")])
    counts = np.concatenate([np.frombuffer(c.as_py(), "<u4") for c in table.column("counts")]).astype(np.int64)
    return counted(keys, counts)


_WORD_BLOCKS = "block long, keys binary, counts binary, bits binary, size long, total long, distinct long"


def _word_block(key: tuple, table: pa.Table, per_entry: int) -> pa.Table:
    keys, counts = _merge(table)
    bits, size = filter_block(keys, counts, per_entry)
    columns = (key[0].as_py(), keys.tobytes(), counts.astype("<u8").tobytes(), bits, size, int(counts.sum()), len(keys))
    names = [c.split()[0] for c in _WORD_BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array([v], t) for v, t in zip(columns, kinds)], names=names)


_PAIR_BLOCKS = "block long, bits binary, size long, stats array<long>"


def _pair_block(key: tuple, table: pa.Table, per_entry: int) -> pa.Table:
    keys, counts = _merge(table)
    bits, size = filter_block(keys, counts, per_entry)
    classes = (keys & _CLASS_BITS).astype(np.int64)
    stats = np.concatenate(
        [
            np.bincount(classes, weights=counts, minlength=CLASSES),
            np.bincount(classes, minlength=CLASSES),
            np.bincount(classes[counts == 1], minlength=CLASSES),
            np.bincount(classes[counts == 2], minlength=CLASSES),
        ]
    ).astype(np.int64)
    return pa.table(
        [pa.array([key[0].as_py()], pa.int64()), pa.array([bits], pa.binary()), pa.array([size], pa.int64()), pa.array([stats.tolist()], pa.list_(pa.int64()))],
        names=["block", "bits", "size", "stats"],
    )


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts.astype(np.float64)) * 8 + 1e-9).astype(np.int64)


def _bucket_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for counts in batch.column(0):
            bucket, n = counted(_bucket(np.frombuffer(counts.as_py(), "<u8")))
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(n, pa.int64())], names=["bucket", "n"])


def _words(from_bucket: int, inside: bool):
    """Words of the head (``inside``) or of the rest, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                keys, counts = np.frombuffer(keys.as_py(), "<u8"), np.frombuffer(counts.as_py(), "<u8")
                kept = (_bucket(counts) >= from_bucket) == inside
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[kept].view(np.int64)), pa.array(counts[kept].astype(np.int64))], names=["word", "count"]
                )

    return run


# --- the model -----------------------------------------------------------------------------------


@dataclass
class LanguageModel:
    """Tables and figures of a trained model. ``words`` and ``pairs`` hold the filter's blocks."""

    bits: int
    words: DataFrame
    pairs: DataFrame
    tokens: int
    vocabulary: int
    texts: int
    head_keys: np.ndarray
    head_counts: np.ndarray
    head_from: int
    discount: np.ndarray
    backoff: np.ndarray


def train(texts: DataFrame, head_words: int = HEAD_WORDS, per_entry: int = BITS_PER_ENTRY) -> LanguageModel:
    """Count words and pairs of all rows of ``texts`` (column ``text``; null is an empty text).

    Without rows the model has no tokens and gives every token the probability 1 of the add-one rule.
    """
    texts = texts.select(F.col("text").cast("string").alias("text"))
    bits = text_blocks(text_bytes(texts), BLOCK_TEXT)
    words = stored(
        texts.mapInArrow(_counting(bits, lambda tokens, counts: tokens), _COUNTS_SCHEMA)
        .groupBy("block")
        .applyInArrow(lambda key, table: _word_block(key, table, per_entry), _WORD_BLOCKS),
        "lm_words",
    )
    total = words.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    sizes = words.select("counts").mapInArrow(_bucket_sizes, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    head_from, room = 1 << 30, head_words
    for row in sorted(sizes, key=lambda r: -r["bucket"]):
        room -= row["n"]
        if room < 0:
            break
        head_from = row["bucket"]
    head = words.select("keys", "counts").mapInArrow(_words(head_from, True), "word long, count long").toArrow()
    keys = head.column("word").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, head_counts = keys[order], head.column("count").to_numpy()[order].astype(np.int64)

    shared = texts.sparkSession.sparkContext.broadcast((keys, level_of(head_counts)))

    def pair_keys(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        words, at = np.unique(tokens, return_inverse=True)
        return _pair_keys(_histories(tokens, counts), tokens, _history_classes(words, at, counts, *shared.value))

    pairs = stored(
        texts.mapInArrow(_counting(bits, pair_keys), _COUNTS_SCHEMA)
        .groupBy("block")
        .applyInArrow(lambda key, table: _pair_block(key, table, per_entry), _PAIR_BLOCKS),
        "lm_pairs",
    )
    stats = np.zeros(4 * CLASSES)
    for row in pairs.select(F.posexplode("stats").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():
        stats[row["at"]] = row["n"]
    seen, kinds, once, twice = stats.reshape(4, CLASSES)
    discount = np.clip((once + 0.5) / (once + 2 * twice + 1.0), 0.05, 0.95)
    backoff = np.where(seen > 0, discount * kinds / np.maximum(seen, 1), 1.0)
    return LanguageModel(bits, words, pairs, total["n"] or 0, total["v"] or 0, int(seen[_BEGIN_CLASS]), keys, head_counts, head_from, discount, backoff)


def filter_rounds(model: LanguageModel, most: int = FILTER_BYTES) -> list[dict[tuple[str, int], int]]:
    """Bytes of the filter's blocks, by kind and number, in rounds of at most ``most`` bytes. Only numbers and sizes are read."""
    rounds, room = [{}], most
    for kind, table in (("words", model.words), ("pairs", model.pairs)):
        for row in table.select("block", "size").orderBy("block").toLocalIterator():
            size = -(-row["size"] // 8)
            room -= size
            if room < 0 and rounds[-1]:
                rounds.append({})
                room = most - size
            rounds[-1][kind, row["block"]] = size
    return rounds


def _part(model: LanguageModel, kind: str, sizes: dict[tuple[str, int], int]) -> FilterPart:
    numbers = [b for k, b in sizes if k == kind]
    if not numbers:
        return FilterPart(model.bits, ())
    table = model.words if kind == "words" else model.pairs
    rows = table.where(F.col("block").between(min(numbers), max(numbers))).select("block", "size", "bits").toLocalIterator()
    blocks = ((r["block"], r["size"], r["bits"]) for r in rows)
    return FilterPart(model.bits, blocks, sum(n for (k, _), n in sizes.items() if k == kind))


# --- scoring -------------------------------------------------------------------------------------

_KINDS = ("words", "pairs")


def _pieces(carried: int, most: int):
    """Rows in pieces: the carried columns as lists, tokens in each row, different words, and which of them each token is."""

    def piece(columns: list[list], counts: list[np.ndarray], tokens: list[np.ndarray], types: list[pa.DataType]) -> pa.RecordBatch:
        words, at = np.unique(np.concatenate(tokens), return_inverse=True)
        arrays = [pa.array([c], pa.list_(t)) for c, t in zip(columns, types)]
        arrays += [pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in ((np.concatenate(counts), "<u4"), (words, "<u8"), (at, "<u4"))]
        return pa.RecordBatch.from_arrays(arrays, [*(f"own_{i}" for i in range(carried)), "counts", "words", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, columns, counts, tokens, size, types = SpanHasher(), [[] for _ in range(carried)], [], [], 0, []
        for batch in batches:
            types = [batch.schema.field(i).type for i in range(carried)]
            for first, last, found, sizes in _sequences(batch.column(carried), hasher):
                if size and size + 8 * len(found) > most:
                    yield piece(columns, counts, tokens, types)
                    columns, counts, tokens, size = [[] for _ in range(carried)], [], [], 0
                for i in range(carried):
                    columns[i] += batch.column(i).slice(first, last - first).to_pylist()
                counts.append(sizes)
                tokens.append(found)
                size += 8 * len(found)
        if counts:
            yield piece(columns, counts, tokens, types)

    return run


class _Piece:
    """The tokens of one piece, its different words and pairs in the order of their hashes."""

    def __init__(self, counts: bytes, words: bytes, at: bytes, head_keys: np.ndarray, head_levels: np.ndarray) -> None:
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.words, self.at = np.frombuffer(words, "<u8"), np.frombuffer(at, "<u4")
        self.tokens = self.words[self.at]
        self.classes = _history_classes(self.words, self.at, self.counts, head_keys, head_levels)
        self.pairs = _pair_keys(_histories(self.tokens, self.counts), self.tokens, self.classes)


def _split(shared, round_of: dict[str, np.ndarray], bits: int):
    """The different words and pairs of each piece by the round that holds their block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, counts, words, at in zip(*(batch.column(c) for c in ("piece", "counts", "words", "at"))):
                piece = _Piece(counts.as_py(), words.as_py(), at.as_py(), *shared.value)
                rows = []
                for kind, keys in zip(_KINDS, (piece.words, counted(piece.pairs)[0])):
                    rounds = round_of[kind][(keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)]
                    edges = np.flatnonzero(np.diff(rounds, prepend=-2, append=-2))
                    rows += [(kind, int(rounds[a]), keys[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([pa.array([number.as_py()] * len(rows), pa.int64()), *columns], ["piece", "kind", "round", "keys"])

    return run


def _probed(shared):
    """The levels of a round's n-grams, found by probing its part of the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = [shared.value[kind.as_py()].levels(np.frombuffer(keys.as_py(), "<u8")).tobytes() for kind, keys in zip(batch.column("kind"), batch.column("keys"))]
            yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("kind"), pa.array(levels, pa.binary())], ["piece", "kind", "levels"])

    return run


class _Scorer:
    """Scores the rows of one piece, given the levels of its n-grams round by round."""

    def __init__(self, shared, carried: int) -> None:
        self.shared, self.carried = shared, carried

    def __call__(self, pieces: pa.Table, levels: pa.Table) -> pa.Table:
        row = {c: pieces[c][0] for c in pieces.schema.names}
        piece = _Piece(row["counts"].as_py(), row["words"].as_py(), row["at"].as_py(), *self.shared.value[:2])
        levels = levels.sort_by("round")
        of = {kind: b"".join(v.as_py() for k, v in zip(levels["kind"], levels["levels"]) if k.as_py() == kind) for kind in _KINDS}
        distinct, back = np.unique(piece.pairs, return_inverse=True)
        found = np.stack([np.frombuffer(of["words"], np.uint8)[piece.at], np.frombuffer(of["pairs"], np.uint8)[back]])
        scores = summed_rows(np.log10(self._probabilities(piece, found)), piece.counts)
        own = [pieces[f"own_{i}"].combine_chunks().flatten() for i in range(self.carried)]
        names = [*(f"own_{i}" for i in range(self.carried)), "n_tokens", "n_known", "base", "score", "words", "times"]
        return pa.table([*own, *self._base(piece, scores)], names)

    def _probabilities(self, piece: _Piece, found: np.ndarray) -> np.ndarray:
        total, vocabulary, texts, discount, backoff = self.shared.value[3:]
        own = LEVEL_COUNT[found[0]]
        single = (own + 1.0) / (total + vocabulary + 1.0)
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[np.cumsum(piece.counts) - piece.counts] = texts
        classes = piece.classes.astype(np.int64)
        pair = np.minimum(LEVEL_COUNT[found[1]], np.minimum(own, before))
        seen = before > 0
        weight = np.where(seen, backoff[classes], 1.0)
        direct = np.where(seen, np.maximum(pair - discount[classes], 0.0) / np.maximum(before, 1.0), 0.0)
        return np.minimum(direct + weight * single, 1.0)

    def _base(self, piece: _Piece, scores: np.ndarray) -> list[pa.Array]:
        """Exact sums over head words; the other words of each row with their times."""
        head_keys, _, head_counts = self.shared.value[:3]
        tokens, counts = piece.tokens, piece.counts
        hit, logs = np.zeros(len(tokens), bool), np.zeros(len(tokens))
        if len(head_keys):
            at = np.minimum(np.searchsorted(head_keys, piece.words), len(head_keys) - 1)
            known, of = head_keys[at] == piece.words, np.log10(head_counts[at] + 1.0)
            hit, logs = known[piece.at], np.where(known, of, 0.0)[piece.at]
        cuts = np.concatenate(([0], np.cumsum(counts)))
        rest = [counted(tokens[a:b][~hit[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
        return [
            pa.array(counts, pa.int64()),
            pa.array(summed_rows(hit.astype(np.float64), counts).astype(np.int64)),
            pa.array(summed_rows(logs, counts)),
            pa.array(scores),
            pa.array([words.tobytes() for words, _ in rest], pa.binary()),
            pa.array([times.astype("<u4").tobytes() for _, times in rest], pa.binary()),
        ]


def _rest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document and word outside the head."""
    for batch in batches:
        held, n = [], 0
        for row, words, times in zip(batch.column(0).to_numpy(), batch.column(1), batch.column(2)):
            words = np.frombuffer(words.as_py(), "<i8")
            held.append((np.full(len(words), row, np.int64), words, np.frombuffer(times.as_py(), "<u4").astype(np.int64)))
            n += len(words)
            if n > 100_000:
                yield _rest_batch(held)
                held, n = [], 0
        if held:
            yield _rest_batch(held)


def _rest_batch(held: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([h[i] for h in held])) for i in range(3)], names=["row", "word", "times"])


def score_documents(
    docs: DataFrame,
    held_out: Column,
    filter_bytes: int = FILTER_BYTES,
    head_words: int = HEAD_WORDS,
    piece_bytes: int = PIECE_BYTES,
    per_entry: int = BITS_PER_ENTRY,
) -> DataFrame:
    """Base and model scores of every row of ``docs`` (columns ``doc_id`` and ``text``, others are left out).

    The model learns from the rows where ``held_out`` is false. A null text is an empty one: it consists of its end.
    Rows with the same id are scored each by itself. An empty table gives an empty result. Texts of any length are read
    whole, one at a time if longer than a piece. Words are told apart by a 64-bit hash. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    model = train(docs.where(~F.col("held_out")), head_words, per_entry)
    rounds = filter_rounds(model, filter_bytes)
    round_of = {kind: np.full(1 << model.bits, -1) for kind in _KINDS}
    for number, sizes in enumerate(rounds):
        for kind, block in sizes:
            round_of[kind][block] = number

    kind_of = lambda c: docs.schema[c].dataType.simpleString()
    pieces = docs.mapInArrow(_pieces(2, piece_bytes), f"own_0 array<{kind_of('doc_id')}>, own_1 array<boolean>, counts binary, words binary, at binary")
    pieces = stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "lm_pieces")
    head = spark.sparkContext.broadcast((model.head_keys, level_of(model.head_counts)))
    asked = scratch_path(spark, "lm_ngrams")
    split = pieces.select("piece", "counts", "words", "at").mapInArrow(_split(head, round_of, model.bits), "piece long, kind string, round long, keys binary")
    split.write.partitionBy("round").option("compression", "zstd").parquet(asked)
    ngrams = spark.read.schema("piece long, kind string, keys binary, round long").parquet(asked)
    found = scratch_path(spark, "lm_levels")
    for number, sizes in [(-1, {}), *enumerate(rounds)]:  # -1: n-grams of blocks that the filter does not have
        part = spark.sparkContext.broadcast({kind: _part(model, kind, sizes) for kind in _KINDS})
        levels = ngrams.where(F.col("round") == number).select("piece", "kind", "keys").mapInArrow(_probed(part), "piece long, kind string, levels binary")
        levels.write.option("compression", "zstd").parquet(f"{found}/round={number}")
        part.unpersist()
        remove_folders(spark, [f"{asked}/round={number}"])
    levels = spark.read.schema("piece long, kind string, levels binary, round long").parquet(found)
    shared = spark.sparkContext.broadcast(
        (
            model.head_keys, level_of(model.head_counts), model.head_counts,
            float(model.tokens), float(model.vocabulary), float(model.texts), model.discount, model.backoff,
        )
    )
    schema = f"own_0 {kind_of('doc_id')}, own_1 boolean, n_tokens long, n_known long, base double, score double, words binary, times binary"
    score = _Scorer(shared, 2)
    scored = pieces.groupBy("piece").cogroup(levels.groupBy("piece")).applyInArrow(lambda piece, levels: score(piece, levels), schema)
    work = scored.withColumnsRenamed({"own_0": "doc_id", "own_1": "held_out"}).withColumn("row", F.monotonically_increasing_id())
    work = stored(work, "lm_scores")

    rest = work.select("row", "words", "times").mapInArrow(_rest_rows, "row long, word long, times long")
    counts = model.words.select("keys", "counts").mapInArrow(_words(model.head_from, False), "word long, count long")
    rest = rest.join(counts, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("count") + F.lit(1.0))).alias("rest_logs"), F.sum("times").alias("rest_known")
    )
    denominator = float(np.log10(model.tokens + model.vocabulary + 1.0))
    return work.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(denominator)).alias("base_score"),
        "score",
    )
