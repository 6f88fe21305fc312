"""Language identification by word-first backoff.

A known word counts with its log frequency in each language. An unseen word counts with its character n-grams: the
longest length of which at least one n-gram is known, from ``LONGEST`` down to 1, with the mean of their log frequencies.

The tables are learned from at most about ``DOCS_EACH`` documents of each language. All words and n-grams of these
documents are known, in every language; tables hold one entry for each language that a word or n-gram occurs in, so
they grow with the sample and not with the number of languages times it. Every document is scored with its whole text.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import NOT_LETTER, SpanHasher, bounded_sample, counted, pieces_of, stored, text_buffer, word_spans

DOCS_EACH = 2000
LONGEST = 5
SMOOTH = 100.0  # occurrences of a language's share that follow all languages together
NONE = "und"
_UNIT = 1 << 20  # weights of n-grams are summed as whole numbers, so that their order does not matter


@dataclass
class Entries:
    """Words or n-grams by hash. Each has, for every language it occurs in, what it adds to that language's score."""

    keys: np.ndarray  # sorted hashes
    firsts: np.ndarray  # the first entry of each, and the number of entries
    langs: np.ndarray
    gains: np.ndarray  # beyond a language without it

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known, and where."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        return known, at[known]

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All entries of the keys at ``at``: the place in ``at``, the language and the gain."""
        own, owner = _ranges(self.firsts[at], self.firsts[at + 1])
        return owner, self.langs[own], self.gains[own]


@dataclass
class LanguageTables:
    languages: list[str]
    words: Entries
    grams: list[Entries]  # by length, from 1
    sizes: np.ndarray  # log of each language's text, for words (row 0) and n-grams of each length; a last row of zeros


def _ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    sizes = stops - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner], owner


def _hashed(words: list[bytes], hasher: SpanHasher) -> np.ndarray:
    stops = np.cumsum([len(w) for w in words], dtype=np.int64)
    return hasher(np.frombuffer(b"".join(words), np.uint8), stops - [len(w) for w in words], stops)


def _grams(words: list[bytes], n: int, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of ``<word>``, and the word of each."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8)
    stops = np.cumsum([len(w) + 2 for w in words], dtype=np.int64)
    edges = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    owner = np.searchsorted(stops, edges[:-1], "right")
    at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :]) if len(owner) >= n else np.zeros(0, np.int64)
    return hasher(data, edges[at], edges[at + n]), owner[at]


def _span_words(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), stops.tolist())]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of each language in a task's rows."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        lowered = pc.utf8_lower(batch.column(1))
        for language, text in zip(batch.column(0).to_pylist(), lowered):
            data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            starts, stops, _ = word_spans(data, np.array([0, len(data)]), NOT_LETTER)
            counts[language].update(_span_words(data, starts, stops))
    for language, words in counts.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(words), pa.string()), pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())],
            names=["lang", "word", "n"],
        )


def _keyed(at: dict[str, int]):
    """Hashes and counts of words (size 0), and hashes and weights of their n-grams, by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            langs = np.array([at[x] for x in batch.column(0).to_pylist()], np.int64)
            weights = np.rint(np.log1p(n) * _UNIT).astype(np.int64)
            found = [(0, _hashed(words, hasher), langs, n)]
            for size in range(1, LONGEST + 1):
                keys, owner = _grams(words, size, hasher)
                order = np.argsort(langs[owner], kind="stable")
                keys, owner = keys[order], owner[order]
                own, firsts = np.unique(langs[owner], return_index=True)
                for lang, a, b in zip(own, firsts, np.append(firsts[1:], len(owner))):
                    grams, sums = counted(keys[a:b], weights[owner[a:b]])
                    found.append((size, grams, np.full(len(grams), lang), sums))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int32)),
                    pa.array(np.concatenate([f[1] for f in found]).view(np.int64)),
                    pa.array(np.concatenate([f[2] for f in found]).astype(np.int32)),
                    pa.array(np.concatenate([f[3] for f in found])),
                ],
                names=["size", "key", "at", "n"],
            )

    return run


def learn(docs: DataFrame, train: Column, docs_each: int = DOCS_EACH) -> LanguageTables | None:
    """Tables from the rows of ``docs`` (doc_id, text, lang) where ``train`` holds and lang is known; None without any."""
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = bounded_sample(rows, "lang", docs_each, F.col("doc_id")).select("lang", "text").mapInArrow(_word_counts, "lang string, word binary, n long")
    counts = stored(counts.groupBy("word", "lang").agg(F.sum("n").alias("n")).select("lang", "word", "n"), "language_words")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return None
    keyed = counts.mapInArrow(_keyed({x: i for i, x in enumerate(languages)}), "size int, key long, at int, n long")
    keyed = stored(keyed.groupBy("size", "key", "at").agg(F.sum("n").alias("n")), "language_keys")
    made = [_entries(keyed.where(F.col("size") == size).select("key", "at", "n").toArrow(), len(languages), _UNIT if size else 1) for size in range(LONGEST + 1)]
    return LanguageTables(languages, made[0][0], [m[0] for m in made[1:]], np.array([*(m[1] for m in made), np.zeros(len(languages))]))


def _entries(table: pa.Table, languages: int, unit: int) -> tuple[Entries, np.ndarray]:
    """Gains in each language, and the log sizes of the languages.

    Frequencies in each language are drawn a little to those in all, so that little text is no advantage:
    (n + share) / (size + SMOOTH), where share is SMOOTH times the frequency in all languages. What share / (size + SMOOTH)
    gives is the same for all languages but for their sizes, so only the rest is kept.
    """
    keys, langs = table.column("key").to_numpy().view(np.uint64), table.column("at").to_numpy()
    order = np.lexsort((langs, keys))
    keys, langs, n = keys[order], langs[order], table.column("n").to_numpy()[order] / unit
    firsts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    edges = np.append(firsts, len(keys))
    each = np.add.reduceat(n, firsts) / n.sum() if len(keys) else np.zeros(0)
    gains = np.log1p(n / (SMOOTH * np.repeat(each, np.diff(edges)))).astype(np.float32)
    return Entries(keys[firsts], edges, langs, gains), np.log(np.bincount(langs, weights=n, minlength=languages) + SMOOTH)


class Detector:
    """Scores many texts at once."""

    def __init__(self, tables: LanguageTables) -> None:
        self.tables, self.hasher = tables, SpanHasher()

    def _unseen(self, words: list[bytes], kinds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (word, language, gain) of words that are not in the tables; sets the row of ``sizes`` of each word."""
        left = np.arange(len(words))
        for n in range(LONGEST, 0, -1):
            if not len(left):
                return
            keys, owner = _grams([words[i] for i in left], n, self.hasher)
            known, at = self.tables.grams[n - 1].find(keys)
            owner = owner[known]
            among = np.bincount(owner, minlength=len(left))
            gram, langs, gains = self.tables.grams[n - 1].of(at)
            yield left[owner[gram]], langs, gains / among[owner[gram]]
            kinds[left[among > 0]] = n
            left = left[among == 0]

    def _distinct(self, part: np.ndarray, starts: np.ndarray, stops: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The row of ``sizes`` and the entries (firsts, languages, gains) of distinct words."""
        kinds = np.full(len(keys), LONGEST + 1)
        known, at = self.tables.words.find(keys)
        kinds[known] = 0
        owner, langs, gains = self.tables.words.of(at)
        found = [(np.flatnonzero(known)[owner], langs, gains)]
        new = np.flatnonzero(~known)
        for a, b in pieces_of(np.concatenate(([0], np.cumsum((stops - starts)[new])))):
            own = kinds[new[a:b]]
            for word, langs, gains in self._unseen(_span_words(part, starts[new[a:b]], stops[new[a:b]]), own):
                found.append((new[a:b][word], langs, gains))
            kinds[new[a:b]] = own
        owner, langs, gains = (np.concatenate([f[k] for f in found]) for k in range(3))
        order = np.argsort(owner, kind="stable")
        return kinds, np.searchsorted(owner[order], np.arange(len(keys) + 1)), langs[order], gains[order]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of the best language of each text, -1 without letters, and its probability."""
        data, offsets = text_buffer(pc.utf8_lower(texts.cast(pa.large_string())))
        best, sure, languages = [], [], len(self.tables.languages)
        for first, last in pieces_of(offsets, (1 << 25) // max(16, languages)):
            part = data[offsets[first] : offsets[last]]
            starts, stops, counts = word_spans(part, offsets[first : last + 1] - offsets[first], NOT_LETTER)
            keys, where, back = np.unique(self.hasher(part, starts, stops), return_index=True, return_inverse=True)
            kinds, firsts, langs, gains = self._distinct(part, starts[where], stops[where], keys)
            rows = np.repeat(np.arange(last - first), counts)
            own, word = _ranges(firsts[back], firsts[back + 1])
            sums = np.bincount(rows[word] * languages + langs[own], weights=gains[own], minlength=(last - first) * languages).astype(np.float64).reshape(-1, languages)
            for kind, sizes in enumerate(self.tables.sizes):
                sums -= np.bincount(rows[kinds[back] == kind], minlength=last - first)[:, None] * sizes
            top = sums.argmax(axis=1)
            odds = np.exp(sums - sums.max(axis=1, keepdims=True))
            top[~self._lettered(texts, first, part, starts, stops, counts)] = -1
            best.append(top)
            sure.append(np.where(top >= 0, 1 / odds.sum(axis=1), 0.0))
        return (np.concatenate(best), np.concatenate(sure)) if best else (np.zeros(0, np.int64), np.zeros(0))

    @staticmethod
    def _lettered(texts: pa.Array, first: int, part: np.ndarray, starts: np.ndarray, stops: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Which rows have a letter: an ASCII one, or else any character that counts as a letter."""
        has = counts > 0
        ascii_letter = np.concatenate(([0], np.cumsum(part < 128)))
        plain = np.concatenate(([0], np.cumsum(ascii_letter[stops] > ascii_letter[starts])))
        edges = np.concatenate(([0], np.cumsum(counts)))
        for row in np.flatnonzero(has & (plain[edges[1:]] == plain[edges[:-1]])):
            has[row] = any(c.isalpha() for c in texts[first + int(row)].as_py())
        return has


def predict(docs: DataFrame, train: Column) -> DataFrame:
    """The language of every row of ``docs`` (doc_id, text, lang), learned from the rows where ``train`` holds.

    A null text and a text without letters is ``und`` with score 0, and so is every text when there is nothing to
    learn from. Scores are the language's probability among those learned; equal ones go to the smaller name. Repeated
    rows get equal results, an empty table an empty one. Returns doc_id, lang_pred, score.
    """
    tables = learn(docs, train)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if tables is None:
        return rows.select("doc_id", F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector, names = Detector(shared.value), np.array([*shared.value.languages, NONE], dtype=object)
        for batch in batches:
            best, sure = detector(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(sure, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
