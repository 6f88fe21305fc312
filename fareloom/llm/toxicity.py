"""Toxicity: a convolutional text classifier in numpy.

A word is the mean of three rows of one hashed embedding table: its own, that of its first three letters and that of its
first five. Filters of widths 1 to 3 run over the words, the largest value of each filter over the whole text is kept,
and a logistic layer reads these. Since pooling keeps one place for each filter, a training step touches only those.

Thresholds are calibrated by language. The language is the one that ``language_id`` finds in the text; the
label column is never read when scoring. Each language's threshold maps to a score of 0.7. They come from all labelled
documents set aside, a quarter by their id: these are scored by the trained model and counted by language, step of the
score and label, so only counts reach the driver.

The model is trained in one task on at most about ``ROWS_EACH`` labelled documents of each class, one row of each; every text
is scored whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm import language_id
from fareloom.llm.common import NOT_LETTER, SpanHasher, pieces_of, text_buffer, word_spans
from fareloom.llm.quality import known_labels, labelled_sample

ROWS_EACH = 2500
TABLE_BITS = 18
WIDTH = 12  # numbers of an embedding
FILTERS = 12  # of each width
SPANS = (1, 2, 3)
PASSES, MOST_PASSES, STEPS = 8, 25, 400  # more passes over few rows
BATCH = 50
RATE = 0.02
START = 0.05  # spread of embeddings before training, so that words never seen hardly move a filter
THRESHOLD = 0.7
LEAST_TEXTS = 4
LEAST_TOXIC = 20  # rows of each class set aside from which thresholds are calibrated, for all texts or a language
SCORE_STEPS = 1024  # steps of a raw score in which rows are counted for thresholds


def word_rows(part: np.ndarray, within: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Three table rows of every word, and the words of each text."""
    starts, stops, counts = word_spans(part, within, NOT_LETTER)
    keys = [hasher(part, starts, np.minimum(stops, starts + n) if n else stops) for n in (0, 3, 5)]
    salted = [(k + np.uint64(i)) * np.uint64(0x9FB21C651E98DF25) for i, k in enumerate(keys)]
    return np.stack([(k >> np.uint64(64 - TABLE_BITS)).astype(np.int32) for k in salted], axis=1), counts


def _tops(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Largest value of each column in each run, at least 0."""
    top = np.zeros((len(counts), values.shape[1]), values.dtype)
    full = counts > 0
    if full.any():
        top[full] = np.maximum.reduceat(values, (np.cumsum(counts) - counts)[full], axis=0)
    return np.maximum(top, 0)


@dataclass
class ToxicityModel:
    """Parameters. ``filters`` has one matrix for each width, its rows one word after another."""

    table: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    last: np.ndarray
    bias: float
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def _convolved(self, words: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
        """Values of each width's filters at each word; places where a text ends within the filter get the lowest."""
        ends = np.repeat(np.cumsum(counts), counts)
        place = np.arange(len(words))
        for span, filters, bias in zip(SPANS, self.filters, self.biases):
            values = words @ filters[:WIDTH]
            for k in range(1, span):
                values[: len(words) - k] += words[k:] @ filters[k * WIDTH : (k + 1) * WIDTH]
            values += bias
            if span > 1:
                values[place + span > ends] = -1e9
            yield values

    def pooled(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        words = self.table[rows].mean(axis=1)
        return np.concatenate([_tops(v, counts) for v in self._convolved(words, counts)], axis=1)

    def raw(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.pooled(rows, counts) @ self.last + self.bias, -30, 30)))

    def scores(self, raw: np.ndarray, languages: list[str]) -> np.ndarray:
        """Raw probabilities moved so that the language's threshold is at 0.7."""
        t = np.array([self.thresholds.get(x, self.threshold) for x in languages])
        low, high = THRESHOLD * raw / t, THRESHOLD + (1 - THRESHOLD) * (raw - t) / (1 - t)
        return raw if self.constant is not None else np.where(raw < t, np.minimum(low, THRESHOLD - 1e-9), high)


class _Adam:
    def __init__(self, like: np.ndarray) -> None:
        self.first, self.second, self.steps = np.zeros_like(like), np.zeros_like(like), 0

    def __call__(self, values: np.ndarray, slopes: np.ndarray) -> None:
        self.steps += 1
        self.first += 0.1 * (slopes - self.first)
        self.second += 0.001 * (slopes * slopes - self.second)
        values -= RATE * (self.first / (1 - 0.9**self.steps)) / (np.sqrt(self.second / (1 - 0.999**self.steps)) + 1e-8)


def train(texts: list[np.ndarray], toxic: np.ndarray) -> ToxicityModel:
    """Fit on texts given as table rows of their words. Labels of one class only give that class to every text."""
    draw = np.random.default_rng(11)
    model = ToxicityModel(
        draw.normal(0, START, (1 << TABLE_BITS, WIDTH)).astype(np.float32),
        [draw.normal(0, 0.4, (WIDTH * s, FILTERS)).astype(np.float32) for s in SPANS],
        [np.zeros(FILTERS, np.float32) for _ in SPANS],
        draw.normal(0, 0.3, FILTERS * len(SPANS)).astype(np.float32),
        0.0,
    )
    if toxic.all() or not toxic.any():
        model.constant = 1.0 if len(toxic) and toxic.any() else 0.0
        return model
    steps = [_Adam(x) for x in (*model.filters, *model.biases, model.last)]
    # A table row that few texts use would only be learned by heart; it stays 0.
    texts_with = np.zeros(1 << TABLE_BITS, np.int64)
    for rows in texts:
        texts_with[np.unique(rows)] += 1
    model.table[texts_with < LEAST_TEXTS] = 0
    seen = np.where(texts_with < LEAST_TEXTS, np.inf, 0).astype(np.float32)
    weights = np.where(toxic, len(toxic) / (2 * toxic.sum()), len(toxic) / (2 * (~toxic).sum()))
    bias = _Adam(np.zeros(1))
    for _ in range(min(MOST_PASSES, max(PASSES, -(-STEPS * BATCH // len(texts))))):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            counts = np.array([len(texts[i]) for i in chosen])
            rows = np.concatenate([texts[i] for i in chosen])
            _step(model, rows, counts, toxic[chosen], weights[chosen], steps, bias, seen)
    return model


def _step(model, rows, counts, toxic, weights, steps, bias_step, seen) -> None:
    words = model.table[rows].mean(axis=1)
    full = np.flatnonzero(counts > 0)
    starts = (np.cumsum(counts) - counts)[full]
    places, tops = [], []
    for values in model._convolved(words, counts):
        top = np.zeros((len(counts), FILTERS), np.float32)
        top[full] = np.maximum.reduceat(values, starts, axis=0) if len(full) else 0
        # The first place of each top: at a place equal to its text's top, the row number, else beyond all rows.
        at = np.where(values == np.repeat(top, counts, axis=0), np.arange(len(values))[:, None], len(values))
        place = np.zeros((len(counts), FILTERS), np.int64)
        place[full] = np.minimum.reduceat(at, starts, axis=0) if len(full) else 0
        places.append(np.where(top > 0, place, -1))
        tops.append(np.maximum(top, 0))
    pooled = np.concatenate(tops, axis=1)
    p = 1 / (1 + np.exp(-np.clip(pooled @ model.last + model.bias, -30, 30)))
    error = ((p - toxic) * weights / len(counts)).astype(np.float32)
    back = error[:, None] * model.last[None, :]
    slopes_filters, slopes_biases = [], []
    table_rows, table_slopes = [], []
    for k, span in enumerate(SPANS):
        own, place = back[:, k * FILTERS : (k + 1) * FILTERS], places[k]
        doc, filt = np.nonzero(place >= 0)
        g, where = own[doc, filt], place[doc, filt]
        slope = np.zeros_like(model.filters[k])
        for s in range(span):
            block = slice(s * WIDTH, (s + 1) * WIDTH)
            part = np.zeros((FILTERS, WIDTH), np.float32)
            np.add.at(part, filt, g[:, None] * words[where + s])
            slope[block] = part.T
            table_rows.append(rows[where + s].reshape(-1))
            table_slopes.append(np.repeat(g[:, None] * model.filters[k][block].T[filt] / 3, 3, axis=0))
        slopes_filters.append(slope)
        slopes_biases.append(np.bincount(filt, weights=g, minlength=FILTERS).astype(np.float32))
    for step, values, slope in zip(steps, (*model.filters, *model.biases, model.last), (*slopes_filters, *slopes_biases, pooled.T @ error)):
        step(values, slope)
    shift = np.array([model.bias])
    bias_step(shift, np.array([error.sum()]))
    model.bias = float(shift[0])
    # Table rows: steps scaled by each row's past slopes, only for rows in use.
    touched, back_to = np.unique(np.concatenate(table_rows), return_inverse=True)
    slope = np.zeros((len(touched), WIDTH), np.float32)
    np.add.at(slope, back_to, np.concatenate(table_slopes))
    seen[touched] += (slope * slope).mean(axis=1)
    model.table[touched] -= 5 * RATE * slope / (np.sqrt(seen[touched])[:, None] + 1e-8)


def _best_cut(toxic: np.ndarray, clean: np.ndarray) -> float:
    """The cut with the best F1, given the rows of each class in each step of the raw score; of equal ones the nearest to 0.5."""
    if not toxic.any() or not clean.any():
        return 0.5
    right, wrong = np.cumsum(toxic[::-1])[::-1], np.cumsum(clean[::-1])[::-1]
    f1 = 2 * right / (right + wrong + toxic.sum())
    cuts = np.arange(-(-SCORE_STEPS // 20), SCORE_STEPS - SCORE_STEPS // 20)
    good = cuts[f1[cuts] >= f1[cuts].max() - 1e-12]
    return float(good[np.argmin(np.abs(good - SCORE_STEPS / 2))] / SCORE_STEPS)


def calibrate(counts: list[tuple[str, int, int, int]], model: ToxicityModel) -> None:
    """Thresholds with the best F1 on rows set aside, for all texts and for each language with enough of both classes.

    ``counts`` holds (language, step, toxic rows, other rows) over all rows set aside. A threshold is a whole number of
    steps between 0.05 and 0.95, so comparing steps and comparing scores is the same.
    """
    tables: dict[str, np.ndarray] = {}
    for name, step, toxic, clean in counts:
        tables.setdefault(name, np.zeros((2, SCORE_STEPS + 1), np.int64))[:, step] += (toxic, clean)
    model.threshold = _best_cut(*sum(tables.values(), np.zeros((2, SCORE_STEPS + 1), np.int64)))
    for name, own in sorted(tables.items()):
        if own.sum(axis=1).min() >= LEAST_TOXIC:
            model.thresholds[name] = _best_cut(*own)


def _languages(detector: language_id.Detector | None, texts: pa.Array) -> list[str]:
    if detector is None:
        return [language_id.NONE] * len(texts)
    names = [*detector.tables.languages, language_id.NONE]
    return [names[i] for i in detector(texts)[0]]


def _text_rows(texts: pa.Array, hasher: SpanHasher) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = text_buffer(pc.utf8_lower(texts.cast(pa.large_string())))
    for first, last in pieces_of(offsets, 1 << 20):
        yield word_rows(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], hasher)


def _judged(model: ToxicityModel, detector: language_id.Detector | None, hasher: SpanHasher, texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Raw score and language of every text."""
    raw = np.concatenate([np.zeros(0), *(model.raw(*rows) for rows in _text_rows(texts, hasher))])
    return raw.astype(np.float64), _languages(detector, texts)


def _draw() -> Column:
    """A number of 30 bits for each document; those with 3 modulo 4 are set aside from training."""
    return F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(1 << 30))


def aside_counts(docs: DataFrame, labels: DataFrame, train_rows: Column, model: ToxicityModel, tables: language_id.LanguageTables | None) -> DataFrame:
    """(language, step, toxic, clean): how many labelled documents set aside have a raw score in each step.

    All of them are counted, one row of each document and label as in training. Scores are joined with the labels, texts
    are not moved.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tables = shared.value
        detector, hasher = language_id.Detector(tables) if tables else None, SpanHasher()
        for batch in batches:
            raw, names = _judged(model, detector, hasher, batch.column(2))
            steps = pa.array(np.floor(raw * SCORE_STEPS).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), steps], names=["doc_id", "hash", "language", "step"])

    text = F.col("text").cast("string")
    aside = docs.where(train_rows & F.col("doc_id").isNotNull() & (_draw() % 4 == 3)).select("doc_id", F.xxhash64(text).alias("hash"), text.alias("text"))
    judged = aside.mapInArrow(run, f"doc_id {aside.schema['doc_id'].dataType.simpleString()}, hash long, language string, step int")
    one_each = judged.join(known_labels(labels, "toxic", train_rows), "doc_id").groupBy("doc_id", "label").agg(F.min_by(F.struct("language", "step"), "hash").alias("j"))
    toxic = F.col("label") == 1
    return one_each.groupBy("j.language", "j.step").agg(F.count_if(toxic).alias("toxic"), F.count_if(~toxic).alias("clean"))


def _one_each(sample: DataFrame) -> DataFrame:
    """One row of each drawn document: of several with the same id, the text with the smallest hash."""
    return sample.groupBy("doc_id", "draw", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("draw", "label", "text")


def learn(docs: DataFrame, labels: DataFrame, train_rows: Column, rows_each: int = ROWS_EACH) -> tuple[ToxicityModel, language_id.LanguageTables | None]:
    """The classifier and the language tables, both from the rows where ``train_rows`` holds."""
    tables = language_id.learn(docs, train_rows)

    def word_rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            out = []
            for rows, counts in _text_rows(batch.column(2), hasher):
                edges = np.concatenate(([0], np.cumsum(counts)))
                out += [rows[a:b].astype("<i4").tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["draw", "label", "rows"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            draws, toxic = (batch.column(k).to_pylist() for k in range(2))
            found += [(*r, np.frombuffer(rows.as_buffer(), "<i4").reshape(-1, 3)) for *r, rows in zip(draws, toxic, batch.column(2))]
        found.sort(key=lambda r: (r[0], r[1], len(r[2])))
        toxic = np.array([r[1] == 1 for r in found], bool)
        aside = np.array([r[0] % 4 == 3 for r in found], bool)
        enough = min(toxic[aside].sum(), (~toxic[aside]).sum()) >= LEAST_TOXIC
        own = np.flatnonzero(~aside) if enough else np.arange(len(found))
        model = train([found[i][2] for i in own], toxic[own])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)]), pa.array([bool(enough)])], names=["model", "enough"])

    sample = labelled_sample(docs, labels, "toxic", train_rows, rows_each)
    rows = _one_each(sample).mapInArrow(word_rows_of, "draw long, label int, rows binary")
    row = rows.repartition(1).mapInArrow(task, "model binary, enough boolean").first()
    model = pickle.loads(row["model"]) if row else train([], np.zeros(0, bool))
    if row and row["enough"] and model.constant is None:
        calibrate([tuple(r) for r in aside_counts(docs, labels, train_rows, model, tables).collect()], model)
    return model, tables


def scored(docs: DataFrame, model: ToxicityModel, tables: language_id.LanguageTables | None) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``.

    A score comes from the whole text alone; null is an empty text and has no word, so only the model's bias counts.
    With no toxic label to learn from, every score is 0; ``predicted`` is 1 from 0.7. Repeated rows get equal results,
    an empty table an empty one, and other columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tables = shared.value
        detector, hasher = language_id.Detector(tables) if tables else None, SpanHasher()
        for batch in batches:
            score = model.scores(*_judged(model, detector, hasher, batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
