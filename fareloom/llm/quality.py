"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: words and word pairs in lower case, and one to three shapes in a row. A shape keeps
a word's pattern of capitals, small letters, digits and signs, and says whether the word repeats the one before it. An
indicator is scaled by its log-count ratio between the classes, a text's vector is brought to length 1, and a linear
model with hinge loss is fitted by dual coordinate descent. A sigmoid fitted on labelled rows that the model has not
seen turns margins into probabilities.

The model is fitted in one task on at most ``ROWS_EACH`` labelled rows of each class. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import SpanHasher, bounded_sample, counted, lowered, mixed, pieces_of, text_buffer, word_spans

ROWS_EACH = 3000
BUCKET_BITS = 18
PASSES = 12
COST = 1.0
THRESHOLD = 0.7
_CUT = np.uint64(64 - BUCKET_BITS)
_JOIN = np.uint64(0xC2B2AE3D27D4EB4F)
_SAME = np.uint64(0x165667B19E3779F9)

#: Letters fall into two kinds and digits into one; every other sign stands for itself.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 65, 97, 97, 48


def _after(keys: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n keys in a row within one text, and where each run ends."""
    runs, ok = keys, np.ones(len(keys), bool)
    for back in range(1, n):
        runs = mixed(runs * _JOIN + np.concatenate((np.zeros(back, np.uint64), keys[: len(keys) - back])))
        first = firsts[(firsts + back - 1) < len(keys)] + back - 1
        ok[first] = False
    return runs, np.flatnonzero(ok)


def features(part: np.ndarray, within: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each row, one row after another, and how many each row has."""
    starts, stops, counts = word_spans(part, within)
    rows = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    words = hasher(lowered(part), starts, stops)
    firsts = (np.cumsum(counts) - counts)[counts > 0]

    kind = _KIND[part]
    kept = np.ones(len(part), bool)
    kept[1:] = kind[1:] != kind[:-1]
    kept[starts] = True
    places = np.concatenate(([0], np.cumsum(kept)))
    shapes = hasher(kind[kept], places[starts], places[stops])
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[firsts] = False
    shapes = np.where(same, mixed(shapes ^ _SAME), shapes)

    found = []
    for salt, (keys, n) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3))):
        runs, at = _after(keys, firsts, n) if len(keys) else (keys, np.zeros(0, np.int64))
        bucket = mixed(runs[at] + np.uint64(salt)) >> _CUT
        found.append((rows[at] << np.uint64(BUCKET_BITS)) | bucket)
    keys = counted(np.concatenate(found))[0]
    sizes = np.bincount((keys >> np.uint64(BUCKET_BITS)).astype(np.int64), minlength=len(counts))
    return (keys & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int32), sizes


@dataclass
class QualityModel:
    """Weights of scaled indicators, their squared scales, and the sigmoid's numbers; ``constant`` where nothing was fitted."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: float | None = None

    def scores(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(sizes), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(numbers, sizes) + self.shift, -35, 35)))

    def margins(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        rows = np.repeat(np.arange(len(sizes)), sizes)
        dots = np.bincount(rows, weights=self.weights[numbers], minlength=len(sizes))
        norms = np.sqrt(np.bincount(rows, weights=self.squares[numbers], minlength=len(sizes)))
        return dots / np.maximum(norms, 1e-9) + self.bias


def _descend(rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss over unit vectors with a constant feature; classes weigh the same."""
    weights, bias = np.zeros(len(ratios)), 0.0
    alphas = np.zeros(len(rows))
    cost = COST * len(rows) / (2 * np.where(signs > 0, (signs > 0).sum(), (signs < 0).sum()))
    values = [ratios[r] / max(np.linalg.norm(ratios[r]), 1e-9) for r in rows]
    lengths = np.array([v @ v for v in values]) + 1.0
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            slope = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alphas[i] - slope / lengths[i], 0.0), cost[i])
            if new != alphas[i]:
                step = (new - alphas[i]) * signs[i]
                weights[rows[i]] += step * values[i]
                bias += step
                alphas[i] = new
    return weights, bias


def _sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    targets = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -35, 35)))
        d, v = p - targets, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * margins).sum() + 1e-3 * (slope - 1), d.sum()])
        h = np.array([[(v * margins * margins).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = max(slope - step[0], 1e-3), shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(shift)


def fit(rows: list[np.ndarray], good: np.ndarray, aside: np.ndarray) -> QualityModel:
    """Fit on rows of feature numbers; those set ``aside`` only serve the sigmoid.

    With labels of one class only, every text gets that class; without labels every text counts as good.
    """
    size = 1 << BUCKET_BITS
    empty = np.zeros(size, np.float32)
    own = ~aside if good[~aside].any() and (~good[~aside]).any() else np.ones(len(good), bool)
    if good.all() or not good.any():
        return QualityModel(empty, empty, 0.0, 1.0, 0.0, 0.0 if len(good) and not good.any() else 1.0)
    counts = [np.ones(size), np.ones(size)]
    for row, is_good in zip([rows[i] for i in np.flatnonzero(own)], good[own]):
        counts[int(is_good)][row] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weights, bias = _descend([rows[i] for i in np.flatnonzero(own)], np.where(good[own], 1.0, -1.0), ratios)
    model = QualityModel((weights * ratios).astype(np.float32), (ratios * ratios).astype(np.float32), bias, 1.0, 0.0)
    check = np.flatnonzero(aside) if good[aside].any() and (~good[aside]).any() else np.arange(len(good))
    margins = model.margins(np.concatenate([rows[i] for i in check]), np.array([len(rows[i]) for i in check]))
    model.slope, model.shift = _sigmoid(margins, good[check])
    return model


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fit on all rows of the one task that gets the sample."""
    found = [(b.column(0)[i].as_py(), b.column(1)[i].as_py(), np.frombuffer(b.column(2)[i].as_py(), "<i4")) for b in batches for i in range(b.num_rows)]
    found.sort(key=lambda r: (r[0], r[1], len(r[2])))
    model = fit([r[2] for r in found], np.array([r[1] == 1 for r in found], bool), np.array([r[0] % 4 == 3 for r in found], bool))
    figures = [model.bias, model.slope, model.shift, -1.0 if model.constant is None else model.constant]
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.weights.tobytes()]), pa.array([model.squares.tobytes()]), pa.array([figures], pa.list_(pa.float64()))], names=["weights", "squares", "figures"]
    )


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHasher()
    for batch in batches:
        data, offsets = text_buffer(batch.column(2))
        out = []
        for first, last in pieces_of(offsets):
            numbers, sizes = features(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], hasher)
            edges = np.concatenate(([0], np.cumsum(sizes)))
            out += [numbers[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["draw", "label", "numbers"])


def known_labels(labels: DataFrame, label: str, train: Column) -> DataFrame:
    """(doc_id, label): the labels 0 and 1 of documents where ``train`` holds, each once."""
    return labels.select("doc_id", F.col(label).cast("int").alias("label")).where(train & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows_each: int) -> DataFrame:
    """(draw, label, text, doc_id) of a bounded sample of the labelled rows where ``train`` holds.

    Only the labels are counted and drawn from; a document's text is read where its label was drawn. At most about
    ``2 * rows_each`` labels are broadcast. Labels other than 0 and 1 and those without an id are left out, repeated ones
    count once, and a document with both labels may be drawn for each. A document with several rows gives each of them;
    a null text stays null.
    """
    drawn = bounded_sample(known_labels(labels, label, train), "label", rows_each, F.col("doc_id"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(drawn), "doc_id").select(F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(1 << 30)).alias("draw"), "label", "text", "doc_id")


def learn(docs: DataFrame, labels: DataFrame, train: Column, rows_each: int = ROWS_EACH) -> QualityModel:
    """The classifier from the labelled rows where ``train`` holds.

    One row of each drawn document and label is learned from, of several with the same id the text with the smallest
    hash, so the fit task holds no more rows than the sample bounds. A document with both labels teaches both. A null text
    is an empty one. Without labels, without documents or with labels of one class see ``fit``.
    """
    sample = labelled_sample(docs, labels, "quality", train, rows_each)
    sample = sample.groupBy("doc_id", "draw", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = sample.select("draw", "label", "text").mapInArrow(_feature_rows, "draw long, label int, numbers binary")
    row = rows.repartition(1).mapInArrow(_fit_task, "weights binary, squares binary, figures array<double>").first()
    if row is None:
        return fit([], np.zeros(0, bool), np.zeros(0, bool))
    bias, slope, shift, constant = row["figures"]
    weights, squares = (np.frombuffer(row[k], np.float32) for k in ("weights", "squares"))
    return QualityModel(weights, squares, bias, slope, shift, None if constant < 0 else constant)


def _text_scores(model: QualityModel, texts: pa.Array, hasher: SpanHasher) -> np.ndarray:
    data, offsets = text_buffer(texts)
    scores = [np.zeros(0)]
    for first, last in pieces_of(offsets):
        scores.append(model.scores(*features(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], hasher)))
    return np.concatenate(scores)


def accepted(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.7, with all their columns; nothing is shuffled."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            yield batch.filter(pa.array(_text_scores(shared.value, batch.column(at), hasher) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``.

    A score is the probability of label 1, from the whole text alone; null is an empty text. ``predicted`` is 1 from
    0.7. Repeated rows get equal results, an empty table an empty one, and other columns are left out.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            scores = _text_scores(shared.value, batch.column(1), hasher)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    found = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
