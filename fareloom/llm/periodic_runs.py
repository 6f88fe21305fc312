"""Periodic runs of words by an online sparse diagonal DP, and texts with the repeats taken out.

A run with period q is a longest stretch of words in which words q apart agree, q being its smallest period. It counts
when it has at least ``max(LEAST_WORDS, LEAST_PERIODS * q)`` words.

Word by word, the earlier occurrences of a word increment the match lengths of their lags, and a diagonal (a lag) that
ends with sufficient length emits its run at once. Two facts keep the diagonals sparse without losing a run:

* A lag from 2^k to below 2^(k+1) must match at least 3 * 2^k words in a row, so it can only count where the last
  3 * 2^k words occurred before, as a whole. These stretches get names by joining the names of their halves, and only
  stretches that occur twice are looked at for the next k.
* Of several earlier occurrences of such a stretch only the nearest can be the smallest period of a run that goes
  through here; if the nearest is closer than 2^k, every lag of this class belongs to a run with a smaller period.

So each word increments at most one diagonal for each k, even in a text that is one word a million times, and the work
is n log n for n words. Words are told apart by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.llm.common import WORD

LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words of the stretch that stands for class 0; a lag of class k matches STRETCH * 2**k words in a row.
STRETCH = LEAST_PERIODS - 1
#: Bytes of text after which a task hands its rows on.
FLUSH = 4 << 20

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_RUNS = pa.list_(pa.struct([pa.field(c, pa.int64(), nullable=False) for c in ("start", "length", "period")]))


def _joined(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the places ``at``, those whose pair of names occurs twice; the names of the pairs; the place before with the same pair, or -1."""
    pairs = left.astype(np.int64) << 32 | right
    order = np.argsort(pairs, kind="stable")
    pairs, at = pairs[order], at[order]
    before, after, earlier = np.zeros(len(at), bool), np.zeros(len(at), bool), np.full(len(at), -1)
    before[1:] = after[:-1] = pairs[1:] == pairs[:-1]
    earlier[1:] = np.where(before[1:], at[:-1], -1)
    twice = before | after
    names = np.cumsum(~before)
    back = np.argsort(at[twice])
    return at[twice][back], names[twice][back], earlier[twice][back]


def earlier_occurrences(words: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """For each class of lags the places, in order, at which a diagonal can still count, and their lags."""
    n, width, lags, kind = len(words), STRETCH, 1, 0
    if n < LEAST_WORDS:
        return
    at, names, earlier = np.arange(n), words, None
    for size in range(1, STRETCH):  # stretches of 2 words, then of 3
        whole = at >= size
        at, names, earlier = _joined(words[at[whole] - size], names[whole], at[whole])
    while len(at):
        lag = at - earlier
        here = (earlier >= 0) & (lag >= lags) & (lag < 2 * lags)
        if here.any():
            yield kind, (at[here], lag[here])
        lags, kind = 2 * lags, kind + 1
        if LEAST_PERIODS * lags > n:
            return
        named = np.full(n, -1, np.int64)
        named[at] = names
        whole = (at >= width) & (named[at - width] >= 0)
        at, names, earlier = _joined(named[at[whole] - width], names[whole], at[whole])
        width *= 2


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run among ``words`` (whole numbers from 0), by start, then period."""
    classes = list(earlier_occurrences(words))
    if not classes:
        return []
    places, lags, kinds = (np.concatenate(x) for x in zip(*((at, lag, np.full(len(at), k)) for k, (at, lag) in classes)))
    order = np.argsort(places, kind="stable")
    runs: list[tuple[int, int, int]] = []

    def ended(lag: int, matched: int, last: int) -> None:
        if matched + lag >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            runs.append((last + 1 - matched - lag, matched + lag, lag))

    active: dict[int, tuple[int, int, int]] = {}  # of each class the lag, its matching words so far, the last of them
    for place, lag, kind in zip(places[order].tolist(), lags[order].tolist(), kinds[order].tolist()):
        was, matched, last = active.get(kind, (0, 0, -1))
        if was == lag and last == place - 1:
            active[kind] = (lag, matched + 1, place)
            continue
        if matched:
            ended(was, matched, last)
        active[kind] = (lag, STRETCH << kind, place)
    for state in active.values():
        ended(*state)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: of each run only its first period, and nothing that another run repeats."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def _rows(batches: Iterator[pa.RecordBatch], carried: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, first, size = batch.column(carried), 0, 0
        out: list[tuple[int, list[tuple[int, int, int]], str]] = []

        def flushed() -> pa.RecordBatch:
            counts, runs, bodies = zip(*out)
            spans = [[dict(zip(("start", "length", "period"), r)) for r in each] for each in runs]
            columns = [batch.column(i).slice(first, len(out)) for i in range(carried)]
            columns += [pa.array(counts, pa.int64()), pa.array(spans, _RUNS), pa.array(bodies, pa.string())]
            return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:carried], "n_words", "runs", "collapsed"])

        for row in range(len(texts)):
            words = (texts[row].as_py() or "").encode().split()  # bytes.split() parts at space and U+0009 to U+000D only
            names: dict[bytes, int] = {}
            named = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
            runs = runs_of(named)
            if runs:
                words = [w for w, stays in zip(words, kept_words(len(words), runs).tolist()) if stays]
            body = b" ".join(words).decode()
            out.append((len(named), runs, body))
            size += len(body) + 1
            if size >= FLUSH:
                yield flushed()
                out, size, first = [], 0, row + 1
        if out:
            yield flushed()


def periodic_runs(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns named in ``carry``, n_words, runs and the collapsed text of each row of ``docs``; a job without a shuffle.

    ``runs`` are (start, length, period) in words from 0, by start, then period; ``collapsed`` are the words that no run
    contains after its first period, joined by single spaces. Null and empty texts have no word, no run and an empty collapsed text. Rows are independent: repeated ids and texts give a row each,
    a null id stays null, an empty table gives an empty result, and columns that are not carried are left out, whatever
    their names. A task holds one text's words at a time, about 200 bytes a word.
    """
    own = [f"carry_{i}" for i in range(len(carry))]
    rows = docs.select(*(F.col(c).alias(o) for c, o in zip(carry, own)), F.col("text").cast("string").alias("body"))
    fields = [T.StructField(o, rows.schema[o].dataType) for o in own]
    fields += [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    found = rows.mapInArrow(lambda batches: _rows(batches, len(own)), T.StructType(fields))
    return found.select(*(F.col(o).alias(c) for c, o in zip(carry, own)), "n_words", "runs", "collapsed")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, with a periodic tail in every tenth document by the checksum of its id; texts without id stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    bent = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    bent = bent.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    tail = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", at(i).cast("int")))
    return bent.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Of each row the number of runs, the longest (ties: smallest start, then period) and checksums of runs and collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("from"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.from")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.less")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
