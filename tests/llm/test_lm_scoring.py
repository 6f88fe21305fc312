"""The language model's scores against a plain version: dictionaries of counts, one probability at a time."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareloom.llm import lm_scoring
from fareloom.llm.common import remainder

END, BEGIN = "\nend", "\nbegin"


def levels():
    """Smallest count of each level, from 1 on."""
    return sorted({math.ceil(1.5**k - 1e-9) for k in range(107)})


FROM = levels()


def level(count):
    return sum(1 for f in FROM[:60] if f <= count)


def middle(of_level):
    return 0.0 if of_level == 0 else (FROM[of_level - 1] + FROM[of_level] - 1) / 2


def plain_scores(rows, held_out):
    """All words are in the head, as in the operator when the head has room for them."""
    texts = [["\n" + w for w in (t or "").lower().split()] + [END] for _, t in rows]
    train = [t for t, (i, _) in zip(texts, rows) if not held_out(i)]
    words = Counter(w for t in train for w in t)
    kind = lambda w: 62 if w == BEGIN else min(level(words[w]), 61) if w in words else 0
    pairs = Counter((a, b) for t in train for a, b in zip([BEGIN, *t], t))
    seen, kinds, once, twice = ([0.0] * 64 for _ in range(4))
    for (a, _), n in pairs.items():
        seen[kind(a)] += n
        kinds[kind(a)] += 1
        once[kind(a)] += n == 1
        twice[kind(a)] += n == 2
    discount = [min(max((o + 0.5) / (o + 2 * t + 1.0), 0.05), 0.95) for o, t in zip(once, twice)]
    backoff = [d * k / s if s else 1.0 for d, k, s in zip(discount, kinds, seen)]
    n, v = sum(words.values()), len(words)
    scores = []
    for text in texts:
        score = 0.0
        for a, b in zip([BEGIN, *text], text):
            own = middle(level(words[b]))
            before = float(len(train)) if a == BEGIN else middle(level(words[a]))
            pair = min(middle(level(pairs[a, b])), own, before)
            single = (own + 1) / (n + v + 1)
            p = single if not before else max(pair - discount[kind(a)], 0.0) / max(before, 1.0) + backoff[kind(a)] * single
            score += math.log10(min(p, 1.0))
        scores.append(score)
    return scores


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdé", k=draw.randint(1, 4))) for _ in range(200)]
    some = [(i, " ".join(draw.choice(words[: draw.choice([3, 20, 200])]) for _ in range(draw.randint(0, 60)))) for i in range(300)]
    return some + [(300, None), (301, ""), (302, "unseen words ABC"), (303, "a " * 20_000), (303, "a " * 20_000), (304, "z" * 50_000)]


def order(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("filter_bytes, piece_bytes", [(1 << 20, 1 << 20), (600, 2_000)])
def test_scores_equal_the_plain_version(spark, rows, filter_bytes, piece_bytes):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    got = lm_scoring.score_documents(docs, remainder(F.col("doc_id"), 7) == 2, filter_bytes, piece_bytes=piece_bytes, per_entry=80).collect()
    want = order((i, s) for (i, _), s in zip(rows, plain_scores(rows, held)))
    assert [i for i, _ in order((r.doc_id, r.score) for r in got)] == [i for i, _ in want]
    assert [s for _, s in order((r.doc_id, r.score) for r in got)] == pytest.approx([s for _, s in want], rel=1e-9)


def test_every_ngram_of_a_piece_falls_to_one_round(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_scoring.train(docs)
    rounds = lm_scoring.filter_rounds(model, 1)
    blocks = [b for r in rounds for b in r]
    assert len(rounds) == len(blocks) == len(set(blocks)) >= 2
    assert lm_scoring.filter_rounds(model, 1 << 30) == [{b: n for r in rounds for b, n in r.items()}]


def test_the_head_is_searched_once_for_each_word_of_a_piece(rows, monkeypatch):
    """Histories have the classes of their own look-up, and no pair is lost."""
    texts = pa.array([t for _, t in rows], pa.string())
    (piece,) = lm_scoring._pieces(0, 1 << 30)(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))
    counts, words, at = (piece.column(c)[0].as_py() for c in ("counts", "words", "at"))
    keys = np.frombuffer(words, "<u8")
    head, levels = keys[::3].copy(), np.arange(len(keys[::3])) % 70 + 1
    searched, classes = [], lm_scoring._classes
    monkeypatch.setattr(lm_scoring, "_classes", lambda some, *head: searched.append(len(some)) or classes(some, *head))
    got = lm_scoring._Piece(counts, words, at, head, levels)
    assert searched == [len(keys)] and len(keys) < len(got.tokens) / 10
    before = lm_scoring._histories(got.tokens, got.counts)
    assert (got.classes == classes(before, head, levels)).all() and got.classes.dtype == np.uint64
    assert (got.pairs == lm_scoring._pair_keys(before, got.tokens, got.classes)).all()
    split = lm_scoring._split(type("Shared", (), {"value": (head, levels)}), {k: np.zeros(1, np.int64) for k in ("words", "pairs")}, 0)
    batch = pa.RecordBatch.from_arrays([pa.array([7]), *(pa.array([v], pa.binary()) for v in (counts, words, at))], ["piece", "counts", "words", "at"])
    (found,) = split(iter([batch]))
    of = {k.as_py(): np.frombuffer(v.as_py(), "<u8").tolist() for k, v in zip(found.column("kind"), found.column("keys"))}
    assert of == {"words": keys.tolist(), "pairs": sorted(set(got.pairs.tolist()))}
