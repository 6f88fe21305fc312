"""Periodic runs against a plain version that compares every word with every lag, and on awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import periodic_runs

CLASH = ("runs", "collapsed", "n_words", "carry_0", "body", "g", "words", "n", "a", "p", "best", "start", "length", "period")


def plain_runs(words):
    spans, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                spans.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in spans.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    body = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    return (doc_id, len(runs), s, length, q, 1000 * length // q if runs else None, sha(lines), sha(body))


def order(row):
    return (row[0] is None, str(row))


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    some = []
    for i in range(400):
        words = []
        while len(words) < draw.randint(0, 80):
            block = [draw.choice("ab é 東 Ab".split()) for _ in range(draw.randint(1, 9))]
            words += block * draw.randint(1, 7)
        some.append((i, draw.choice([" ", "\t\n", "\r \x0b\x0c"]).join(words)))
    some += [(400, None), (401, ""), (402, " \n\t "), (None, "x " * 9), (None, "x " * 9), (403, "x x " * 6), (403, "a b " * 4 + "a"), (404, ("w " * 40 + "v ") * 30)]
    return some + [(405, " ".join(f"w{i % 977}" for i in range(6000))), (406, "y" * 300_000), (407, "aaaaaa"), (408, "a a a a a"), (409, "a a a a a a")]


def test_digests_equal_the_plain_version(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    docs = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))
    got = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_planted_repeats(docs)))
    assert sorted(map(tuple, got.collect()), key=order) == sorted((plain_row(*t) for t in texts), key=order)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts) > 20


def test_operator_keeps_carried_columns_and_gives_spans_and_texts(spark):
    docs = spark.createDataFrame([(1, "s", "a b a b a b a b c"), (2, None, None)], "id int, runs string, text string")
    rows = sorted(periodic_runs.periodic_runs(docs, ["id", "runs"]).collect())
    assert [tuple(r)[:3] for r in rows] == [(1, "s", 9), (2, None, 0)]
    assert [tuple(x) for x in rows[0][3]] == [(0, 8, 2)] and rows[0][4] == "a b c" and rows[1][3:] == ([], "")


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_planted_repeats(docs))).count() == 0


def test_each_word_counts_in_few_diagonals():
    words = np.array(([0] * 99 + [1]) * 40)
    places = [len(at) for _, (at, _) in periodic_runs.earlier_occurrences(words)]
    assert sum(places) < 2 * len(words)  # all pairs of equal words are two million
    assert periodic_runs.runs_of(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert periodic_runs.runs_of(words)[0] == (0, 99, 1) and (0, 4000, 100) in periodic_runs.runs_of(words)


def test_the_plan_has_no_shuffle(spark, small):
    plan = periodic_runs.periodic_runs(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
