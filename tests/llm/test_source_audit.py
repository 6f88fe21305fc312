"""The audit of sources against a plain version with fractions, term by term, and on awkward rows."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fareloom.llm import source_audit

CLASH = ("term", "n", "docs", "share", "bits", "word", "span", "source_no", "value", "rank", "part", "item", "id", "total", "v")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = {t for t, d in docs[lang].items() if d >= least}
        total = lambda group: sum(group[t] for t in kept)
        share = lambda group, t, whole: 1 + floor(Fraction(10**9 * (group[t] + 5), whole + 5 * len(kept)))
        every = sum((counts[lang, s] for s in sources), Counter())
        p = {s: {t: share(counts[lang, s], t, total(counts[lang, s])) for t in kept} for s in sources}
        q = {t: share(every, t, total(every)) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def sample(n=600, langs=("en", "de", None), sources=9):
    draw = random.Random(5)
    words = ["".join(draw.choice("abcÄé東Z") for _ in range(draw.randint(1, 4))) for _ in range(300)]
    rows = []
    for i in range(n):
        size = draw.choice([0, 3, 20, 60])
        text = draw.choice([" ", "\n1", "_.,"]).join(draw.choice(words[: draw.choice([5, 50, 300])]) for _ in range(size))
        rows.append((draw.choice(langs), draw.choice(["hot", f"s{draw.randrange(sources)}"]), text))
    rows += [("en", None, None), ("en", "Ä only", "12 34 -"), ("xx", "a", "one"), ("xx", "b", None), ("yy", "alone", "word"), (None, None, "")]
    return rows + rows[:50] + [("en", "long", "Wort " * 50_000 + "y" * 100_000)]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    return docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH)))


def test_equals_the_plain_version(spark):
    rows = sample()
    assert sorted(map(tuple, source_audit.audit(frame(spark, rows), 10, 7).collect())) == plain(rows, 10, 7)


def test_spans_and_buckets_of_sources_do_not_change_the_result(spark):
    rows = sample(300, ("en",), 30)
    assert sorted(map(tuple, source_audit.audit(frame(spark, rows), 3, 5, span=64, bucket=4).collect())) == plain(rows, 3, 5)


def test_no_rows_and_no_kept_terms(spark):
    assert source_audit.audit(frame(spark, [])).count() == 0
    rows = [("en", "a", "x y"), ("en", "b", "y z")]
    assert sorted(map(tuple, source_audit.audit(frame(spark, rows)).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_share_is_exact_for_large_counts(spark):
    n, total, v = 3 * 10**17 + 1, 7 * 10**17 + 3, 10**6 + 1
    got = spark.range(1).select(source_audit.share(F.lit(n), F.lit(total), F.lit(v)), source_audit.share(F.lit(0), F.lit(0), F.lit(0))).first()
    assert tuple(got) == (1 + (10**9 * (n + 5)) // (total + 5 * v), 1)


def test_joint_cells_equal_sums_over_terms():
    draw = np.random.default_rng(2)
    counts = draw.integers(0, 4, (5, 64)) * draw.integers(0, 2, (5, 64))
    shares = {(s, n): int(draw.integers(1, 1000)) for s in range(5) for n in range(4)}
    rows = []
    for s in range(5):
        for n in range(4):
            bits = sum(1 << int(t) for t in range(64) if n == 0 or counts[s, t] == n)
            rows.append({"lang": "x", "span": 0, "left": 0, "right": 0, "word": 0, "source_no": s, "n": n, "share": shares[s, n], "bits": bits - (bits >> 63 << 64)})
    got = {(r["source_no"], r["item_no"]): r["value"] for r in source_audit.joint_cells(pa.Table.from_pylist(rows)).to_pylist()}
    for s in range(5):
        for t in range(5):
            if s != t:
                assert got[s, t] == sum(abs(shares[s, int(a)] - shares[t, int(b)]) for a, b in zip(counts[s], counts[t]))
