"""Operators against plain versions, and on awkward rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from fareloom.llm import exact_dedup, language_id, lm_scoring, mixing, packing, quality, registered, search, simhash_dedup, token_counts, toxicity
from fareloom.llm.common import SpanHasher, bounded_sample, remainder, text_buffer
from fareloom.llm.tokens import TokenIds

LONG = " ".join(f"wort{i % 700}" for i in range(9000))
ROWS = [
    (1, "The cat sat on the mat.", "en", "a"),
    (2, "The  cat sat\ton the mat. ", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \n\t ", "de", None),
    (6, LONG, "de", "b"),
    (6, LONG, "de", "b"),
    (None, "the dog ran to the old house and slept", "en", "a"),
    (None, "the dog ran to the old house and slept", "en", "a"),
    (8, "der hund lief in das alte haus und schlief", "de", "c"),
    (9, LONG + " ende", "de", "c"),
    (10, "12 34 !!", None, "é"),
    (11, "Thecatsatonthemat.", "en", "a"),
    (12, "x" * 5000, "en", "b"),
    (13, "x" * 5000 + "y", "en", "b"),
]
CLASH = ("score", "block", "name", "row", "h", "size", "taken", "print", "shard", "kept", "blocks", "codes", "label")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").repartition(3, "source")
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASH))).withColumn("n_chars", F.length("text"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 14)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")


def test_lm_scoring_base_is_exact_for_any_head_and_any_rounds(docs):
    held = remainder(F.col("doc_id"), 7) == 2
    runs = [lm_scoring.score_documents(docs, held, filter_bytes=b, head_words=h).collect() for b, h in ((1 << 20, 1 << 19), (1, 3), (200, 0))]
    train = [t for i, t, *_ in ROWS if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    words = lambda t: [w for w in (t or "").encode().lower().split()] + ["end"]
    counts = Counter(w for t in train for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((i or -1, len(words(t)), sum(counts[w] > 0 for w in words(t)), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))) for i, t, *_ in ROWS)
    for rows in runs:
        got = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.base_score) for r in rows)
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)
        assert all(r.train_tokens == n and r.score <= 0 for r in rows)
    scores = [sorted((r.doc_id or -1, r.score) for r in rows) for rows in runs[:1]]
    again = sorted((r.doc_id or -1, r.score) for r in lm_scoring.score_documents(docs, held, filter_bytes=300).collect())
    assert again == scores[0]


def test_filter_finds_levels_without_false_negatives():
    keys = lm_scoring.mixed(np.arange(1, 5001, dtype=np.uint64))
    counts = np.arange(1, 5001) ** 2 % 977 + 1
    data, size = lm_scoring.filter_block(keys, counts)
    part = lm_scoring.FilterPart(0, [(0, size, data)])
    found, true = part.levels(keys), lm_scoring.level_of(counts)
    assert (found >= true).all() and (found == true).mean() > 0.97
    assert (part.levels(lm_scoring.mixed(keys + np.uint64(7))) == 0).mean() > 0.97


def test_exact_duplicates(docs):
    got = exact_dedup.exact_duplicates(docs).collect()
    bare = lambda t: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0))
    assert len(got) == len(ROWS)
    assert sum(r.kept for r in got) == len(groups)
    by_size = Counter(r.group_size for r in got)
    assert by_size == Counter(len(g) for g in groups.values() for _ in g)
    best = {min(g)[2] or None for g in groups.values()}
    assert {r.keep_id for r in got} == best
    rest = exact_dedup.without_exact_duplicates(docs)
    assert rest.columns == docs.columns and rest.count() == len(groups)


def test_block_names_with_many_levels(spark):
    texts = ["ab" * n + tail for n in (500, 1024, 5000, 9000) for tail in ("", "a", "b")] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = exact_dedup.exact_duplicates(df).collect()
    assert all(r.group_size == 2 and r.keep_id == r.doc_id % 12 for r in rows)


def test_mixing_plain_sainte_lague(spark):
    votes = {"a": 53000.0, "b": 24000.0, "c": 23000.0, "d": 0.0, None: 23000.0}
    for seats in (0, 1, 7, 100):
        df = spark.createDataFrame([(k, v, seats, 1) for k, v in votes.items()], "source string, votes double, seats long, one int")
        got = {r.source: r.quota for r in mixing.apportion(df, ["one"], "source", "votes", "seats").collect()}
        order = sorted(((-v / (2 * k + 1), s is None, s or "") for s, v in votes.items() if v for k in range(seats)))[:seats]
        want = Counter(s or None for *_, s in order)
        assert got == {s: want[s] for s in votes}


def test_mixing_targets_and_bounds(docs):
    rows = mixing.mixed_documents(docs, block=4, shard_docs=2).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r.size for r in rows)
    sizes = Counter()
    for _, t, _, s in ROWS:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        share = left / max(1, sum(weight[s] for s in names if s not in capped))
        over = {s for s in names if s not in capped and weight[s] * share > 3 * sizes[s]}
        if not over:
            target = {s: 3 * sizes[s] if s in capped else weight[s] * share for s in names}
            break
        capped |= over
    assert {round(r.target, 6) for r in rows} == {round(t, 6) for t in target.values()}
    assert abs(sum(r.taken for r in rows) - sum(sizes.values())) < 60
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in mixing.mixed_documents(docs).collect())


def _plain_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_fingerprints_and_components(docs):
    rows = simhash_dedup.near_duplicates(docs).collect()
    prints = [(i, _plain_print(t)) for i, t, *_ in ROWS]
    assert sorted((r.doc_id or -1, r.fingerprint) for r in rows) == sorted((i or -1, f"{p:016x}") for i, p in prints)
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}
    assert {r.component_id for r in rows if r.doc_id == 6} == {6}
    assert {r.component_id for r in rows if r.doc_id is None} == {None}
    rest = simhash_dedup.without_near_duplicates(docs)
    assert rest.columns == docs.columns and rest.count() == len({r.component_id if r.component_id is not None else r.fingerprint for r in rows})


def test_simhash_links_match_brute_force(spark):
    draw = np.random.default_rng(3)
    prints = {int(x) for x in draw.integers(-(2**63), 2**63 - 1, 40)}
    for p in list(prints)[:20]:
        for _ in range(6):
            a, b = draw.integers(0, 64, 2)
            q = (p & (2**64 - 1)) ^ (1 << int(a)) ^ (1 << int(b) if a != b else 0)
            p = q - 2**64 if q >= 2**63 else q
            prints.add(p)
    prints = sorted(prints)
    for bits in (0, 1, 2):
        roots = {p: p for p in prints}

        def find(x):
            while roots[x] != x:
                x = roots[x]
            return x

        for a, b in combinations(prints, 2):
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                roots[max(find(a), find(b))] = min(find(a), find(b))
        df = spark.createDataFrame([(p,) for p in prints], "print long")
        got = {r.node: r.root for r in simhash_dedup.components(simhash_dedup.links(df, bits)).collect()}
        assert {p: got.get(p, p) for p in prints} == {p: find(p) for p in prints}


def _chain(spark, parts):
    """A path of 300 nodes, a star and a pair, in several partitions."""
    draw = np.random.default_rng(5)
    path = draw.permutation(np.arange(-150, 150)).tolist()
    pairs = [*zip(path, path[1:]), *((1000, 1000 + i) for i in range(1, 40)), (2**62, -(2**63))]
    return spark.createDataFrame([(min(p), max(p)) for p in pairs], "a long, b long").repartition(parts)


@pytest.mark.parametrize("links_each, parts", [(1 << 20, 5), (50, 5)])
def test_components_of_long_chains(spark, monkeypatch, links_each, parts):
    """Few links take no step of their own; more than a task holds meet in steps."""
    names, stored = [], simhash_dedup.stored
    monkeypatch.setattr(simhash_dedup, "stored", lambda df, name: names.append(name) or stored(df, name))
    got = {r.node: r.root for r in simhash_dedup.components(_chain(spark, parts), links_each).collect()}
    want = {i: -150 for i in range(-150, 150)} | {1000 + i: 1000 for i in range(40)} | {2**62: -(2**63), -(2**63): -(2**63)}
    assert got == want
    assert (names == ["links", "roots"]) == (links_each > 350)


def test_packing_round_trip(docs):
    path = registered.vocabulary("byte_bpe_50k.json")
    rows = packing.packed(docs, path).collect()
    encoder = TokenIds(path)
    whole = lambda t: encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
    want = Counter((i, len(whole(t))) for i, t, *_ in ROWS)
    pieces = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, ids))
    for i, t, *_ in ROWS:
        ids, copies = whole(t), want[(i, len(whole(t)))]
        starts = Counter()
        for start, part in pieces[(i, len(ids))]:
            assert ids[start : start + len(part)] == part
            starts.update(range(start, start + len(part)))
        assert all(starts[p] == copies for p in range(len(ids))) and len(starts) == len(ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= 1024


def test_harmonic_classes():
    for left, sizes in enumerate(packing.cut_sizes()):
        assert sum(sizes) == left
        assert all(1024 - (1024 // s) * s <= packing.WASTE for s in sizes)


@pytest.mark.parametrize("text", ["a  b", " lead", "tail ", "x <|endoftext|> y", "a's 'll don't\nI'll", "\n", "a\n\nb. c", "é z　q", "x.\nY,"])
def test_cached_ids_are_the_tokenizers(text):
    encoder = TokenIds(registered.vocabulary("byte_bpe_50k.json"))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_language_id(spark, docs):
    rows = language_id.predict(docs, F.lit(True)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 10)} == {"und"}
    found = {r.doc_id: r.lang_pred for r in rows}
    assert found[8] == "de" and found[None] == "en"
    assert {r.lang_pred for r in language_id.predict(docs, F.lit(False)).collect()} == {"und"}
    new = spark.createDataFrame([(1, "die hunde liefen"), (2, "…"), (3, "ÉÉ")], "doc_id long, text string")
    both = docs.select("doc_id", "text", "lang").unionByName(new, allowMissingColumns=True)
    assert len(language_id.predict(both, F.col("lang").isNotNull()).collect()) == len(ROWS) + 3


def test_quality_scores_and_empty_labels(docs, labels):
    model = quality.learn(docs, labels, F.lit(True))
    rows = quality.scored(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    none = quality.learn(docs, labels.where("false"), F.lit(True))
    assert {r.score for r in quality.scored(docs, none).collect()} == {1.0}
    assert quality.accepted(docs, none).columns == docs.columns and quality.accepted(docs, none).count() == len(ROWS)


def test_hinge_model_separates():
    draw = np.random.default_rng(5)
    rows = [np.unique(np.append(draw.integers(0, 5000, 80), 7001 if i % 2 else 7002)).astype(np.int32) for i in range(400)]
    good = np.arange(400) % 2 == 1
    model = quality.fit(rows, good, np.arange(400) % 8 > 5)
    scores = model.scores(np.concatenate(rows), np.array([len(r) for r in rows]))
    assert ((scores >= 0.5) == good).mean() > 0.97


def _plain_features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    low = [w.translate({i: i + 32 for i in range(65, 91)}) for w in words]
    shapes = []
    for i, w in enumerate(words):
        kinds = ["A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127 else "0" if "0" <= c <= "9" else c for c in w]
        shapes.append(("".join(k for k, before in zip(kinds, [None, *kinds]) if k != before), i > 0 and low[i] == low[i - 1]))
    return {(f, *keys[i : i + n]) for f, (keys, n) in enumerate(((low, 1), (low, 2), (shapes, 1), (shapes, 2), (shapes, 3))) for i in range(len(keys) - n + 1)}


def test_quality_model_against_a_plain_one():
    draw = random.Random(11)
    words = ["Tea", "tea", "cup", "cup", "7up", "x-y", "über", "NOW!!", "the", "of", "2024"]
    texts = [" ".join(draw.choices(words[: 8 if i % 3 else 11], k=draw.randint(0, 25))) for i in range(60)]
    good, aside = np.arange(60) % 3 > 0, np.arange(60) % 5 == 4
    sets = [_plain_features(t) for t in texts]
    data, offsets = text_buffer(pa.array(texts, pa.large_string()))
    numbers, sizes = quality.features(data, offsets, SpanHasher())
    edges = np.concatenate(([0], np.cumsum(sizes)))
    rows = [numbers[a:b] for a, b in zip(edges[:-1], edges[1:])]
    assert [len(s) for s in sets] == list(sizes) and len(set().union(*sets)) == len(set(numbers.tolist()))
    model = quality.fit(rows, good, aside)

    own = [i for i in range(60) if not aside[i]]
    held = [Counter(f for i in own if good[i] == label for f in sets[i]) for label in (False, True)]
    mass = [2**quality.BUCKET_BITS + sum(c.values()) for c in held]
    ratio = {f: math.log((held[1][f] + 1) / mass[1]) - math.log((held[0][f] + 1) / mass[0]) for f in set().union(*sets)}

    def vector(s):
        norm = math.sqrt(sum(ratio[f] ** 2 for f in s))
        return {f: ratio[f] / max(norm, 1e-9) for f in s}

    vectors, signs = [vector(s) for s in sets], [1 if g else -1 for g in good]
    share = {sign: sum(signs[i] == sign for i in own) for sign in (1, -1)}
    bound = {i: quality.COST * len(own) / (2 * share[signs[i]]) for i in own}
    weights, bias, alphas, order = defaultdict(float), 0.0, dict.fromkeys(own, 0.0), np.random.default_rng(7)

    def margin(i):
        return sum(weights[f] * v for f, v in vectors[i].items()) + bias

    for _ in range(quality.PASSES):
        for i in (own[k] for k in order.permutation(len(own))):
            length = sum(v * v for v in vectors[i].values()) + 1
            new = min(max(alphas[i] - (signs[i] * margin(i) - 1) / length, 0.0), bound[i])
            step, alphas[i] = (new - alphas[i]) * signs[i], new
            bias += step
            for f, v in vectors[i].items():
                weights[f] += step * v
    got = model.margins(numbers, sizes)
    assert np.allclose(got, [margin(i) for i in range(60)], rtol=1e-4, atol=1e-4)

    # the descent has come near the least hinge loss: primal and dual values meet
    square = (sum(w * w for w in weights.values()) + bias * bias) / 2
    primal = square + sum(bound[i] * max(0.0, 1 - signs[i] * margin(i)) for i in own)
    dual = sum(alphas.values()) - square
    assert 0 <= primal - dual < 0.05 * primal

    # no other sigmoid near by fits the rows set aside better
    n1, n0 = int(good[aside].sum()), int((~good[aside]).sum())
    targets = np.where(good[aside], (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(slope, shift):
        p = 1 / (1 + np.exp(-(slope * got[aside] + shift)))
        return -(targets * np.log(p) + (1 - targets) * np.log(1 - p)).sum() + 5e-4 * (slope - 1) ** 2

    least = loss(model.slope, model.shift)
    assert all(loss(model.slope + a, model.shift + b) >= least - 1e-9 for a in (-0.05, 0, 0.05) for b in (-0.05, 0, 0.05))


def test_quality_learns_from_one_row_of_each_document(spark, monkeypatch):
    rows = [(i, f"{'Fine' if i % 2 else 'poor'} words {i}") for i in range(40)] + [(1, f"Fine words again {i}") for i in range(500)] + [(2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1), (5, 0), (6, 7), (None, 1)], "doc_id long, quality int")
    model = quality.learn(docs, labels, F.lit(True))
    once = docs.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    again = quality.learn(once, labels, F.lit(True))
    assert model.constant is None and np.array_equal(again.weights, model.weights) and again.shift == model.shift
    assert quality.scored(docs, model).count() == 541


@pytest.mark.parametrize("number, label, least", [("op7_quality", "quality", 0.95), ("op10_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, number, label, least):
    folder = "/root/testdata/sf0.1"
    found = registered.queries()[number](spark, folder).where("held_out")
    known = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    assert found.join(known, "doc_id").agg(F.avg((F.col("y") == F.col("predicted")).cast("int"))).first()[0] > least


def test_toxicity_rows(docs, labels):
    model, tables = toxicity.learn(docs, labels, F.lit(True))
    rows = toxicity.scored(docs, model, tables).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    model, tables = toxicity.learn(docs, labels.where("toxic = 0"), F.lit(True))
    assert {r.score for r in toxicity.scored(docs, model, tables).collect()} == {0.0}


def test_token_counts_match_plain_segmentation(docs):
    path = registered.vocabulary("piece_bpe_32k.model")
    unigrams = token_counts.Unigrams.from_file(path)

    def plain(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            width = len(word[end - 1].encode())
            options = [(best[end - 1][0] + width * unigrams.rarest, -(best[end - 1][1] + width))]
            options += [(best[s][0] + unigrams.scores[word[s:end]], -(best[s][1] + 1)) for s in range(max(0, end - unigrams.longest), end) if word[s:end] in unigrams.scores]
            top = max(options)
            best.append((top[0], -top[1]))
        return best[-1][1]

    rows = token_counts.token_counts(docs.where(F.length("text") < 200), path).collect()
    texts = Counter(sum(plain("▁" + w) for w in t.split()) for _, t, *_ in ROWS if t is not None and len(t) < 200)
    assert Counter(r.n_tokens for r in rows) == texts
    assert token_counts.token_counts(docs, path).count() == len(ROWS)


@pytest.mark.parametrize("shard_text, query_bytes", [(1 << 30, 1 << 30), (20_000, 3000)])
def test_search_matches_brute_force(docs, shard_text, query_bytes):
    asked = docs.where("doc_id in (1, 8, 6, 3, 9)").select(F.col("doc_id").alias("query_id"), "text").distinct()
    got = defaultdict(list)
    for r in search.search(docs, asked, 4, shard_text, query_bytes).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    bags = [Counter((t or "").encode().lower().split()) for _, t, *_ in ROWS]
    mean = sum(b.total() for b in bags) / len(bags)
    df = Counter(w for b in bags for w in b)
    idf = {w: math.log1p((len(bags) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    for q in (1, 8, 6, 9):
        terms = next(b for (i, *_), b in zip(ROWS, bags) if i == q)
        scores = []
        for (i, *_), bag in zip(ROWS, bags):
            s = sum(idf[w] * bag[w] * 2.2 / (bag[w] + 1.2 * (0.25 + 0.75 * bag.total() / mean)) for w in terms if w in bag)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        want = [(i or None, -s) for s, _, i in sorted(scores)[:4]]
        assert [i for i, _ in got[q]] == [i for i, _ in want]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want])
    assert 3 not in got


def test_search_passes_on_no_more_hits_for_more_shards(spark, monkeypatch):
    """A task keeps the best of all its shards; equal texts of different shards come by id, null ids last."""
    rows = [(i if i % 50 else None, f"common w{i % 7} x{i % 90} " * (1 + i % 3)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(i, f"common w{i} x{i} none") for i in range(5)] + [(5, "unheard"), (6, None)], "query_id long, text string")
    counts, stored = Counter(), search.stored

    def seen(df, name):
        out = stored(df, name)
        counts[name] += out.count()
        return out

    monkeypatch.setattr(search, "stored", seen)
    most, batch = 2 * spark.sparkContext.defaultParallelism * 5 * 4, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    many = search.search(docs, asked, 4, 300).orderBy("query_id", "rank").collect()
    assert counts["search_index"] > 100 and len(many) <= counts["search_found"] <= most
    whole = search.search(docs, asked, 4).orderBy("query_id", "rank").collect()
    assert many == whole and len(whole) == 20
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batch


def test_a_task_counts_a_term_of_all_its_shards_once():
    shards = [([3, 5, 9], [0, 2, 3, 7]), ([], [0]), ([5, 8], [0, 10, 11])]
    columns = [pa.array([np.array(v, k).tobytes() for v in c], pa.binary()) for c, k in zip(zip(*shards), ("<u8", "<i8"))]
    batches = pa.RecordBatch.from_arrays(columns, ["terms", "firsts"])
    shared = type("Shared", (), {"value": np.array([3, 4, 5, 9, 10], np.uint64)})
    rows = [r for b in search._frequencies(shared)(iter([batches.slice(0, 2), batches.slice(2)])) for r in b.to_pylist()]
    assert rows == [{"term": 0, "df": 2}, {"term": 2, "df": 11}, {"term": 3, "df": 4}]


def test_document_frequencies_reach_the_driver_in_few_rows(spark, monkeypatch):
    """Neither a row nor a batch of its own for each term of a block, and every term keeps its frequency."""
    rows = [(i, " ".join(f"w{500 * i + j}" for j in range(1000))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fetched = []
    for name, parts in (("collect", len), ("toArrow", lambda table: table.column(0).num_chunks)):
        plain = getattr(type(docs), name)
        monkeypatch.setattr(type(docs), name, lambda df, plain=plain, parts=parts: (out := plain(df), fetched.append(parts(out)))[0])
    best = search.search(docs, docs.select(F.col("doc_id").alias("query_id"), "text"), 1, 20_000)
    monkeypatch.undo()
    assert 20_500 > search.DEALT and sum(fetched) < 20
    once, twice = math.log1p(39.5 / 1.5), math.log1p(38.5 / 2.5)
    want = {i: 500 * (once + twice) if i in (0, 39) else 1000 * twice for i in range(40)}
    got = {r.query_id: r for r in best.collect()}
    assert {q: r.doc_id for q, r in got.items()} == {i: i for i in range(40)}
    assert np.allclose([got[i].score for i in range(40)], [want[i] for i in range(40)])


@pytest.mark.parametrize("cells", [0, 2000, 4 << 20])
def test_a_shard_is_narrow_and_scored_in_groups(monkeypatch, cells):
    """Two bytes for a posting's document and for its times; as many common terms by document as fit change no result."""
    monkeypatch.setattr(search, "COMMON_CELLS", cells)
    draw, n = np.random.default_rng(7), 300
    texts = [" ".join(f"w{min(w, 400)}" for w in draw.zipf(1.4, draw.integers(0, 60))) for _ in range(n - 20)]
    texts += texts[:20]
    rows = pa.table({"doc_id": list(range(n)), "text": texts, "row": [0] * n})
    built = search._build((pa.scalar(0),), rows)
    arrays = search._arrays(built)
    assert len(built["docs"][0].as_py()) == 2 * len(arrays["docs"]) == len(built["times"][0].as_py())
    keys, df = arrays["terms"], np.diff(arrays["firsts"])
    idf, mean = np.log1p((n - df + 0.5) / (df + 0.5)), arrays["lengths"].mean()
    weights = np.zeros((n, len(keys)))
    times = arrays["times"].astype(float)
    weights[arrays["docs"], np.repeat(np.arange(len(keys)), df)] = times * 2.2 / (times + 1.2 * (0.25 + 0.75 * arrays["lengths"][arrays["docs"]] / mean))
    queries = [np.sort(draw.choice(len(keys), size, replace=False)) for size in (0, 1, 5, 40, len(keys))]
    for q, (docs, scores) in zip(queries, search.ShardIndex(n, arrays, mean, keys, idf).search(queries, 10)):
        want = weights[:, q] @ idf[q]
        order = [d for d in np.lexsort((np.arange(n), -np.round(want, 9))) if want[d] > 0][:10]
        assert docs.tolist() == order and np.allclose(scores, want[order])


def test_a_search_visits_windows_of_like_documents_alone():
    """Documents of eight subjects, mixed by id: a query of one subject leaves the windows of the others unscored, and finds the best."""
    draw, n, k = np.random.default_rng(5), 4096, 10
    subject = np.arange(n) * 5 % 8
    texts = [" ".join(["all", *(f"s{t}w{w}" for w in draw.integers(0, 60, 25)), f"own{i}"]) for i, t in enumerate(subject)]
    rows = pa.table({"doc_id": list(range(n)), "text": texts, "row": [0] * n})
    arrays = search._arrays(search._build((pa.scalar(0),), rows))
    assert sorted(arrays["order"].tolist()) == list(range(n)) and np.count_nonzero(np.diff(subject[arrays["order"]])) < 16
    keys, df = arrays["terms"], np.diff(arrays["firsts"])
    idf, mean = np.log1p((n - df + 0.5) / (df + 0.5)), arrays["lengths"].mean()
    times, owner = arrays["times"].astype(float), np.repeat(np.arange(len(keys)), df)
    shares = times * 2.2 / (times + 1.2 * (0.25 + 0.75 * arrays["lengths"][arrays["docs"]] / mean)) * idf[owner]
    index, seen = search.ShardIndex(n, arrays, mean, keys, idf), []

    class Weights:
        def __init__(self, window, weights):
            self.window, self.weights = window, weights

        def take(self, *args, **named):
            seen.append(self.window)
            return self.weights.take(*args, **named)

    index.windows = [(a, b, c, Weights((a, b), w), t) for a, b, c, w, t in index.windows]
    queries = [np.unique(owner[arrays["docs"] == i]) for i in np.flatnonzero(subject == 3)[:40]]
    for q, (docs, scores) in zip(queries, index.search(queries, k)):
        asked = np.zeros(len(keys), bool)
        asked[q] = True
        mine = asked[owner]
        want = np.bincount(arrays["docs"][mine], shares[mine], n)
        assert docs.tolist() == np.lexsort((np.arange(n), -np.round(want, 9)))[:k].tolist() and np.allclose(scores, want[docs])
    assert len(index.windows) >= 32 and 0 < len(seen) <= len(index.windows) // 4


def test_queries_of_like_terms_share_a_group():
    draw, df = np.random.default_rng(6), np.full(400, 30)
    block = [(i, np.sort(draw.choice(50, 20, replace=False) + i % 8 * 50).astype(np.int32)) for i in range(1024)]
    ordered = search._like_queries(block, df)
    assert sorted(r for r, _ in ordered) == list(range(1024)) and all(terms is block[r][1] for r, terms in ordered)
    assert np.count_nonzero(np.diff([r % 8 for r, _ in ordered])) < 16


def test_empty_tables(spark, docs, labels):
    none = docs.where("false")
    path, pieces = registered.vocabulary("byte_bpe_50k.json"), registered.vocabulary("piece_bpe_32k.model")
    model = quality.learn(none, labels, F.lit(True))
    toxic, tables = toxicity.learn(none, labels, F.lit(True))
    for df in (
        lm_scoring.score_documents(none, F.lit(False)),
        exact_dedup.exact_duplicates(none),
        mixing.mixed_documents(none),
        language_id.predict(none, F.lit(True)),
        search.search(none, none.select(F.col("doc_id").alias("query_id"), "text")),
        packing.packed(none, path),
        quality.scored(none, model),
        token_counts.token_counts(none, pieces),
        simhash_dedup.near_duplicates(none),
        toxicity.scored(none, toxic, tables),
    ):
        assert df.count() == 0


def test_language_id_keeps_every_word_and_language(spark):
    """A small language beside one with more distinct words than the former cap of 60,000."""

    def word(i, letters):
        return "".join(letters[i // len(letters) ** k % len(letters)] for k in range(6))

    common = [(i, " ".join(2 * [word(i * 1750 + j, "abcdefgh") for j in range(1750)]), "xx") for i in range(40)]
    rare = [(100, " ".join(word(j, "mnop") for j in range(20)), "yy"), (101, "你好世界今天天气", "zz")]
    asked = [(200, " ".join(word(j, "mnop") for j in range(10)), None), (201, "世界今天", None), (202, word(69_999, "abcdefgh"), None)]
    rows = spark.createDataFrame(common + rare + asked, "doc_id long, text string, lang string").repartition(4)
    tables = language_id.learn(rows, F.lit(True))
    assert tables.languages == ["xx", "yy", "zz"] and len(tables.words.keys) == 70_000 + 20 + 1
    found = {r.doc_id: r.lang_pred for r in language_id.predict(rows, F.lit(True)).collect()}
    assert (found[200], found[201], found[202], found[100], found[101]) == ("yy", "zz", "xx", "yy", "zz")


def test_language_id_matches_plain_backoff(spark, docs):
    """Probabilities against dense log frequencies of all words and n-grams."""
    rows = [r for r in ROWS if r[1] and r[2]]
    counts = defaultdict(Counter)
    for _, text, lang, _ in rows:
        counts[lang].update("".join(c if c.isalpha() else " " for c in text.lower()).split())
    langs = sorted(counts)

    def grams(word, n):
        return [f"<{word}>"[i : i + n] for i in range(len(word) + 3 - n)]

    weights = {n: {x: Counter() for x in langs} for n in range(6)}
    for x in langs:
        weights[0][x].update(counts[x])
        for w, times in counts[x].items():
            for n in range(1, 6):
                for g in grams(w, n):
                    weights[n][x][g] += math.log1p(times)
    whole = {n: {x: sum(weights[n][x].values()) for x in langs} for n in range(6)}

    def score(n, key, x):
        each = sum(weights[n][y][key] for y in langs) / sum(whole[n].values())
        return math.log((weights[n][x][key] + 100 * each) / (whole[n][x] + 100))

    asked = "the hundy schliefen catmat qqq schlafhaus hund"
    sums = dict.fromkeys(langs, 0.0)
    for w in asked.split():
        known = next(((n, k) for n, keys in [(0, [w]), *((n, grams(w, n)) for n in range(5, 0, -1))] if (k := [g for g in keys if any(weights[n][x][g] for x in langs)])), None)
        for x in langs:
            sums[x] += sum(score(known[0], g, x) for g in known[1]) / len(known[1]) if known else 0
    best = max(langs, key=sums.get)
    new = spark.createDataFrame([(900, asked, None)], "doc_id long, text string, lang string")
    [got] = language_id.predict(docs.select("doc_id", "text", "lang").unionByName(new), F.lit(True)).where("doc_id = 900").collect()
    assert got.lang_pred == best and math.isclose(got.score, 1 / sum(math.exp(v - sums[best]) for v in sums.values()), rel_tol=1e-4)


def test_sample_leaves_no_class_out(spark):
    rows = spark.range(1200).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), F.col("id") % 300).alias("lang"))
    more = spark.range(1200, 41_200).select(F.col("id").alias("doc_id"), F.lit("big").alias("lang"))
    none = spark.range(5).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("lang"))
    taken = dict(bounded_sample(rows.unionByName(more).unionByName(none), "lang", 1000, F.col("doc_id")).groupBy("lang").count().collect())
    assert len(taken) == 301 and {taken[f"l{i}"] for i in range(300)} == {4} and 850 < taken["big"] < 1150


def test_toxicity_learns_from_one_row_of_each_document(spark, monkeypatch):
    sizes = []
    first = toxicity._one_each
    monkeypatch.setattr(toxicity, "_one_each", lambda sample: (sizes.append((sample.count(), first(sample).count())), first(sample))[1])
    rows = [(i, f"{'bad' if i % 2 else 'good'} words {i}", "en") for i in range(40)] + [(1, f"bad words again {i}", "en") for i in range(500)] + [(2, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model, tables = toxicity.learn(docs, labels, F.lit(True))
    assert sizes == [(541, 40)] and model.constant is None
    assert toxicity.scored(docs, model, tables).count() == 541
    once = docs.groupBy("doc_id").agg(F.min_by(F.struct("text", "lang"), F.xxhash64("text")).alias("r")).select("doc_id", "r.*")
    assert np.array_equal(toxicity.learn(once, labels, F.lit(True))[0].last, model.last)
