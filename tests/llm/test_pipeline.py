"""The pipeline's stages against plain versions, and registered queries against their SQL."""

from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from fareloom.llm import mixing, quality, registered
from fareloom.llm.common import documents, labels, remainder, stored
from tests.llm.test_operators import _plain_print
from tests.oracle_check import compare, connect

SQL = registered.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, small, name):
    assert compare(registered.queries()[name](spark, small), connect(small), SQL[name]) is None


def test_stages(spark, small):
    docs, kept = documents(spark, small), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, small), name)
        kept[name] = (before, docs)
    columns = documents(spark, small).columns
    assert all(after.columns == columns for name, (_, after) in kept.items() if name != "packing")

    before, after = kept["quality"]
    model = quality.learn(before, labels(spark, small), remainder(F.col("doc_id"), 4) != 2)
    good = {r.doc_id for r in quality.scored(before, model).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == good

    before, after = kept["exact_dedup"]
    groups = defaultdict(list)
    for r in before.collect():
        groups["".join(r.text.split())].append((-len(r.text), r.doc_id))
    assert {r.doc_id for r in after.collect()} == {min(g)[1] for g in groups.values()}

    before, after = kept["simhash_dedup"]
    rows = [(_plain_print(r.text), -len(r.text), r.doc_id) for r in before.collect()]
    root = {p: p for p, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    prints = sorted(root)
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(list)
    for p, *rest in rows:
        groups[find(p)].append(tuple(rest))
    assert {r.doc_id for r in after.collect()} == {min(g)[1] for g in groups.values()}

    before, after = kept["mixing"]
    taken = {r.doc_id: r.taken for r in mixing.mixed_documents(before).collect()}
    words = Counter()
    for r in after.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert words == Counter({k: v for k, v in taken.items() if v})

    before, after = kept["packing"]
    assert after.agg(F.sum("length")).first()[0] == sum(
        r.doc_tokens for r in after.where("start = 0").collect()
    )


def _plain_ids(text):
    return [*tokenizers.Tokenizer.from_file(registered.vocabulary("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, 0]


def test_run_with_nulls_repeats_and_no_rows(spark, tmp_path):
    copy = "a b c d " * 30
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, copy, "en", "a", 240), (3, copy, "en", "a", 240),
        (4, copy.replace(" ", "  "), "en", "b", 480), (None, "d e", None, None, 3), (5, "one two three", "en", "b", 13),
    ]
    # no label: none is rejected; of the four empty or repeated texts one each stays, of the copies the longest
    mixed_words = {}
    for name, data in (("some", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        docs, kept = documents(spark, folder), {}
        for stage, function in corpus_pipeline.STAGES[:-1]:
            docs = stored(function(spark, docs, folder), stage)
            kept[stage] = docs.collect()
        got = corpus_pipeline.run(spark, folder).collect()
        want = [(r.doc_id, tuple(_plain_ids(r.text))) for r in kept["mixing"]]
        pieces = defaultdict(list)
        for r in got:
            pieces[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
        assert {k: Counter(v) for k, v in pieces.items()} == {k: sum((Counter(ids) for d, ids in want if d == k), Counter()) for k, _ in want}
        mixed_words[name] = Counter()
        for r in kept["mixing"]:
            mixed_words[name][r.source] += len(r.text.split())
        if data:
            assert sorted((r.doc_id or 0, r.text or "") for r in kept["quality"]) == sorted((r[0] or 0, r[1] or "") for r in rows)
            alive = [(1, None), (4, copy.replace(" ", "  ")), (5, "one two three"), (None, "d e")]
            assert Counter((r.doc_id, r.text) for r in kept["exact_dedup"]) == Counter(alive)
            assert Counter((r.doc_id, r.text) for r in kept["simhash_dedup"]) == Counter(alive)
    # sources b and null hold 123 and 2 words and weigh 1 and 2; null stops at three times its size; a block has 16 words
    assert not mixed_words["none"] and abs(mixed_words["some"][None] - 6) <= 16 and abs(mixed_words["some"]["b"] - 119) <= 16
