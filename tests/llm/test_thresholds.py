"""Thresholds of the toxicity classifier come from all labelled rows set aside."""

import numpy as np
from pyspark.sql import functions as F

from fareloom.llm import toxicity


def test_thresholds_count_every_row_set_aside(spark, monkeypatch):
    n, given = 3000, []
    first = toxicity.calibrate
    monkeypatch.setattr(toxicity, "calibrate", lambda *a: (given.append(a), first(*a))[1])
    rows = [(i, f"{'awful nasty' if i % 2 else 'good calm'} words {i % 7}", "en") for i in range(n)]
    docs = spark.createDataFrame([*rows, (1, "another row of document one", "en"), (None, "no id", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)] + [(3, 1), (n + 5, 1), (None, 1)], "doc_id long, toxic int")
    model, tables = toxicity.learn(docs, labels, F.lit(True), rows_each=200)
    aside = spark.range(n).select(F.col("id").alias("doc_id")).where(toxicity._draw() % 4 == 3).groupBy((F.col("doc_id") % 2).alias("y")).count()
    counts = given[0][0]
    assert {0: sum(r[3] for r in counts), 1: sum(r[2] for r in counts)} == {r["y"]: r["count"] for r in aside.collect()}
    predicted = toxicity.scored(docs.where(f"doc_id between 4 and {n}"), model, tables)
    assert predicted.where("predicted != doc_id % 2").count() == 0


def test_threshold_of_counted_steps():
    model = toxicity.train([], np.zeros(0, bool))
    model.constant = None
    # Toxic rows lie from step 300 on; the language "b" has too few and takes the threshold of all.
    counts = [("a", 290, 0, 90), ("a", 300, 60, 0), ("a", 900, 40, 1), ("b", 10, 0, 50), ("b", 400, 5, 0)]
    toxicity.calibrate(counts, model)
    assert set(model.thresholds) == {"a"} and model.thresholds["a"] == 300 / toxicity.SCORE_STEPS == model.threshold
    raw = np.array([299.9, 300.0]) / toxicity.SCORE_STEPS
    assert list(model.scores(raw, ["a", "b"]) >= toxicity.THRESHOLD) == [False, True]
