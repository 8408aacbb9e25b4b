"""Planted rules, the penalty against a plain descent, and accuracy on rows held out."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import rule_ensemble as R

FOLDER = "/root/testdata/sf0.1"


def test_rules_find_planted_conjunctions():
    rng = np.random.default_rng(1)
    x = rng.random((6000, 9))
    good = ~(((x[:, 2] > 0.8) & (x[:, 5] <= 0.5)) | (x[:, 7] > 0.9))
    y = np.where(rng.random(6000) < 0.03, ~good, good).astype(int)
    model = R.learned(x, y)
    fresh = rng.random((4000, 9))
    truth = ~(((fresh[:, 2] > 0.8) & (fresh[:, 5] <= 0.5)) | (fresh[:, 7] > 0.9))
    z = np.full(len(fresh), model.base) + sum(w * R.holds(fresh, rule) for rule, w in model.weights)
    assert ((R._sigmoid(z) >= 0.5) == truth).mean() > 0.98
    assert len(model.weights) < 60 and all(len(rule) <= 3 for rule, _ in model.weights)
    assert len(R.described(model)) == len(model.weights)


def test_noise_needs_hardly_any_rule():
    rng = np.random.default_rng(2)
    y = (rng.random(4000) < 0.2).astype(int)
    model = R.learned(rng.random((4000, 9)), y)
    assert len(model.weights) < 12
    assert abs(1 / (1 + np.exp(-model.base)) - 0.2) < 0.1


def test_descent_meets_the_conditions_of_the_optimum():
    """At the optimum the slope of a weight that is zero is within the penalty, of another equal to it."""
    rng = np.random.default_rng(3)
    r = (rng.random((800, 12)) < 0.4).astype(float)
    y = (rng.random(800) < R._sigmoid(2 * r[:, 0] - 3 * r[:, 1])).astype(float)
    design = np.column_stack([np.ones(800), r])
    step = 4 / np.linalg.norm(design.T @ design / 800, 2)
    w = R._descended(design, y, 0.02, np.zeros(13), step, 5000)
    slope = design.T @ (R._sigmoid(design @ w) - y) / 800
    assert abs(slope[0]) < 1e-3
    for k in range(1, 13):
        assert abs(slope[k] + 0.02 * np.sign(w[k])) < 1e-3 if w[k] else abs(slope[k]) < 0.02 + 1e-3


def test_paths_are_simplified():
    path = [(2, True, 1.0), (2, True, 3.0), (0, False, 5.0), (0, False, 4.0), (2, False, 9.0)]
    assert R.simplified(path) == ((0, False, 4.0), (2, False, 9.0), (2, True, 3.0))


def test_expression_agrees_with_the_rules(spark):
    rng = np.random.default_rng(5)
    x = rng.random((500, 2)).round(2)
    model = R.Model(0.3, ((((0, True, 0.5), (1, False, 0.25)), 2.0), (((1, True, 0.75),), -1.5)))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "i int, a double, b double")
    got = [r.s for r in df.select("i", R.expression(model, [F.col("a"), F.col("b")]).alias("s")).orderBy("i").collect()]
    z = model.base + sum(w * R.holds(x, rule) for rule, w in model.weights)
    assert np.allclose(got, R._sigmoid(z))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r for r in R.op12(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [(r.quality, rows[r.doc_id]) for r in labels.collect() if rows[r.doc_id].held_out]
    good = [r for q, r in held if q == 1]
    bad = [r for q, r in held if q == 0]
    pairs = [(g.score > b.score) + (g.score == b.score) / 2 for g in good for b in bad]
    print(len(good), sum(r.predicted for r in good), len(bad), sum(r.predicted for r in bad), sum(pairs) / len(pairs))
    assert sum(r.predicted for r in good) > 0.98 * len(good)
    assert sum(r.predicted for r in bad) < 0.25 * len(bad)
    assert sum(pairs) / len(pairs) > 0.95


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn("quality", F.when(R.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(R.op12(docs, labels).collect()) == sorted(R.op12(docs, flipped).collect())


@pytest.mark.parametrize("kinds", [[], [1], [0]])
def test_labels_of_one_kind(spark, kinds):
    docs = spark.createDataFrame([(k, "some words") for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k in range(20) for q in kinds], "doc_id long, quality int")
    scores = {r.score for r in R.op12(docs, labels).collect()}
    assert len(scores) == 1
    assert abs(scores.pop() - (kinds[0] if kinds else 0.5)) < 1e-3


def test_edge_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, None, "q", 1), (2, "", "q", 1), (3, text, "q", 1), (3, text, "q", 1), (None, text, "q", 1), (5, text * 2000, "q", 1)],
        "doc_id long, text string, score string, id int")
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (None, 0), (2, None), (5, 7)], "doc_id long, quality int")
    rows = R.op12(docs, labels).collect()
    assert len(rows) == 6 and all(r.score is not None and r.held_out is not None for r in rows)
    assert R.op12(docs.limit(0), labels).count() == 0
