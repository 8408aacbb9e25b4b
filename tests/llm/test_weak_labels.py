"""Toxicity scores by held-out accuracy, and the label model on votes of known accuracy."""

import zlib

import numpy as np

from marketlens.llm import weak_labels

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r for r in weak_labels.op7(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    test = [(r.toxic, rows[r.doc_id].predicted) for r in labels.collect() if rows[r.doc_id].held_out]
    hits, found, toxic = sum(a * b for a, b in test), sum(b for _, b in test), sum(a for a, _ in test)
    print(hits, found, toxic)
    assert hits / found > 0.85 and hits / toxic > 0.85


def test_label_model_recovers_accuracies_and_a_copied_voter():
    rng = np.random.default_rng(1)
    rule = weak_labels.Supervision(precision=(0.5, 0.8))
    n, truth = 8, rng.random(20000) < 0.2
    votes = np.ones((20000, n + 4), dtype=int)
    for j in range(n):
        votes[:, j] = np.where(truth, np.where(rng.random(20000) < 0.4, 2, 1), np.where(rng.random(20000) < 0.02, 2, 1))
    votes[:, 1] = votes[:, 0]
    model = weak_labels.label_model(votes, np.ones(len(votes)), 0.2, rule)
    assert model.correlation[0, 1] > 0.9 and abs(model.correlation[2, 3]) < 0.2
    assert model.voice[0] < 0.6 and model.voice[2] > 0.9
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.93


def test_edge_rows(spark):
    rows = [(k, f"{'grimword' if k % 3 == 0 else 'plain'} text number {k} x", "a", 0) for k in range(90)]
    rows += [(90, None, "a", 0), (91, "", "a", 0), (91, "", "a", 0), (None, "grimword", "b", 0), (92, "grimword " * 30000, "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, votes string, score int")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(80)] + [(90, None)], "doc_id long, toxic int")
    got = weak_labels.op7(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[k].predicted == (k % 3 == 0) for k in range(90))
    assert by[90].predicted == by[91].predicted == 0 and by[None].predicted == by[92].predicted == 1
    clean = weak_labels.clean_documents(docs, labels)
    assert clean.columns == docs.columns and clean.count() == 63
    assert weak_labels.op7(docs.limit(0), labels).count() == 0
    none = weak_labels.op7(docs, labels.limit(0)).collect()
    assert len(none) == len(rows) and all(r.score == 0 for r in none)


def test_model_of_many_vectors_is_that_of_all_at_once(spark):
    """Rare vectors, labelled ones among them, count as much as they occur, wherever the model starts."""
    rng = np.random.default_rng(6)
    rule = weak_labels.Supervision(precision=(0.5, 0.8), start_vectors=15)
    truth = rng.random(3000) < 0.3
    votes = np.where(truth[:, None], np.where(rng.random((3000, 12)) < 0.5, 2, 1), np.where(rng.random((3000, 12)) < 0.06, 2, 1))
    text = ["".join("-0+"[v] for v in row) for row in votes]
    label = [int(t) if k % 40 == 0 else None for k, t in enumerate(truth)]
    rows = spark.createDataFrame(list(zip(text, label)), "votes string, toxic int")
    patterns = rows.groupBy("votes", "toxic").count()
    assert patterns.count() > 500
    model = weak_labels.label_model_of(patterns, 0.3, rule)
    whole = patterns.collect()
    known = np.array([r.toxic for r in whole], dtype=float)
    plain = weak_labels.label_model(weak_labels.coded([r.votes for r in whole]), np.array([float(r["count"]) for r in whole]), 0.3, rule, known)
    assert np.abs(model.log_odds - plain.log_odds).max() < 1e-2
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.95


def test_statistics_agree_with_plain_sums():
    rng = np.random.default_rng(7)
    votes, counts, belief = rng.integers(0, 3, (40, 5)), rng.integers(1, 9, 40).astype(float), rng.random(40)
    rule = weak_labels.Supervision(precision=(0.5,))
    model = weak_labels.estimated(weak_labels.statistics(votes, counts, belief), 5, 0.2, rule, True)
    tables = []
    for weight in (counts * belief, counts * (1 - belief)):
        table = np.array([[weight[votes[:, j] == v].sum() for v in range(3)] for j in range(5)]) + 0.1
        tables.append(table / table.sum(axis=1, keepdims=True))
    means = [t @ np.array([-1, 0, 1]) for t in tables]
    rest = votes - 1.0 - belief[:, None] * means[0] - (1 - belief[:, None]) * means[1]
    spread = (rest * counts[:, None]).T @ rest / counts.sum()
    assert np.allclose(model.correlation, spread / np.sqrt(np.outer(np.diag(spread), np.diag(spread))))


def test_all_letters_count(spark):
    for text, expected in [("", (0, 0)), ("ABc é1!", (4, 2)), ("Hello there", (10, 1)), ("ÀÉ" * 50_000 + "x", (100_001, 100_000))]:
        assert weak_labels.letters(text) == expected
    docs = spark.createDataFrame([(1, "Hello there"), (2, "WHAT a DAY OF"), (3, "xxxxxxA" * 30)], "doc_id long, text string")
    rows = weak_labels.features(docs, "doc_id", "text", {}, weak_labels.Supervision()).collect()
    shouting = len(weak_labels.KINDS) * weak_labels.Supervision().lists
    assert {r.id: r.votes[shouting] for r in rows} == {1: "0", 2: "+", 3: "0"}
