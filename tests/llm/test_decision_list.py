"""Measures against a plain count, and learned rules on planted ones."""

import random
import re

import numpy as np

from marketlens.llm import decision_list

FOLDER = "/root/testdata/sf0.1"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 300 else None
    if twice is None:
        seen = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        twice = {w for w, n in seen.items() if n > 1}
    places = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places))


def test_measures_of_random_texts():
    rng = random.Random(8)
    parts = ["a", "b", "é", "中x", "#*", " ", " ", "\n", "\t", "\x0b", "\x85", "\xa0", "\x1c", "!", "A B C\n"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        assert tuple(decision_list.measures_of(text)[:5]) == plain(text)


def test_whole_table_and_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r for r in decision_list.op6(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert rows.keys() == texts.keys()
    for k, text in texts.items():
        r = rows[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    known = [(r.quality, rows[r.doc_id].kept) for r in labels.collect() if not rows[r.doc_id].base_failed]
    good = [kept for q, kept in known if q == 1]
    bad = [kept for q, kept in known if q == 0]
    print(sum(good), len(good), sum(bad), len(bad))
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.2


def test_rules_find_planted_thresholds():
    rng = np.random.default_rng(4)
    x = rng.random((6000, 9))
    bad = ((x[:, 2] > 0.8) & (x[:, 5] <= 0.5)) | (x[:, 7] > 0.9)
    rules = decision_list.learned(x, bad)
    verdict = np.zeros(len(x), dtype=bool)
    for rule in rules:
        verdict |= decision_list._holds(x, rule)
    assert (verdict == bad).mean() > 0.97
    assert all("<=" in d or ">" in d for d in decision_list.described(rules))
    noise = decision_list.learned(x, rng.random(6000) < 0.1)
    assert sum(decision_list._holds(x, r).sum() for r in noise) < 60


def test_edge_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, None, "q", True), (2, "", "q", True), (3, text, "q", True), (3, text, "q", True), (None, text, "q", True),
         (4, "same words here " * 30, "q", True), (5, text * 2000, "q", True)],
        "doc_id long, text string, text_key string, kept boolean")
    labels = spark.createDataFrame([(1, 0), (3, 1), (None, 0), (4, None)], "doc_id long, quality int")
    rows = decision_list.op6(docs, labels).collect()
    assert len(rows) == 7
    assert {(r.doc_id, r.kept) for r in rows} == {(1, False), (2, False), (3, True), (None, True), (4, False), (5, False)}
    good = decision_list.good_documents(docs, labels)
    assert good.columns == docs.columns and sorted(str(r.doc_id) for r in good.collect()) == ["3", "3", "None"]
    assert decision_list.op6(docs.limit(0), labels).count() == 0
    assert decision_list.op6(docs, labels.limit(0)).count() == 7
