"""Variants against all pairs of words compared character by character."""

import random
import re
import zlib
from collections import Counter

import pytest

from marketlens.llm import permuterm

LOWER = str.maketrans(permuterm.CAPITALS, permuterm.CAPITALS.lower())


def words_of(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return found


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, shortest=7, rarest=2, ratio=10):
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= rarest}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    forms, rows = {}, []
    for w, n in words.items():
        others = [o for k in (-1, 0, 1) for o in by_length.get(len(w) + k, ()) if o != w and near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best and words[best] >= ratio * n else None
        rows.append((w, n, len(others)))
    out = []
    for w, n, k in rows:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, k, words[forms[w]] if forms[w] else None))
    return sorted(out)


def collected(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_random_words_of_few_letters(spark, seed):
    """Two letters and lengths near each other: runs of equal letters, ties, and a dense net of links."""
    rng = random.Random(seed)
    counts = Counter()
    for _ in range(250):
        word = "".join(rng.choice("aab" if seed % 2 else "abé") for _ in range(rng.randrange(1, 7)))
        counts[word] = rng.choice([2, 3, 3, 25, 30, 300, 4000])
    how = permuterm.Variants(shortest=1)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert collected(permuterm.variants(df, how)) == plain(counts, shortest=1)


def test_chain_of_forms(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "zzzzzzz": 5}
    rows = collected(permuterm.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert rows == plain(counts)
    assert rows[0][:3] == ("aaaaaaa", "aaaaaab", "aaabbbb")


def test_texts_nulls_and_repeats(spark):
    rng = random.Random(3)
    base = ["Grenzgängerin", "grenzgängerinn", "GRENZGÄNGERIN", "letterhead", "lettrhead", "letterheads", "naïveté÷×ÿ", "short"]
    rows = [(i, " ".join(rng.choices(base, [90, 5, 3, 90, 5, 9, 9, 9], k=40)) + "." * (i % 3)) for i in range(60)]
    rows += [(None, "letterhead lettrhead"), (None, None), (7, None), (8, ""), (9, " ... 123"), (9, "letterhead"), (9, "letterhead"),
             (10, "letterhead-letterhead " * 5000), (11, "x" * 3000), (12, "x" * 3000), (13, "\U00010400letterhead\U00010400")]
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert collected(permuterm.op11(df)) == plain(words_of(rows))
    assert permuterm.op11(df.limit(0)).count() == 0


def test_ranges_are_bounded_by_the_alphabet(spark):
    """However frequent the words, a range holds one row per letter and one for the shorter word."""
    letters = [chr(c) for c in [*range(97, 123), *range(0xE0, 0x100)]]
    words = ["prefix" + c + "suffix" for c in letters] + ["prefixsuffix"]
    df = spark.createDataFrame([(w, 10 + k) for k, w in enumerate(words)], "word string, n long")
    sizes = permuterm.rotations(df).groupBy("prefix").count().agg({"count": "max"}).first()[0]
    assert sizes == len(letters) + 1
    got = collected(permuterm.variants(df))
    assert got == plain(dict((w, 10 + k) for k, w in enumerate(words)))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = words_of([(r.doc_id, r.text) for r in docs.collect()])
    got = {r[0]: r for r in collected(permuterm.op11(docs))}
    assert {w: r[3] for w, r in got.items()} == {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
