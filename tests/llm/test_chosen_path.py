"""Near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from marketlens.llm import chosen_path
from marketlens.llm import components as components_module
from marketlens.llm.components import components

FOLDER = "/root/testdata/sf0.01"


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_force(docs, width):
    """(id, size, component, kept) of every document, by all pairs that share a shingle."""
    sets = {k: shingle_set(t, width) for k, t in docs}
    parent = {k: k for k, _ in docs}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders, done = {}, set()
    for k, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, s in sets.items():
        shared = {}
        for x in s:
            for other in holders[x]:
                if other < k:
                    shared[other] = shared.get(other, 0) + 1
        for other, both in shared.items():
            if 100 * both >= 80 * (len(s) + len(sets[other]) - both):
                a, b = sorted((root(k), root(other)))
                parent[b] = a
                done.add((k, other))
    return {(k, len(sets[k]), root(k), root(k) == k) for k in parent}


@pytest.mark.parametrize("width", [2, 5])
def test_whole_table(spark, width):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = chosen_path.near_duplicates(docs, width=width).collect()
    assert set(map(tuple, rows)) == brute_force([(r.doc_id, r.text) for r in docs.collect()], width)
    assert len(rows) == docs.count()


def test_large_groups_and_edge_rows(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = []
    for _ in range(400):  # near copies of one text, at different distances
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += ["same text again and again"] * 150
    texts += [f"the very common line {rng.randrange(10**9)} {rng.randrange(10**9)}" for _ in range(300)]
    texts += ["", "  \n", None, "one", "ONE", "one ", "É é", "é É"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, "z", 3) for k, t in docs], "doc_id long, text string, key string, n int")
    rows = chosen_path.op5(df).collect()
    assert set(map(tuple, rows)) == brute_force(docs, 2)


def by_products(texts):
    """Component of every text's word set: the smallest place reachable, from the products of all pairs."""
    words = {w: i for i, w in enumerate(sorted({w for t in texts for w in t.split()}))}
    held = np.zeros((len(texts), len(words)), dtype=np.float32)
    for i, t in enumerate(texts):
        held[i, [words[w] for w in t.split()]] = 1
    both, n = held @ held.T, held.sum(axis=1)
    near = 100 * both >= 80 * (n[:, None] + n - both)
    component = np.arange(len(texts))
    while True:
        after = np.array([component[row].min() for row in near])
        if (after == component).all():
            return component.tolist()
        component = after


def test_fringe_of_a_large_group(spark):
    # Each fringe text is near one member only (92 of 112 words), and just not near the others (90 of 114).
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join([*base, f"a{i}", f"b{i}"]) for i in range(3000)]
    texts += [" ".join([*base[k : k + 90], f"a{m}", f"b{m}", *(f"x{k}y{j}" for j in range(10))]) for k, m in
              zip(range(10), range(5, 2900, 290))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in chosen_path.near_duplicates(df, width=1).collect()}
    assert [rows[i] for i in range(len(texts))] == by_products(texts)


def test_pairs_in_a_large_family_of_unlinked_texts(spark, monkeypatch):
    # All share 88 of 112 words, the pairs among them 90 of 110; large nodes at the last level at once.
    monkeypatch.setattr(chosen_path, "WIDE_NODE", 100)
    monkeypatch.setattr(chosen_path, "BLOCK", 64)
    monkeypatch.setattr(chosen_path, "DEPTH", 0)
    base = [f"w{k}" for k in range(88)]
    own = [[f"a{i}x{j}" for j in range(12)] for i in range(400)]
    for i in range(0, 60, 2):
        own[i + 1][:2] = own[i][:2]
    texts = [" ".join(base + words) for words in own]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in chosen_path.near_duplicates(df, width=1).collect()}
    assert [rows[i] for i in range(len(texts))] == by_products(texts)


def test_repeated_and_null_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "only null"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, map(tuple, chosen_path.op5(df).collect())))
    assert got == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, None, True), (None, 0, None, True)]))
    assert chosen_path.op5(df.limit(0)).count() == 0
    assert chosen_path.distinct_documents(df.limit(0)).count() == 0
    assert [r.doc_id for r in chosen_path.distinct_documents(df).collect()].count(1) == 1
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a b", "y"), (3, None, "z")], "doc_id long, text string, kept string")
    assert {r.doc_id for r in chosen_path.distinct_documents(docs).collect()} == {1, 3}
    assert chosen_path.distinct_documents(docs).columns == docs.columns


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(300, 299), (299, 298)]
    rng = random.Random(4)
    rng.shuffle(edges)
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.component for r in rows} == {
        **dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys((298, 299, 300), 298)
    }


def test_an_id_with_two_texts_loses_none(spark):
    rows = [(1, "text one of two words"), (5, "text one of two words"), (5, "nothing like it at all"), (7, "lone text"),
            (7, "lone text"), (9, "a b c d e f"), (9, "A b c d e f"), (None, "lone text")]
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, text_key string, key int")
    kept = chosen_path.distinct_documents(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [x for x in got if x[0] != 9] == [(1, rows[0][1]), (5, rows[2][1]), (7, "lone text"), (None, "lone text")]
    assert len([x for x in got if x[0] == 9]) == 1


def test_long_texts_in_a_wide_node_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 4)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(100)]
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 16)):
            words[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = chosen_path.near_duplicates(df, width=2).collect()
    assert set(map(tuple, rows)) == brute_force(list(enumerate(texts)), 2)


def rows_kept(monkeypatch):
    """What the components store from now on, in rows."""
    seen, stored = [], components_module.keep

    def counted(*args):
        kept = stored(*args)
        seen.append(kept.count())
        return kept

    monkeypatch.setattr(components_module, "keep", counted)
    return seen


def test_rounds_of_components_leave_out_what_has_settled(spark, monkeypatch):
    # The star settles at once; the chain, in mixed order, takes several rounds that do not send the star again.
    chain = list(range(5000, 5060))
    random.Random(6).shuffle(chain)
    edges = [(0, k) for k in range(1, 2001)] + list(zip(chain, chain[1:])) + [(9000, 9000)]
    seen = rows_kept(monkeypatch)
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.component for r in rows} == {
        **dict.fromkeys(range(2001), 0), **dict.fromkeys(chain, 5000), 9000: 9000
    }
    assert len(rows) == 2062
    assert sum(seen) < 5 * len(edges)


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_components_go_on_from_labels(spark, monkeypatch, few):
    monkeypatch.setattr(components_module, "FEW_LABELS", few)
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(999 - i, 998 - i) for i in range(30)]
    frames = [spark.createDataFrame(part, "u long, v long") for part in (edges[:90], edges[90:])]
    merged = components_module.merged(components_module.merged(None, frames[0]), frames[1])
    got = {r.id: r.component for r in merged.collect()}
    assert merged.count() == len(got)
    expected = {r.id: r.component for r in components(frames[0].unionByName(frames[1])).collect()}
    assert {k: got.get(k, k) for k in expected} == expected
    parent = {k: k for e in edges for k in e}
    for _ in parent:
        for u, v in edges:
            parent[u] = parent[v] = min(parent[u], parent[v])
    assert expected == parent


def test_later_links_of_a_large_group_do_not_send_all_links_again(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = []
    for _ in range(600):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    seen = rows_kept(monkeypatch)
    docs = list(enumerate(texts))
    rows = chosen_path.op5(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert set(map(tuple, rows)) == brute_force(docs, 2)
    assert sum(seen) < 8 * len(texts)
