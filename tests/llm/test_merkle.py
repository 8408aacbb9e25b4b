"""Manifests against a plain construction of every tree, level and proof."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from marketlens.llm import merkle


def hashed(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(leaves, arity):
    """Root and, per leaf, the steps (siblings left of it, siblings right of it) of a plain tree."""
    steps = [[] for _ in leaves]
    members, nodes = [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        runs = [range(k, min(k + arity, len(nodes))) for k in range(0, len(nodes), arity)]
        for run in runs:
            for place in run:
                left = [nodes[i] for i in run if i < place]
                right = [nodes[i] for i in run if i > place]
                for leaf in members[place]:
                    steps[leaf].append((left, right))
        members = [[leaf for i in run for leaf in members[i]] for run in runs]
        nodes = [hashed(*(nodes[i] for i in run)) for run in runs]
    return nodes[0], steps


def plain(rows, arity=2):
    """rows: doc_id, text, lang, source, n_chars."""
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf, altered = (hashed(*map(field, (doc_id, source, lang, n, text))) for n in (n_chars, None if n_chars is None else n_chars + 1))
        probed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        trees.setdefault((lang is not None, lang or ""), []).append((doc_id is not None, doc_id or 0, leaf, altered if probed else leaf, doc_id))
    names = sorted(trees)
    built = {}
    for name in names:
        trees[name].sort(key=lambda r: r[:3])
        built[name] = tree_of([r[2] for r in trees[name]], arity)
    root, above = tree_of([built[n][0] for n in names], arity)
    out = []
    for place, name in enumerate(names):
        subroot, steps = built[name]
        for (_, _, leaf, claimed, doc_id), mine in zip(trees[name], steps):
            path, node = mine + above[place], claimed
            for left, right in path:
                node = hashed(*left, node, *right)
            out.append((doc_id, leaf, subroot, root, hashed(*(s for left, right in path for s in left + right)), node, node == root))
    return sorted(out, key=str)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("size", [1, 2, 3, 7, 8, 33])
def test_every_shape_of_a_tree(spark, size):
    rows = [(i * 3, f"text é{i}", "en" if i % 3 else "de", f"src{i % 4}", i) for i in range(size)]
    assert collected(merkle.op13(spark.createDataFrame(rows, FIELDS))) == plain(rows)


def test_nulls_copies_ties_and_many_trees(spark):
    rows = [(None, None, None, None, None), (None, "x", None, "s", 1), (5, "", "", "s", 0), (5, "", "", "s", 0), (5, "other", "", "s", None),
            (14, None, "en", None, 3), (1, "a" * 300_000, "en", "s", 300_000), (2, "b", "=", "s", 1)]
    rows += [(100 + i, "t", f"lang{i}", "s", i) for i in range(9)]
    df = spark.createDataFrame(rows, FIELDS).withColumn("tree", F.lit(1)).withColumn("idx", F.lit(2)).withColumn("digest", F.lit("q"))
    assert collected(merkle.op13(df)) == plain(rows)
    assert merkle.op13(df.limit(0)).count() == 0


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_proofs_of_any_arity(spark, arity):
    leaves = {f"tree{t}": [hashed(str(t), str(i)) for i in range(n)] for t, n in enumerate((1, 4, 5, 26))}
    rows = [(t, i, bytes.fromhex(d)) for t, ds in leaves.items() for i, d in enumerate(ds)]
    proven = merkle.manifest(spark.createDataFrame(rows, "tree string, key long, digest binary"), arity).collect()
    assert len(proven) == 36
    subroots = {t: tree_of(ds, arity) for t, ds in leaves.items()}
    root, above = tree_of([subroots[t][0] for t in sorted(leaves)], arity)
    for r in proven:
        assert (r.subroot.hex(), r.root.hex()) == (subroots[r.tree][0], root)
        mine = subroots[r.tree][1][r.key] + above[sorted(leaves).index(r.tree)]
        assert [(s.slot, [x.hex() for x in s.siblings]) for s in r.steps] == [(len(left), left + right) for left, right in mine]


def test_whole_table_and_tampering(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = collected(merkle.op13(docs))
    assert got == plain(rows)
    assert all(r[-1] == (zlib.crc32(str(r[0]).encode()) % 7 != 0) for r in got)
    with pytest.raises(ValueError):
        merkle.built(docs, 1)
