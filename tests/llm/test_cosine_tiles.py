"""Links between vectors against all pairs."""

import numpy as np
import pytest

from marketlens.llm import cosine_tiles

FOLDER = "/root/testdata/sf0.1"


def brute_force(vectors, threshold=0.9):
    """(id, links, component) of every vector."""
    usable = [(k, u) for k, v in vectors if (u := cosine_tiles.unit(v)) is not None]
    label = {k: k for k, _ in vectors}
    links = dict.fromkeys(label, 0)
    dims = max((len(u) for _, u in usable), default=0)
    x = np.stack([np.pad(u, (0, dims - len(u))) for _, u in usable])
    near = x @ x.T >= threshold

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, j in zip(*np.nonzero(near)):
        if i != j:
            links[usable[i][0]] += 1
            a, b = sorted((root(usable[i][0]), root(usable[j][0])))
            label[b] = a
    return {(k, links[k], root(k), root(k) == k) for k in label}


def test_whole_table(spark, monkeypatch):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    expected = brute_force([(r.vec_id, r.embedding) for r in vectors.collect()])
    assert set(map(tuple, cosine_tiles.op8(vectors).collect())) == expected
    monkeypatch.setattr(cosine_tiles, "TILE", 300)  # many tiles give the same links
    assert set(map(tuple, cosine_tiles.op8(vectors).collect())) == expected


def test_edge_rows(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(size=12)
    vectors = [(k, (hot + 0.15 * rng.normal(size=12)).tolist()) for k in range(300)]
    vectors += [(300 + k, hot.tolist()) for k in range(40)]
    vectors += [(400, None), (401, []), (402, [0.0] * 12), (403, [1.0, None]), (404, [float("nan")] * 12),
                (405, [float("inf"), 1.0]), (406, [1.0, 0.0]), (407, [2.0]), (408, [1e300, 1e300]), (409, [1e-300, 1e-300])]
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in vectors], "vec_id long, embedding array<double>, c int, key string")
    assert set(map(tuple, cosine_tiles.op8(df).collect())) == brute_force(vectors)
    assert cosine_tiles.op8(df.limit(0)).count() == 0
    twice = df.where("vec_id in (406, 402)").unionByName(df.where("vec_id in (406, 402)"))
    got = sorted(map(tuple, cosine_tiles.op8(twice).collect()))
    assert got == [(402, 0, 402, True)] * 2 + [(406, 1, 406, True)] * 2
    null = spark.createDataFrame([(None, [1.0]), (5, [1.0])], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in cosine_tiles.op8(null).collect()} == {(None, 1, 5, False), (5, 1, 5, True)}


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_blocks_give_up_no_link(threshold):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 70)) * np.linspace(3, 0.1, 70) + 0.6
    x /= np.linalg.norm(x, axis=1)[:, None]
    ones = np.ones(500, dtype=np.int64)
    found = cosine_tiles.Compared(x, x, ones, ones, True, threshold)
    found.run()
    assert (found.links[0] + found.links[1] == (x @ x.T >= threshold).sum(axis=1) - 1).all()
