"""Law, slots and linked documents of the shards."""

import functools
import itertools
import zlib
from collections import Counter, defaultdict

import pytest

from marketlens.llm import sharding

FOLDER = "/root/testdata/sf0.01"


def check(docs, rows, shards=40):
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [t[:2] for t in texts]
    facts = Counter((t[1], len(t[2].encode()) + 16, zlib.crc32(t[2].encode())) for t in texts)
    assert facts == Counter((r.doc_id or 0, r["size"], r.text_crc32) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "rows" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def pairs_together(rows):
    """Share of equal pairs that are in one shard."""
    groups = defaultdict(Counter)
    for r in rows:
        groups[r.text_crc32, r["size"]][r.shard] += 1
    pairs = sum(n * (n - 1) // 2 for g in groups.values() for n in [sum(g.values())])
    return sum(n * (n - 1) // 2 for g in groups.values() for n in g.values()) / max(1, pairs)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sharding.op3(docs).collect()
    check(docs, rows)
    assert pairs_together(rows) > 0.95


def test_a_group_larger_than_a_shard(spark):
    rows = [(i, "hot", i) for i in range(700)] + [(i, f"t{i // 2 if i < 1000 else i}", i) for i in range(700, 2000)]
    rows += [(2000, None, 0), (2001, "", 0), (2001, "", 0), (None, "x", 0), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket long").repartition(5)
    done = sharding.op3(docs).collect()
    check(docs, done)
    hot = Counter(r.shard for r in done if r.text_crc32 == zlib.crc32(b"hot"))
    assert sum(n * n for n in hot.values()) > 1.15 * 700 * 700 / 40  # more than dealing by hash gives


def most_pairs(sizes, quotas):
    """The most pairs of one group that can be in one shard, by trying all ways to fill the shards."""
    @functools.lru_cache(maxsize=None)
    def best(k, room):
        if k == len(sizes):
            return 0
        found = 0
        for split in itertools.product(*(range(min(r, sizes[k]) + 1) for r in room)):
            if sum(split) == sizes[k]:
                left = tuple(sorted(r - n for r, n in zip(room, split)))
                found = max(found, sum(n * (n - 1) // 2 for n in split) + best(k + 1, left))
        return found

    return best(0, tuple(quotas))


@pytest.mark.parametrize("sizes", [(4, 4, 2, 2), (3, 3, 3, 3), (6, 3, 2, 1), (5, 5, 2)])
def test_small_graphs_against_the_best_placement(spark, sizes):
    rows = [(100 * g + i, f"text {g}") for g, n in enumerate(sizes) for i in range(n)]
    done = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), shards=3).collect()
    groups = defaultdict(Counter)
    for r in done:
        groups[r.doc_id // 100][r.shard] += 1
    together = sum(n * (n - 1) // 2 for g in groups.values() for n in g.values())
    assert together >= 0.7 * most_pairs(sizes, (4, 4, 4))


def test_parts_of_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 50)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 4}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, sharding.op3(docs).collect())


def test_few_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    check(docs, sharding.op3(docs).collect())
    assert sharding.op3(docs.limit(0)).count() == 0


def test_flows_keep_every_shard_within_its_quota():
    wanted = {(0, 1): 5, (1, 2): 3, (2, 0): 9, (2, 1): 4, (3, 0): 2}
    free = {0: 1, 1: 0, 2: 0, 3: 0}
    allowed = sharding.flows(wanted, free)
    assert all(n <= wanted[k] for k, n in allowed.items())
    for s in free:
        came = sum(n for (_, j), n in allowed.items() if j == s)
        left = sum(n for (i, _), n in allowed.items() if i == s)
        assert came - left <= free[s]
    assert sum(allowed.values()) == 10  # three round the cycle of three shards, then one into the free place
    assert sharding.flows({}, free) == {}
