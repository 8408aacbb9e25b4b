"""Token operators against the tokenizer libraries and by round trip."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from marketlens.llm import packing, prefix_counts, pretokens, tree_bpe

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, id string, tail int"
EDGE = [
    (1, None, "x", 0), (2, "", "x", 0), (3, "  \n a  b", "x", 0), (3, "  \n a  b", "x", 0), (None, "it's we've 'r", "x", 1),
    (5, "a<|endoftext|> b!<|endof", "x", 1), (6, "é²½ 中文٣\xa0\x85 \x1c.", "x", 2), (7, "word " * 9000, "x", 2), (8, "a" * 30000, "x", 2),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ordinary():
    ranks = pretokens.vocabulary(prefix_counts.VOCABULARY).rank
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, seed=3):
    rng, letters = random.Random(seed), " \n\t'sretvmld<|endoftext|>ABé²½中文٣ \xa0\x85\x1c aaa   !?."
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_the_two_patterns_agree_below_u0250():
    every = "".join(map(chr, range(0x250)))
    exact = regex.compile(public_tokenizers.PATTERN)
    for text in [every, *random_texts(500), *(f"a{c} {c}{c}b{c}" for c in every)]:
        assert pretokens.matches(text) == exact.findall(text)


def test_every_prefix_counts_as_the_library_says(library):
    program = prefix_counts.counter(prefix_counts.VOCABULARY)
    for text in [*random_texts(300), "x'r<|endoftext|> y", "<|endoftext|>", "we've   \n\n don't"]:
        counts = prefix_counts.counts_of(program.differences(text))
        assert list(counts) == [
            len(library.encode(text[: i + 1], add_special_tokens=False).ids) for i in range(len(text))
        ]


def test_budget_is_answered_from_the_stored_counts():
    program = prefix_counts.counter(prefix_counts.VOCABULARY)
    stored = program.differences("one two three four")
    assert prefix_counts.longest_within(stored, 2) == len("one two")
    assert prefix_counts.longest_within(stored, 99) == len("one two three four")
    assert prefix_counts.longest_within(b"", 0) == 0


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "ab" * 4000, "é" * 3000, "th" * 999 + "e" * 777])
def test_one_long_piece(ordinary, text):
    ids = ordinary.encode_ordinary(text)
    assert list(np.frombuffer(tree_bpe.encoder(tree_bpe.VOCABULARY).encode(text), "<u4")) == ids
    stored = prefix_counts.counter(prefix_counts.VOCABULARY).differences(text)
    assert prefix_counts.counts_of(stored)[-1] == len(ids)


def whole_table(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_op2(spark, library):
    for docs in (whole_table(spark), spark.createDataFrame(EDGE, SCHEMA)):
        rows = prefix_counts.op2(docs).collect()
        texts = [r.text or "" for r in docs.collect()]
        tokens = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
        assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == sorted(
            (len(t.encode()), n, n > 1024) for t, n in zip(texts, tokens)
        )
    assert prefix_counts.op2(whole_table(spark).limit(0)).count() == 0


def test_op10(spark, ordinary):
    for docs in (whole_table(spark), spark.createDataFrame(EDGE, SCHEMA)):
        rows = tree_bpe.op10(docs).collect()
        expected = []
        for text in (r.text or "" for r in docs.collect()):
            ids = np.array(ordinary.encode_ordinary(text), dtype="<u4").tobytes()
            expected.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(expected)
    encoded = tree_bpe.encode(whole_table(spark))
    decoded = {r.doc_id: bytes(r.decoded).decode() for r in tree_bpe.decode(encoded).collect()}
    assert decoded == {r.doc_id: r.text for r in whole_table(spark).collect()}


def check_packing(pieces, documents, window=2048):
    """documents: the ids of each, in any order. Pieces of equal documents can't be told apart."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for key, own in by_doc.items():
        candidates = [ids for k, ids in documents if k == key]
        ids, copies = candidates[0], len(candidates)
        starts = sorted((p.start, p.length) for p in own)
        assert sum(n for _, n in starts) == copies * len(ids)
        for p in own:
            part = ids[p.start : p.start + p.length]
            assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids)
        if copies == 1:
            assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1]]
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert sum(p.length for p in own) <= window
    lengths = [sum(p.length for p in own) for own in by_sequence.values()]
    assert sum(n < window for n in lengths) <= 1  # only the last one may be short
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_op9(spark, library):
    for docs in (whole_table(spark), spark.createDataFrame(EDGE, SCHEMA).repartition(3)):
        documents = [
            (r.doc_id, np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], dtype="<u4"))
            for r in docs.collect()
        ]
        check_packing(packing.op9(docs).collect(), documents)
    assert packing.op9(whole_table(spark).limit(0)).count() == 0


def test_least_squares_places_most_remainders():
    histogram = {512: 400, 1024: 100, 700: 90, 1348: 80, 100: 50, 3: 2}
    chosen = packing.repeats(histogram, 2048)
    used = {}
    for members, times in chosen:
        assert sum(members) == 2048
        for m in members:
            used[m] = used.get(m, 0) + times
    assert all(used[m] <= histogram[m] for m in used)
    assert used[512] >= 390 and used[700] >= 80


def test_halves_seldom_share_a_token(spark, ordinary):
    tree = tree_bpe.TreeEncoder(pretokens.vocabulary(tree_bpe.VOCABULARY))
    compute, sizes = tree.windows.make, []

    def counted(ids):
        sizes.append(len(ids))
        return compute(ids)

    tree.windows.make = counted
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    for text in texts:
        assert np.frombuffer(tree.encode(text), "<u4").tolist() == ordinary.encode_ordinary(text)
    assert sum(size > 2 for size in sizes) < len(tree.pieces) / 2
