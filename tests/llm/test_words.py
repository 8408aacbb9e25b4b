"""Word hashes against a plain split."""

import random

import numpy as np

from marketlens.llm import words


def test_hash_depends_on_the_word_alone():
    rng = random.Random(1)
    known, parts = {}, [b"a", b"b", b"ab", b"\xc3\xa9", b"\xff", b"\x00", b" ", b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r", b"\xc2\xa0"]
    for _ in range(3000):
        text = b"".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        hashes = words.word_hashes(text)
        split = text.split()
        assert len(hashes) == len(split)
        for word, h in zip(split, hashes.tolist()):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


def test_anagrams_and_many_words_differ():
    rng = random.Random(2)
    every = {"".join(rng.sample("abcdefgh", 8)) for _ in range(20_000)} | {str(k) for k in range(300_000)}
    hashes = words.word_hashes(" ".join(every).encode())
    assert len(np.unique(hashes)) == len(every)
    low = np.unique(hashes & np.uint64(0xFFFF)).size
    assert low > 0.95 * 65536  # low bits are spread as well


def test_blocks_and_words_longer_than_a_block(monkeypatch):
    whole = {w: h for w, h in zip((b"x" * n for n in range(1, 40)), (int(words.word_hashes(b"x" * n)[0]) for n in range(1, 40)))}
    monkeypatch.setattr(words, "BLOCK", 16)
    rng = random.Random(3)
    seen = {}
    for _ in range(2000):
        parts = [b"x" * rng.randrange(1, 40) for _ in range(rng.randrange(1, 12))]
        text = rng.choice([b"", b" ", b"  \n"]) + b" ".join(parts) + rng.choice([b"", b" "])
        hashes = words.word_hashes(text).tolist()
        assert len(hashes) == len(parts)
        for word, h in zip(parts, hashes):
            assert seen.setdefault(word, h) == h
            if len(word) < 16:
                assert h == whole[word]
    assert len(set(seen.values())) == len(seen)
    assert words.word_hashes(b"").size == 0 and words.word_hashes(b" \n ").size == 0
