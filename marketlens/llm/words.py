"""64-bit hashes of the words of a text, computed in a few passes over its bytes.

A word's hash mixes two sums of random byte values times powers of two odd numbers, taken as differences
of running sums over the whole text, and its length; so there is no table of words in memory and no loop
over them. Texts are taken in blocks cut at white space, so a text of any length needs bounded memory
beside its own bytes; a single word longer than a block is hashed by itself.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

BLOCK = 1 << 16
WHITE = b" \t\n\x0b\x0c\r"  # fixed values: ASCII white space
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Tables:
    def __init__(self):
        rng = np.random.default_rng(42)
        self.blank = np.zeros(256, dtype=bool)
        self.blank[list(WHITE)] = True
        self.sums = []
        for _ in range(2):
            base = int(rng.integers(1, 1 << 62)) * 2 + 1
            powers = np.ones(BLOCK + 1, dtype=np.uint64)
            inverses = np.ones(BLOCK + 1, dtype=np.uint64)
            with np.errstate(over="ignore"):
                powers[1:] = np.multiply.accumulate(np.full(BLOCK, base, dtype=np.uint64))
                inverses[1:] = np.multiply.accumulate(np.full(BLOCK, pow(base, -1, 1 << 64), dtype=np.uint64))
            self.sums.append((rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), powers, inverses))


@functools.lru_cache(maxsize=1)
def _tables() -> _Tables:
    return _Tables()


def _block(data: bytes) -> np.ndarray:
    tables = _tables()
    codes = np.frombuffer(data, dtype=np.uint8)
    edge = np.empty(len(codes) + 1, dtype=bool)
    blank = tables.blank[codes]
    edge[1:-1] = blank[1:] != blank[:-1]
    edge[0], edge[-1] = not blank[0], not blank[-1]
    borders = np.flatnonzero(edge)
    starts, ends = borders[::2], borders[1::2]
    hashes = (ends - starts).astype(np.uint64)
    for values, powers, inverses in tables.sums:
        running = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(values[codes] * powers[: len(codes)], out=running[1:])
        hashes = mixed(hashes + (running[ends] - running[starts]) * inverses[starts])
    return hashes


def word_hashes(data: bytes) -> np.ndarray:
    """One hash per word (run of bytes that are no ASCII white space), in their order."""
    out, at = [np.empty(0, dtype=np.uint64)], 0
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        cut = stop if stop - at < BLOCK else max(data.rfind(bytes([w]), at, stop) for w in WHITE) + 1
        if cut > 0:
            out.append(_block(data[at:cut]))
            at = cut
            continue
        # A word begins here that fills a block or more: it is hashed in one way wherever it stands.
        ends = [p for w in WHITE if (p := data.find(bytes([w]), at)) >= 0]
        cut = min(ends, default=len(data))
        out.append(_long(data[at:cut]))
        at = cut
    return np.concatenate(out)


def _long(word: bytes) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), dtype="<u8").astype(np.uint64)
