"""Cutting texts into the pieces a byte-level BPE encodes separately, and the vocabulary itself.

A single space between two non-space characters always starts a new piece, and nothing before or
after it changes that. Text between such spaces (a chunk) is therefore encoded once and looked up
afterwards; only texts with other white space around a space take the slower path over all matches.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import sys

import ahocorasick
import public_tokenizers
import regex

# Letters, digits and white space below U+0250, and the contractions of the pattern.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGITS = "0-9²³¹¼½¾"
SPACES = "\\t-\\r \x85\xa0"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256

_EXACT = regex.compile(public_tokenizers.PATTERN)
_PLAIN = re.compile("[\0-ɏ]*")
_FAST = re.compile(
    "|".join(CONTRACTIONS)
    + f"| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+"
    + f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
_BLANK = regex.compile(r"\s+")


def matches(text: str) -> list[str]:
    """The pieces of a text. The standard library's faster engine takes texts of known characters."""
    return (_FAST if _PLAIN.fullmatch(text) else _EXACT).findall(text)


def is_blank(piece: str) -> bool:
    return _BLANK.fullmatch(piece) is not None


class Irregular(Exception):
    """A chunk whose white space may join its neighbour's."""


class Lookup(dict):
    """Results by key, computed on first use, in two generations of half of `limit` entries each.

    When the young generation is full it becomes the old one, and what is not asked for again until it is
    full once more is forgotten: frequent keys stay, whatever the vocabulary grows to. Longer texts than
    LONGEST are computed each time, so an entry takes some 200 bytes and never more than about 1 KB.
    """

    LONGEST = 64

    def __init__(self, make, limit: int, texts: bool = True):
        super().__init__()
        self.make, self.half, self.texts = make, limit // 2, texts
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if self.texts and len(key) > self.LONGEST:
                return value
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def chunk_lookup(make, limit: int = 400_000) -> Lookup:
    """Results of `make` for a chunk with its leading space."""

    def of_chunk(chunk: str):
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Irregular
        return make(" " + chunk)

    return Lookup(of_chunk, limit)


def over_chunks(text: str, chunks: Lookup, make) -> bytes:
    """Concatenated results of a whole text."""
    try:
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            raise Irregular
        return make(first) + b"".join(map(chunks.__getitem__, rest))
    except Irregular:
        return make(text)


def ranks_of(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Vocabulary:
    """Token ranks, and the merges they stand for."""

    SHORT = 32

    def __init__(self, name: str):
        self.rank = ranks_of(name)
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.size = [len(token) for token in self.token]
        self.none = len(self.token)  # above all ranks

    @functools.cached_property
    def _automaton(self):
        automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            automaton.add_word(token.decode("latin-1"), rank)
        automaton.make_automaton()
        return automaton

    def occurrences(self, data: bytes):
        """(last position, token) of every token found in the bytes, by position."""
        return self._automaton.iter(data.decode("latin-1"))

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Tokens of a piece by repeatedly merging the neighbours of lowest rank, leftmost first."""
        whole = self.rank.get(data)
        if whole is not None:
            return (whole,)
        return self._merge_short(data) if len(data) <= self.SHORT else self._merge_long(data)

    def _merged(self, data: bytes, below: int) -> list[bytes]:
        """The parts of a short piece once all merges of a rank lower than `below` are done."""
        get = self.rank.get
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [get(data[i : i + 2], below) for i in range(len(data) - 1)]
        while ranks:
            best = min(ranks)
            if best >= below:
                break
            at = ranks.index(best)
            part = parts[at] + parts[at + 1]
            parts[at : at + 2] = [part]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(part + parts[at + 1], below)
            if at:
                ranks[at - 1] = get(parts[at - 1] + part, below)
        return parts

    def _merge_short(self, data: bytes) -> tuple[int, ...]:
        return tuple(map(self.rank.__getitem__, self._merged(data, len(self.token))))

    @functools.cached_property
    def _split(self) -> dict[int, tuple[int, int]]:
        """Filled as tokens are met: the two tokens that the last merge of a token joins."""
        return {}

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """From the byte at the left (0) or right (1) end of a token up to the token itself: what stands at
        that end in the course of its merges, and the rank of the merge that ends its standing there."""
        out, ends = [], len(self.token)
        while True:
            out.append((self.token[token], ends))
            if self.size[token] == 1:
                return out[::-1]
            halves = self._split.get(token)
            if halves is None:
                left, right = self._merged(self.token[token], token)
                halves = self._split[token] = self.rank[left], self.rank[right]
            token, ends = halves[side], token

    def stay(self, left: int, right: int) -> bool:
        """Whether two tokens beside each other are the encoding of their bytes.

        They are unless some merge joins bytes of both: it would have to come before the next merge within
        the left token and not after the next one within the right token, as equal ranks go from left to
        right. Merges of a token come in the order of their ranks (a token's parts have lower ranks).
        """
        ends, begins, none = self._spines(left)[1], self._spines(right)[0], len(self.token)
        i = j = 0
        while True:
            (x, next_x), (y, next_y) = ends[i], begins[j]
            across = self.rank.get(x + y, none)
            if across < next_x and across <= next_y:
                return False
            if next_x <= next_y:
                if next_x == none:
                    return True
                i += 1
            else:
                j += 1

    def _spines(self, token: int) -> tuple[list, list]:
        found = self._all_spines.get(token)
        if found is None:
            found = self._all_spines[token] = self._spine(token, 0), self._spine(token, 1)
        return found

    @functools.cached_property
    def _all_spines(self) -> dict[int, tuple[list, list]]:
        """Filled as tokens are met, so at most one entry per token."""
        return {}

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        rank, n = self.rank, len(data)
        following, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = following[i]
            if j < n and (r := rank.get(data[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        while heap:
            _, i, stop = heapq.heappop(heap)
            j = following[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i], following[i] = False, end[j], following[j]
            if following[i] < n:
                before[following[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return tuple(rank[data[i : end[i]]] for i in range(n) if alive[i])


@functools.lru_cache(maxsize=1)
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(name)
