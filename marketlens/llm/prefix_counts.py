"""Token counts of every prefix, by dynamic programming (operator 2).

The last token of a prefix is the only token that ends there and whose predecessor, the last token of
the shorter prefix, stays as it is beside it. So the count of each prefix follows from a shorter one,
and one pass over a text gives the exact count at every code point. A text's counts are stored as one
signed byte per code point, the difference to the prefix before; truncation and budget questions are
answered from them without encoding anything again.

Defined results: null text counts as empty, an empty text has no counts and 0 tokens, a text of any
length is processed whole, repeated rows and null ids pass through unchanged, an empty table gives no
rows. Only the columns named as parameters are read, so other columns may have any name.
"""

from __future__ import annotations

import array
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import (
    CONTRACTIONS, SPECIAL, Lookup, Vocabulary, chunk_lookup, is_blank, matches, over_chunks, vocabulary,
)
from .support import held, workers_find_package

VOCABULARY = "byte_bpe_50k.tiktoken"  # the ranks of byte_bpe_50k.json


class PrefixCounter:
    """Differences of prefix counts, by text."""

    def __init__(self, ranks: Vocabulary):
        self.ranks = ranks
        self.neighbours = Lookup(lambda pair: ranks.stay(pair >> 20, pair & 0xFFFFF), 400_000, texts=False)
        self.pieces = Lookup(self._piece, 300_000)
        self.chunks = chunk_lookup(self._ordinary)

    def _program(self, data: bytes) -> list[int]:
        """Tokens of every byte prefix of one piece."""
        stay, size = self.neighbours, self.ranks.size
        last, count = [-1] * (len(data) + 1), [0] * (len(data) + 1)
        for final, token in self.ranks.occurrences(data):
            end = final + 1
            if last[end] < 0:
                start = end - size[token]
                if start == 0 or stay[last[start] << 20 | token]:
                    last[end] = token
                    count[end] = count[start] + 1
        return count[1:]

    def _piece(self, piece: str) -> bytes:
        """Differences of the tokens of every code point prefix of one piece."""
        if piece in CONTRACTIONS and len(piece) > 2:  # its prefix "'r" is two pieces
            return self._differences([1, 2, self._program(piece.encode())[-1]])
        data = piece.encode()
        counts = self._program(data)
        if len(counts) != len(piece):
            # The last byte of a code point is one that no continuation byte follows.
            counts = [n for n, following in zip(counts, [*data[1:], 0]) if following & 0xC0 != 0x80]
        return self._differences(counts)

    def _counts(self, text: str) -> np.ndarray:
        """Tokens of every prefix of a text without special strings."""
        return counts_of(self._ordinary(text))

    @staticmethod
    def _differences(counts: list[int]) -> bytes:
        steps = list(map(operator.sub, counts, [0, *counts]))
        return array.array("b", steps).tobytes()  # OverflowError beyond a signed byte

    def _total(self, piece: str) -> int:
        return int(np.frombuffer(self.pieces[piece], dtype=np.int8).sum(dtype=np.int64))

    def _ordinary(self, text: str) -> bytes:
        out, previous, owed = [], "", 0
        for piece in matches(text):
            steps = self.pieces[piece]
            blank = previous.isspace() and piece[0].isspace() and is_blank(previous) and is_blank(piece[0])
            if blank or owed:
                values = np.frombuffer(steps, dtype=np.int8).tolist()
                # Until more text follows, a run of white space is one piece.
                less = values[0] - self._total(previous + piece[0]) + self._total(previous) if blank else 0
                values[0] += owed - less
                owed = less
                if len(values) > 1:
                    values[1] += owed
                    owed = 0
                steps = array.array("b", values).tobytes()
            out.append(steps)
            previous = piece
        return b"".join(out)

    def differences(self, text: str) -> bytes:
        if SPECIAL not in text:
            return over_chunks(text, self.chunks, self._ordinary)
        counts: list[int] = []
        base = 0
        parts = text.split(SPECIAL)
        for i, part in enumerate(parts):
            if i + 1 == len(parts):
                counts += [base + c for c in self._counts(part)]
            else:  # the special string is ordinary text until its last character
                open_end = self._counts(part + SPECIAL[:-1])
                ended = self._counts(part)[-1] if part else 0
                counts += [base + c for c in open_end] + [base + ended + 1]
                base += ended + 1
        return self._differences(counts)


def counter(name: str) -> PrefixCounter:
    return held(("prefix counts", name), lambda: PrefixCounter(vocabulary(name)))


def counts_of(stored: bytes) -> np.ndarray:
    """Token count of each prefix, shortest first, from its stored form."""
    return np.cumsum(np.frombuffer(stored, dtype=np.int8), dtype=np.int64)


def longest_within(stored: bytes, budget: int) -> int:
    """Code points of the longest prefix with at most `budget` tokens."""
    within = np.flatnonzero(counts_of(stored) <= budget)
    return int(within[-1]) + 1 if within.size else 0


def prefix_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 1024,
    vocabulary_name: str = VOCABULARY,
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, within_budget (code points that fit) and the stored counts."""
    workers_find_package(docs.sparkSession)

    def count(batches):
        program = counter(vocabulary_name)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            n_bytes, n_tokens, within, stored = [], [], [], []
            for text in texts:
                text = text or ""
                steps = program.differences(text)
                tokens = int(np.frombuffer(steps, dtype=np.int8).sum(dtype=np.int64))
                n_bytes.append(len(text) if text.isascii() else len(text.encode()))
                n_tokens.append(tokens)
                within.append(len(text) if tokens <= budget else longest_within(steps, budget))
                stored.append(steps)
            columns = [ids, *(pa.array(c, pa.int64()) for c in (n_bytes, n_tokens, within))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(stored, pa.binary())],
                names=["id", "n_bytes", "n_tokens", "within_budget", "prefix_steps"],
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", source.schema["id"].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("within_budget", T.LongType()),
        T.StructField("prefix_steps", T.BinaryType()),
    ])
    return source.mapInArrow(count, schema).withColumnRenamed("id", id_col)


def op2(docs: DataFrame) -> DataFrame:
    limit = 1024
    counted = prefix_counts(docs.select("doc_id", "text"), budget=limit)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        F.col("within_budget").alias("cut_chars"),
    )
