"""Byte-level BPE as a monoid: encoding and decoding by tree reduction (operator 10).

A piece is encoded by halves, cut near the middle where a token seldom lies across. Two encoded halves
are joined by encoding a window around their border again, growing it until the token at each end of the
window is the one that stood there before: a token sequence is an encoding exactly if every pair of
neighbours is one, and beyond such an end all pairs are those of the halves. Pieces and chunks never
share a token, so their encodings join by concatenation, which also decodes.

Defined results: null text counts as empty; an empty text has no ids; texts of any length are processed
whole; repeated rows and null ids pass through; an empty table gives no rows. Only the columns named as
parameters are read.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import Lookup, Vocabulary, chunk_lookup, matches, over_chunks, vocabulary
from .support import held, workers_find_package

VOCABULARY = "byte_bpe_50k.tiktoken"
Ids = tuple[int, ...]


class TreeEncoder:
    SHORT = 6  # bytes of a part that is remembered
    REACH = 2  # bytes from the middle of a piece to where it may be halved

    def __init__(self, ranks: Vocabulary):
        self.ranks = ranks
        self.windows = Lookup(self._window, 250_000, texts=False)
        self.parts = Lookup(self._joined_halves, 250_000)
        self.pieces = Lookup(self._piece, 300_000)
        self.chunks = chunk_lookup(self.encode_pieces)

    def _window(self, ids: Ids) -> Ids:
        if len(ids) == 2 and self.ranks.stay(*ids):
            return ids
        return self.ranks.merge(b"".join(map(self.ranks.token.__getitem__, ids)))

    def halves(self, data: bytes) -> Ids:
        """Ids of one piece."""
        whole = self.ranks.rank.get(data)
        if whole is not None:
            return (whole,)
        # Few short parts make up most pieces.
        return self.parts[data] if len(data) <= self.SHORT else self._joined_halves(data)

    def _joined_halves(self, data: bytes) -> Ids:
        cut = self._cut(data)
        return self.join(self.halves(data[:cut]), self.halves(data[cut:]))

    def _cut(self, data: bytes) -> int:
        """Where to halve: of the places around the middle, the one whose two bytes would merge last, as a
        token is least likely to lie across it."""
        middle, last = len(data) // 2, -1
        for at in range(max(1, middle - self.REACH), min(len(data), middle + self.REACH + 1)):
            rank = self.ranks.rank.get(data[at - 1 : at + 1], self.ranks.none)
            if rank > last:
                cut, last = at, rank
        return cut

    def join(self, left: Ids, right: Ids) -> Ids:
        """The monoid's product: ids of two byte strings put together, from the ids of each."""
        window = self.windows[left[-1], right[0]]
        if window[0] == left[-1] and window[-1] == right[0]:
            return left + right if len(window) == 2 else left[:-1] + window + right[1:]
        a = b = 1
        while True:
            window = self.windows[left[len(left) - a :] + right[:b]]
            left_holds = a == len(left) or window[0] == left[-a]
            right_holds = b == len(right) or window[-1] == right[b - 1]
            if left_holds and right_holds:
                return left[: len(left) - a] + window + right[b:]
            if not left_holds:
                a = min(2 * a, len(left))
            if not right_holds:
                b = min(2 * b, len(right))

    def _piece(self, piece: str) -> bytes:
        ids = self.halves(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, matches(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return over_chunks(text, self.chunks, self.encode_pieces) if text else b""

    def decode(self, ids: bytes) -> bytes:
        """Bytes of a sequence of ids: those of its parts, concatenated."""
        return b"".join(map(self.ranks.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encoder(name: str) -> TreeEncoder:
    return held(("tree", name), lambda: TreeEncoder(vocabulary(name)))


def _mapped(df: DataFrame, in_col: str, in_type: str, out: list[tuple[str, T.DataType]], work, id_col: str):
    """Apply `work` to the values of one column, beside the id."""
    workers_find_package(df.sparkSession)
    source = df.select(F.col(id_col).alias("id"), F.col(in_col).cast(in_type).alias("value"))
    arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    kinds = [arrow[kind] for _, kind in out]
    names = ["id", *(name for name, _ in out)]

    def run(batches):
        for batch in batches:
            columns = work(batch.column(1).to_pylist())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    fields = [T.StructField("id", source.schema["id"].dataType)]
    schema = T.StructType(fields + [T.StructField(name, kind) for name, kind in out])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, id_col="doc_id", text_col="text", vocabulary_name=VOCABULARY) -> DataFrame:
    """Per row: id, n_tokens, ids (binary, little-endian unsigned 32-bit)."""

    def work(texts):
        tree = encoder(vocabulary_name)
        ids = [tree.encode(t or "") for t in texts]
        return [len(x) // 4 for x in ids], ids

    return _mapped(docs, text_col, "string", [("n_tokens", T.LongType()), ("ids", T.BinaryType())], work, id_col)


def decode(encoded: DataFrame, id_col="doc_id", ids_col="ids", vocabulary_name=VOCABULARY) -> DataFrame:
    """Per row: id, decoded (binary)."""

    def work(ids):
        tree = encoder(vocabulary_name)
        return ([tree.decode(x or b"") for x in ids],)

    return _mapped(encoded, ids_col, "binary", [("decoded", T.BinaryType())], work, id_col)


def round_trip(docs: DataFrame, id_col="doc_id", text_col="text", vocabulary_name=VOCABULARY) -> DataFrame:
    """Per row: id, n_tokens and the digests of the ids and of what they decode to, in one pass."""

    def work(texts):
        tree = encoder(vocabulary_name)
        counts, ids_digests, text_digests = [], [], []
        for text in texts:
            ids = tree.encode(text or "")
            counts.append(len(ids) // 4)
            ids_digests.append(hashlib.sha256(ids).hexdigest())
            text_digests.append(hashlib.sha256(tree.decode(ids)).hexdigest())
        return counts, ids_digests, text_digests

    out = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return _mapped(docs, text_col, "string", out, work, id_col)


def op10(docs: DataFrame) -> DataFrame:
    return round_trip(docs.select("doc_id", "text"))
