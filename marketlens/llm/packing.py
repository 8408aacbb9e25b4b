"""Packing token sequences into windows by non-negative least squares (operator 9).

Every document gives full windows and one remainder. The remainders' histogram has at most window - 1
lengths at any size of the corpus; shallow combinations of lengths that fill a window are enumerated,
and non-negative least squares chooses how often each is used. Rounded down, the chosen repeats place
remainders by their number within their length. What rounding leaves is packed greedily: laid end to
end and cut at the window's borders.

Only counts per (input partition, length) meet beyond the tasks that made them. Texts are encoded
once, in the tasks that read them; checksums of whole remainders come from there, and ids travel only
for the remainders that are cut.

Defined results: null text is an empty document, which still has its end id; an empty table gives no
rows; repeated rows and null ids are packed like any others. Only the columns named as parameters are
read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import SPECIAL, SPECIAL_ID, ranks_of
from .support import held, hint_if_small, keep, workers_find_package

VOCABULARY = "byte_bpe_50k.tiktoken"  # the ranks of byte_bpe_50k.json
WINDOW = 2048
END_ID = 1
ANCHORS = 16  # lengths tried as third member of a combination
STEPS = 200  # of the least-squares iteration


class Encoder:
    """Ids of whole texts as the tokenizers library gives them for the same vocabulary."""

    def __init__(self, name: str):
        import public_tokenizers

        self.encoding = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(name), special_tokens={}
        )

    def _ordinary(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        border = np.array([SPECIAL_ID], dtype="<u4").tobytes()
        parts = text.split(SPECIAL) if SPECIAL in text else [text]
        return border.join(map(self._ordinary, parts))


def encoder(name: str) -> Encoder:
    return held(("packing", name), lambda: Encoder(name))


def measured(docs: DataFrame, id_col: str, text_col: str, window: int, vocabulary_name: str) -> DataFrame:
    """Per row: its place (partition, row, number among equal remainders), length and checksums."""
    workers_find_package(docs.sparkSession)
    end = np.array([END_ID], dtype="<u4").tobytes()
    fields = [
        ("part", T.IntegerType(), pa.int32()), ("row", T.LongType(), pa.int64()),
        ("doc_tokens", T.LongType(), pa.int64()), ("tail", T.IntegerType(), pa.int32()),
        ("number", T.LongType(), pa.int64()), ("windows_before", T.LongType(), pa.int64()),
        ("window_crcs", T.ArrayType(T.LongType()), pa.list_(pa.int64())),
        ("tail_crc", T.LongType(), pa.int64()), ("tail_ids", T.BinaryType(), pa.binary()),
    ]

    def measure(batches):
        encode = encoder(vocabulary_name).encode
        part, row, windows, seen = TaskContext.get().partitionId(), 0, 0, [0] * window
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = encode(text or "") + end
                tokens = len(ids) // 4
                full, tail = divmod(tokens, window)
                cut = 4 * window * full
                crcs = [zlib.crc32(ids[i : i + 4 * window]) for i in range(0, cut, 4 * window)]
                rest = ids[cut:]
                rows.append((part, row, tokens, tail, seen[tail], windows, crcs, zlib.crc32(rest), rest))
                row, windows = row + 1, windows + full
                seen[tail] += 1
            columns = zip(*rows) if rows else [[] for _ in fields]
            arrays = [pa.array(list(c), kind) for c, (_, _, kind) in zip(columns, fields)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *(f[0] for f in fields)])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)])
    for name, kind, _ in fields:
        schema = schema.add(name, kind)
    return source.mapInArrow(measure, schema)


def combinations(lengths: list[int], window: int, anchors: int = ANCHORS) -> list[tuple[int, ...]]:
    """Shallow combinations of the given lengths that fill the window exactly.

    For each length: alone with its complement, repeated as often as it fits with one filler, and with
    each of some spread anchor lengths, once or twice, and the filler that then remains.
    """
    known = set(lengths)
    spread = [lengths[i * len(lengths) // anchors] for i in range(anchors)] if lengths else []
    found = set()

    def add(*members: int) -> None:
        rest = window - sum(members)
        whole = members + ((rest,) if rest else ())
        if rest >= 0 and all(m in known for m in whole):
            found.add(tuple(sorted(whole)))

    for length in lengths:
        for times in range(1, min(8, window // length) + 1):
            add(*(length,) * times)
        for anchor in spread:
            add(length, anchor)
            add(length, length, anchor)
            add(length, anchor, anchor)
            add(length, length, anchor, anchor)
    return sorted(found)


def repeats(histogram: dict[int, int], window: int, steps: int = STEPS) -> list[tuple[tuple[int, ...], int]]:
    """How often to use each combination: least squares against the histogram, rounded to what is there."""
    lengths = sorted(histogram)
    options = combinations(lengths, window)
    if not options:
        return []
    place = {length: i for i, length in enumerate(lengths)}
    column = np.concatenate([np.full(len(c), k) for k, c in enumerate(options)])
    line = np.array([place[m] for c in options for m in c])
    there = np.array([histogram[length] for length in lengths], dtype=float)
    # Misfits count by the tokens they leave: a line's weight is its length.
    weight = np.array(lengths, dtype=float)[line]

    def gathered(x):  # weighted A x
        return np.bincount(line, weights=weight * x[column], minlength=len(lengths))

    def spread_back(y):  # weighted A' y
        return np.bincount(column, weights=weight * y[line], minlength=len(options))

    wanted = spread_back(there * np.array(lengths))
    x = np.full(len(options), there.sum() / len(line))
    for _ in range(steps):  # multiplicative steps keep the solution non-negative
        x *= wanted / np.maximum(spread_back(gathered(x)), 1e-12)
    left = dict(histogram)
    chosen: dict[int, int] = {}
    for rounding in (np.floor, np.ceil):
        for k in np.argsort(-x, kind="stable"):
            need = {m: options[k].count(m) for m in set(options[k])}
            times = min(int(rounding(x[k])) - chosen.get(k, 0), *(left[m] // n for m, n in need.items()))
            if times > 0:
                chosen[k] = chosen.get(k, 0) + times
                for m, n in need.items():
                    left[m] -= times * n
    return [(options[k], n) for k, n in sorted(chosen.items())]


def _places(chosen: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, past last, first sequence, members per sequence, offset) for each use."""
    used: dict[int, int] = {}
    places, sequence = [], 0
    for members, times in chosen:
        offset = 0
        for length in sorted(set(members)):
            n = members.count(length)
            start = used.get(length, 0)
            places.append((length, start, start + n * times, sequence, n, offset))
            used[length] = start + n * times
            offset += n * length
        sequence += times
    return places


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    vocabulary_name: str = VOCABULARY,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    rows = keep(measured(docs, id_col, text_col, window, vocabulary_name), "pack")
    meta = rows.drop("tail_ids")
    tails = meta.where("tail > 0")

    per_part = tails.groupBy("part", "tail").count()
    histogram = {r.tail: r.n for r in per_part.groupBy("tail").agg(F.sum("count").alias("n")).collect()}
    chosen = repeats(histogram, window)
    placed_sequences = sum(n for _, n in chosen)
    ahead = W.partitionBy("tail").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = per_part.select("part", "tail", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    numbered = tails.join(before, ["part", "tail"]).withColumn("number", F.col("number") + F.col("before"))

    # At most `window` lengths times the enumerated combinations, whatever the corpus.
    places = spark.createDataFrame(
        _places(chosen) or [(0, 0, 0, 0, 1, 0)],
        "length int, first long, past long, sequence long, members int, place int",
    )
    located = numbered.join(
        F.broadcast(places),
        (F.col("tail") == F.col("length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("past")),
        "left",
    )
    located = keep(located.select("id", "part", "row", "doc_tokens", "tail", "tail_crc", "number", "first",
                                  "sequence", "members", "place"), "located")
    start = (F.col("doc_tokens") - F.col("tail")).alias("start")
    length = F.col("tail").cast("long").alias("length")
    within = F.col("number") - F.col("first")
    combined = located.where("sequence is not null").select(
        "id", start, length, F.col("tail_crc").alias("ids_crc32"), "doc_tokens",
        (F.col("sequence") + F.floor(within / F.col("members"))).alias("sequence_id"),
        (F.col("place") + (within % F.col("members")) * F.col("tail")).alias("offset"),
    )

    # What is left lies end to end; the position of a partition follows from the sums before it.
    left = located.where("sequence is null")
    sums = left.groupBy("part").agg(F.sum("tail").alias("total"))
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per input partition
    bases = sums.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    in_part = W.partitionBy("part").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    laid = (
        left.select("*", F.coalesce(F.sum("tail").over(in_part), F.lit(0)).alias("at"))
        .join(bases, "part")
        .withColumn("at", F.col("at") + F.col("base"))
        .withColumn("cut", window - F.col("at") % window)
    )
    laid = keep(laid.select("id", "part", "row", "doc_tokens", "tail", "tail_crc", "at", "cut"), "laid")
    first_sequence = F.lit(placed_sequences) + F.floor(F.col("at") / window)
    uncut = laid.where("tail <= cut").select(
        "id", start, length, F.col("tail_crc").alias("ids_crc32"), "doc_tokens",
        first_sequence.alias("sequence_id"), (F.col("at") % window).alias("offset"),
    )
    crossing = laid.where("tail > cut").drop("tail_crc")
    ids = rows.select("part", "row", "tail_ids")
    bytes_before = (4 * F.col("cut")).cast("int")
    cut = (
        ids.join(hint_if_small(crossing), ["part", "row"])
        .select("id", "doc_tokens", start, "at", F.inline(F.array(
            F.struct(F.lit(0).cast("long").alias("skip"), F.expr("substring(tail_ids, 1, cast(4 * cut as int))").alias("ids")),
            F.struct(F.col("cut").alias("skip"), F.col("tail_ids").substr(bytes_before + 1, F.lit(4 * window)).alias("ids")),
        )))
        .select(
            "id", (F.col("start") + F.col("skip")).alias("start"),
            F.floor(F.octet_length("ids") / 4).alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens",
            (F.lit(placed_sequences) + F.floor((F.col("at") + F.col("skip")) / window)).alias("sequence_id"),
            ((F.col("at") + F.col("skip")) % window).alias("offset"),
        )
    )

    left_tokens = laid.agg(F.coalesce(F.sum("tail"), F.lit(0))).first()[0]
    first_full = placed_sequences + -(-left_tokens // window)
    windows = meta.groupBy("part").agg(F.sum(F.size("window_crcs")).alias("total"))
    bases = windows.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    full = (
        meta.where(F.size("window_crcs") > 0)
        .join(bases, "part")
        .select("id", "doc_tokens", "windows_before", "base", F.posexplode("window_crcs").alias("i", "ids_crc32"))
        .select(
            "id", (F.col("i") * F.lit(window).cast("long")).alias("start"), F.lit(window).cast("long").alias("length"),
            "ids_crc32", "doc_tokens",
            (F.lit(first_full) + F.col("base") + F.col("windows_before") + F.col("i")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    kinds = {"sequence_id": "long", "offset": "long", "length": "long", "start": "long"}
    pieces = full.unionByName(combined).unionByName(uncut).unionByName(cut)
    return pieces.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()}).withColumnRenamed("id", id_col)


def op9(docs: DataFrame) -> DataFrame:
    return pack(docs.select("doc_id", "text"))
