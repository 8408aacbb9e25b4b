"""Global and per-group ranks that never put an unbounded group into one task.

A window without PARTITION BY, or one over a hot key, sorts everything in a single task. Here the
rows are range partitioned on a unique order instead, written to the shared folder with their seat
(range number and position in it), and shifted by the row counts of the ranges before. The only
single-task step runs over one row per range.

Every `order` must be unique over the rows; add a key as the last tie-break.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash

ROWS_PER_RANGE = 2_000_000

# monotonically_increasing_id() keeps the partition above bit 33 and the position below it.
_SEAT_BITS = 33


def _ranges(rows: int, rows_per_range: int) -> int:
    return max(1, -(-rows // rows_per_range))


def _seated(df: DataFrame, order: list[Column], ranges: int) -> DataFrame:
    placed = stash(
        df.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("_seat", F.monotonically_increasing_id()),
        "ranges",
    )
    return placed.withColumn("_range", F.shiftright("_seat", _SEAT_BITS))


def _amount_before(seated: DataFrame, amount: Column) -> DataFrame:
    """One row per range: the total amount of all ranges in front of it."""
    ahead = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = seated.groupBy("_range").agg(amount.alias("_amount"))
    return totals.select("_range", F.coalesce(F.sum("_amount").over(ahead), F.lit(0)).alias("_before"))


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str,
    rows: int | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) with one range shuffle.

    The rows are read more than once, so `df` is stored first; give `rows`, the exact number of
    rows, for a frame that is cheap to read again.
    """
    if rows is None:
        df = stash(df)
        rows = df.count()
    seated = _seated(df, order, _ranges(rows, rows_per_range or ROWS_PER_RANGE))
    before = _amount_before(seated, F.count(F.lit(1)))
    seat = F.col("_seat").bitwiseAND(F.lit((1 << _SEAT_BITS) - 1))
    # `before` has one row per range, that is rows / ROWS_PER_RANGE rows.
    return seated.join(F.broadcast(before), "_range").select(
        *df.columns, (F.col("_before") + seat + 1).alias(name)
    )


def bucket_of(row: Column, rows: int, buckets: int) -> Column:
    """NTILE bucket of a 1-based row number: the first rows % buckets buckets hold one row more."""
    size, larger = divmod(rows, buckets)
    edge = larger * (size + 1)
    in_larger = F.ceil(row / F.lit(float(size + 1)))
    in_rest = F.lit(larger) + F.ceil((row - edge) / F.lit(float(max(size, 1))))
    return F.when(row <= edge, in_larger).otherwise(in_rest).cast("long")


def ntiles(
    df: DataFrame,
    scores: list[tuple[str, list[Column], int]],
    rows: int | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Add NTILE(k) OVER (ORDER BY order) for each (name, order, k). `rows` as in number_rows."""
    if rows is None:
        df = stash(df)
        rows = df.count()
    for name, order, buckets in scores:
        numbered = number_rows(df, order, "_row", rows, rows_per_range)
        df = numbered.withColumn(name, bucket_of(F.col("_row"), rows, buckets)).drop("_row")
    return df


def _cut_levels(df: DataFrame, scores: list[tuple[str, Column, int]], rows: int) -> dict[str, list]:
    """Per score (value, ahead, ties) of the levels that hold the first row of a bucket but the first one:
    fewer levels than buckets, so the driver may see them."""
    values = F.array(*[F.struct(F.lit(name).alias("score"), value.alias("value")) for name, value, _ in scores])
    levels = counts_ahead_in_segments(
        df.select(F.inline(values)).withColumn("rows", F.lit(1)), ["score"], "value", "rows"
    )
    holds = F.lit(False)
    for name, _, buckets in scores:
        before = F.greatest(bucket_of(F.col("ahead"), rows, buckets), F.lit(1))
        last = bucket_of(F.col("ahead") + F.col("ties"), rows, buckets)
        holds = holds | ((F.col("score") == name) & (last > before))
    found = sorted(levels.where(holds).collect(), key=lambda r: r.value)
    return {name: [(r.value, r.ahead, r.ties) for r in found if r.score == name] for name, *_ in scores}


def ntiles_by_levels(df: DataFrame, scores: list[tuple[str, str, bool, int]], key: str) -> DataFrame:
    """Add NTILE(k) OVER (ORDER BY value, key) for each (name, value, whether descending, k); NULLs last.

    One histogram of the values of all scores says in which values buckets begin. All rows with another
    value get their bucket by comparison alone; only those with such a value are numbered, by `key`, in a
    segmented scan, so rows tied in any number do not meet in one task. Values are numbers; `key` is unique.
    Pass a stored frame: it is read several times.
    """
    columns, rows = df.columns, df.count()
    infinite = F.lit(float("inf"))
    ordered = {
        name: F.coalesce((-F.col(value) if descending else F.col(value)).cast("double"), infinite)
        for name, value, descending, _ in scores
    }
    cuts = _cut_levels(df, [(name, ordered[name], buckets) for name, _, _, buckets in scores], rows)
    for name, _, _, buckets in scores:
        marked = df.withColumn("_value", ordered[name])
        if not cuts[name]:
            df = marked.withColumn(name, F.lit(1).cast("long")).drop("_value")
            continue
        # The bucket of a value between two such levels is that of the last row of the level before it.
        after = F.lit([1, *(_bucket(a + t, rows, buckets) for _, a, t in cuts[name])])
        split = [(v, a) for v, a, t in cuts[name] if _bucket(a + 1, rows, buckets) != _bucket(a + t, rows, buckets)]
        whole = [v for v, _, _ in cuts[name] if v not in dict(split)]
        passed = F.lit(0)
        for values, behind in ((whole, lambda v: v <= F.col("_value")), (list(dict(split)), lambda v: v < F.col("_value"))):
            if values:
                passed = passed + F.size(F.filter(F.lit(values), behind))
        between = F.get(after, passed).cast("long")
        if not split:
            df = marked.withColumn(name, between).drop("_value")
            continue
        values, aheads = F.lit([v for v, _ in split]), F.lit([a for _, a in split])
        within = F.col("_value").isin([v for v, _ in split])
        tied = running_in_segments(marked.where(within), ["_value"], [F.col(key).asc()], "_number")
        ahead = F.get(aheads, (F.array_position(values, F.col("_value")) - 1).cast("int"))
        numbered = tied.withColumn(name, bucket_of(ahead + F.col("_number") + 1, rows, buckets)).drop("_number")
        df = marked.where(~within).withColumn(name, between).unionByName(numbered).drop("_value")
    return df.select(*columns, *[name for name, *_ in scores])


def _bucket(row: int, rows: int, buckets: int) -> int:
    """bucket_of() of a known row."""
    size, larger = divmod(rows, buckets)
    edge = larger * (size + 1)
    return -(-row // (size + 1)) if row <= edge else larger - (edge - row) // max(size, 1)


def counts_ahead(
    df: DataFrame,
    value: str,
    descending: bool = False,
    rows_per_range: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per distinct value: its `ties` and how many rows sort strictly ahead of it.

    Equal values are counted before any shuffle, so a tie group of any size is one row here.
    `weight` names a column saying how many rows each input row stands for. NULLs sort last. Pass a
    stored frame: it is read more than once.
    """
    ties = F.sum(weight) if weight else F.count(F.lit(1))
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    levels = df.groupBy(value).agg(ties.alias("ties"))
    # There are at most as many levels as rows.
    seated = _seated(levels, [order], _ranges(df.count(), rows_per_range or ROWS_PER_RANGE))
    before = _amount_before(seated, F.sum("ties"))
    within = W.partitionBy("_range").orderBy("_seat").rowsBetween(W.unboundedPreceding, -1)
    return (
        seated.withColumn("_inside", F.coalesce(F.sum("ties").over(within), F.lit(0)))
        .join(F.broadcast(before), "_range")
        .select(value, "ties", (F.col("_before") + F.col("_inside")).alias("ahead"))
    )


def counts_ahead_in_segments(df: DataFrame, segment: list[str], value: str, weight: str) -> DataFrame:
    """counts_ahead() of many frames in one seating: one row per segment and distinct value, its `ties`
    and the total weight that sorts strictly ahead of it within the segment."""
    levels = df.groupBy(*segment, value).agg(F.sum(weight).alias("ties"))
    return running_in_segments(levels, segment, [F.col(value).asc_nulls_last()], "ahead", "ties")


def rank_by(
    df: DataFrame, value: str, name: str, descending: bool = False, rows_per_range: int | None = None
) -> DataFrame:
    """RANK() OVER (ORDER BY value)."""
    df = stash(df)
    levels = counts_ahead(df, value, descending, rows_per_range).select(
        F.col(value).alias("_level"), (F.col("ahead") + 1).alias(name)
    )
    return df.join(levels, F.col(value).eqNullSafe(F.col("_level"))).drop("_level")


def dense_rank_by(
    df: DataFrame, key: str, name: str, rows_per_range: int | None = None
) -> DataFrame:
    """DENSE_RANK() OVER (ORDER BY key) for a key without NULLs: number the distinct keys, join back."""
    keys = number_rows(
        df.select(key).distinct(), [F.col(key).asc()], name, rows_per_range=rows_per_range
    )
    return df.join(keys, key)


def _filled(df: DataFrame, name: str) -> Column:
    """A column without NULLs: numbers with 0 for them, all else as text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.coalesce(F.col(name), F.lit(0).cast(kind))
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def number_in_group(
    df: DataFrame, keys: list[str], slices: Column, order: list[Column], name: str, descending: bool = False
) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order), for groups of any size.

    `slices` cuts a group into parts that follow each other in `order` (descending: the largest first;
    NULL last). Rows are numbered within their slice; a running sum over the slices' sizes, which are
    combined on the map side, says how many rows of the group come before it. Keys and slices are of
    atomic types.

    Window and join are dealt by the same columns, which hold no NULL, so the rows are exchanged and
    sorted once. Only slices that have rows before them take part in the join.
    """
    sliced = df.withColumn("_slice", slices)
    parts = [*keys, "_slice"]
    unknown = sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(parts)), F.lit(0))
    # _part0 ... and _unknown tell slices apart as `parts` do, NULLs included.
    place = [f"_part{i}" for i in range(len(parts))] + ["_unknown"]
    told = [_filled(sliced, c).alias(p) for c, p in zip(parts, place)] + [unknown.alias("_unknown")]
    sizes = sliced.groupBy(*parts).agg(F.count(F.lit(1)).alias("_rows"))
    by_slice = F.col("_slice").desc_nulls_last() if descending else F.col("_slice").asc_nulls_last()
    ahead = W.partitionBy(*keys).orderBy(by_slice).rowsBetween(W.unboundedPreceding, -1)
    before = (
        sizes.withColumn("_before", F.sum("_rows").over(ahead))
        .where(F.col("_before") > 0)
        .select(*told, "_before")
    )
    within = F.row_number().over(W.partitionBy(*place).orderBy(*order))
    numbered = sliced.select(*df.columns, *told).withColumn("_within", within).join(before, place, "left")
    number = F.coalesce("_before", F.lit(0)) + F.col("_within")
    return numbered.select(*df.columns, number.cast("long").alias(name))


def _changes(column: pa.Array) -> np.ndarray:
    """For each row but the first, whether its value differs from the one before (NULL equals NULL)."""
    ahead, behind = column.slice(1), column.slice(0, len(column) - 1)
    unlike = pc.fill_null(pc.not_equal(ahead, behind), True)
    both_null = pc.and_(pc.is_null(ahead), pc.is_null(behind))
    return pc.and_not(unlike, both_null).to_numpy(zero_copy_only=False)


def _scanned(segment: list[int], weight: int | None):
    """Scan one sorted range: per row the total of the rows before it in its segment and range, and
    whether the segment is the one that the range begins with."""

    def scan(batches):
        here = TaskContext.get().partitionId()
        key, total, seat, still_first = None, 0, 0, True
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            columns = [batch.column(i) for i in segment]
            first_key = tuple(c[0].as_py() for c in columns)
            starts = np.zeros(n, dtype=bool)
            starts[0] = key is not None and first_key != key
            for c in columns:
                starts[1:] |= _changes(c)
            weights = np.ones(n, np.int64) if weight is None else batch.column(weight).to_numpy(zero_copy_only=False)
            before = np.cumsum(weights) - weights
            begin = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            within = np.where(begin >= 0, before - before[begin], before + total)
            in_first = np.full(n, still_first) & (begin < 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(within), pa.array(in_first), pa.array(np.full(n, here)), pa.array(np.arange(seat, seat + n))],
                names=[*batch.schema.names, "_within", "_first", "_range", "_seat"],
            )
            key = tuple(c[n - 1].as_py() for c in columns)
            total, seat, still_first = int(within[-1] + weights[-1]), seat + n, bool(in_first[-1])

    return scan


def running_in_segments(
    df: DataFrame, segment: list[str], order: list[Column], name: str, weight: str | None = None, ranges: int | None = None
) -> DataFrame:
    """Add the total `weight` (1 per row if None) of the rows that precede a row in its segment.

    A segmented prefix scan: one range exchange on (segment, order) of all rows, a scan of each sorted
    range, and the totals of the segments that are open at the range borders carried over as one number
    per range. So there is no join, and a segment may fill any number of tasks. The driver sees one row
    per range, never more than there are shuffle partitions. `order` must be unique within a segment;
    NULLs of a segment column form a segment; `weight` is a long without NULLs.
    """
    place = [F.col(c).asc_nulls_first() for c in segment] + order
    dealt = df.repartitionByRange(ranges, *place) if ranges else df.repartitionByRange(*place)
    schema = T.StructType(df.schema.fields + [
        T.StructField("_within", T.LongType()), T.StructField("_first", T.BooleanType()),
        T.StructField("_range", T.LongType()), T.StructField("_seat", T.LongType()),
    ])
    scan = _scanned([df.columns.index(c) for c in segment], None if weight is None else df.columns.index(weight))
    scanned = stash(dealt.sortWithinPartitions(*place).mapInArrow(scan, schema), "segments")
    after = F.col("_within") + (F.lit(1) if weight is None else F.col(weight))
    end = F.max_by(F.struct(after.alias("total"), "_first", F.struct(*segment).alias("key")), F.col("_seat"))
    ends = scanned.groupBy("_range").agg(end.alias("end"), F.min_by(F.struct(*segment), F.col("_seat")).alias("key"))
    carried, key, total = {}, None, 0
    for r in sorted(ends.collect(), key=lambda r: r["_range"]):
        carried[r["_range"]] = total if key is not None and r["key"] == key else 0
        # A range with a single segment hands on what it was handed.
        total = r["end"]["total"] + (carried[r["_range"]] if r["end"]["_first"] else 0)
        key = r["end"]["key"]
    if not any(carried.values()):
        return scanned.select(*df.columns, F.col("_within").alias(name))
    handed = F.lit([carried.get(i, 0) for i in range(max(carried) + 1)])
    # A cast as in the scan: small totals would make an array of ints.
    before = F.when(F.col("_first"), F.get(handed, F.col("_range").cast("int")).cast("long")).otherwise(F.lit(0))
    return scanned.select(*df.columns, (F.col("_within") + before).cast("long").alias(name))
