"""Shards by balanced label propagation (operator 3).

Documents with equal texts are linked; all others are free. Linked documents start in shards dealt by
hash. In each round every group of equal texts looks at its members' shards and asks to move members
towards the fullest of them. Quotas decide who may: wishes that form a cycle of shards are exchanged,
others follow as far as shards have room. What counts is only how many members of a group are in a shard, so a group is at most as many rows as there
are shards, whatever its size, and no group meets in one task. After the last round free documents fill
what room is left, which makes row counts differ by one at most (the law `rows`).

Numbers within a group or shard come from counts per (key, bucket of rows) and a running sum over the
buckets; the number of buckets follows the input.

Defined results: null text is the empty text (size 16, checksum 0), and equal to it; repeated rows and
null ids are rows like any other; an empty table gives no rows. Only the columns named as parameters
are read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .support import keep

SHARDS = 40
ROUNDS = 8
ROWS_PER_BUCKET = 20_000
OVERHEAD = 16  # bytes each document takes besides its text

_BEFORE = (W.unboundedPreceding, -1)


def _sum_before(amount: str, keys: list[str], order: list[str]) -> Column:
    frame = W.partitionBy(*keys).orderBy(*order).rowsBetween(*_BEFORE)
    return F.coalesce(F.sum(amount).over(frame), F.lit(0)).cast("long")


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Gapless numbers from 0 within `keys`, by bucket and row, without one task per key."""
    counts = df.groupBy(*keys, "bucket").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", _sum_before("_n", keys, ["bucket"])).drop("_n")
    within = F.row_number().over(W.partitionBy(*keys, "bucket").orderBy("row")) - 1
    joined = df.withColumn("_within", within).join(before, [*keys, "bucket"])
    return joined.withColumn(name, (F.col("_before") + F.col("_within")).cast("long")).drop("_before", "_within")


def flows(wanted: dict[tuple[int, int], int], free: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many of the members that want to move from one shard to another may.

    First movers are exchanged along cycles of wishes, which changes no size; then chains of wishes end
    in shards that have room. At most one entry per pair of shards, whatever the corpus.
    """
    left = {k: n for k, n in wanted.items() if n > 0 and k[0] != k[1]}
    free, allowed = dict(free), {}

    def push(path: list[int], n: int) -> None:
        for edge in zip(path, path[1:]):
            allowed[edge] = allowed.get(edge, 0) + n
            left[edge] -= n
            if not left[edge]:
                del left[edge]

    def search(start: int, done) -> list[int] | None:
        """Shortest path of wishes from a shard to one for which `done` holds."""
        came, queue = {}, [start]
        for node in queue:
            for step in sorted(j for i, j in left if i == node):
                if done(step):
                    path = [step, node]
                    while path[-1] != start:
                        path.append(came[path[-1]])
                    return path[::-1]
                if step not in came and step != start:
                    came[step] = node
                    queue.append(step)
        return None

    for start in sorted({i for i, _ in left}):
        while path := search(start, lambda j: j == start):
            push(path, min(left[e] for e in zip(path, path[1:])))
    for start in sorted({i for i, _ in left}):
        while path := search(start, lambda j: free.get(j, 0) > 0):
            n = min(free[path[-1]], *(left[e] for e in zip(path, path[1:])))
            push(path, n)
            free[path[-1]] -= n
            free[start] = free.get(start, 0) + n
    return allowed


def propagated(cells: DataFrame, room: DataFrame, rounds: int) -> DataFrame:
    """Cells (group, shard, members) after the rounds; `room` has one row per shard with its quota."""
    spark = cells.sparkSession
    quotas = {r.shard: r.quota for r in room.collect()}  # one row per shard
    crowded: list[int] = []
    for _ in range(rounds):
        # The fullest shard of the group that is not yet full of it, nor turned movers away in the round
        # before; ties fall by hash.
        seen = cells.join(F.broadcast(room), "shard")
        rank = F.struct("members", F.xxhash64("group", "shard").alias("tie"), "shard")
        open_to = (F.col("members") < F.col("quota")) & ~F.col("shard").isin(crowded)
        goal = F.max(F.when(open_to, rank)).over(W.partitionBy("group"))
        asking = seen.withColumn("goal", goal)
        moves = F.col("goal").isNotNull() & (F.col("goal") > rank)
        asking = keep(asking.select("group", "shard", "members", F.when(moves, F.col("goal.shard")).alias("to"),
                                    F.pmod(F.xxhash64("group"), F.lit(256)).alias("turn")), "asking", "snappy")
        movers = asking.where("to is not null")
        turns = keep(movers.groupBy("shard", "to", "turn").agg(F.sum("members").alias("wanted")), "turns", "snappy")
        # At most one row per pair of shards, and one per shard.
        wanted = turns.groupBy("shard", "to").agg(F.sum("wanted").alias("n")).collect()
        load = {r.shard: r.load for r in cells.groupBy("shard").agg(F.sum("members").alias("load")).collect()}
        allowed = flows({(r.shard, r.to): r.n for r in wanted}, {s: q - load.get(s, 0) for s, q in quotas.items()})
        asked, came = Counter(), Counter()
        for r in wanted:
            asked[r.to] += r.n
        for (_, to), n in allowed.items():
            came[to] += n
        was_crowded, crowded = crowded, [to for to, n in asked.items() if n > came[to]]
        if not allowed and not was_crowded and not crowded:
            break
        if not allowed:
            continue
        limits = spark.createDataFrame([(*k, n) for k, n in allowed.items()], "shard int, to int, flow long")
        turns = turns.withColumn("ahead", _sum_before("wanted", ["shard", "to"], ["turn"])).drop("wanted")
        within = W.partitionBy("shard", "to", "turn").orderBy("members", "group").rowsBetween(*_BEFORE)
        moved = F.greatest(F.lit(0), F.least("members", F.coalesce("flow", F.lit(0)) - F.col("ahead") - F.col("before")))
        accepted = (
            movers.withColumn("before", F.coalesce(F.sum("members").over(within), F.lit(0)))
            .join(turns, ["shard", "to", "turn"])
            .join(F.broadcast(limits), ["shard", "to"], "left")
            .withColumn("moved", moved.cast("long"))
        )
        after = accepted.select("group", F.inline(F.array(
            F.struct(F.col("shard"), (F.col("members") - F.col("moved")).alias("members")),
            F.struct(F.col("to").alias("shard"), F.col("moved").alias("members")),
        )))
        staying = asking.where("to is null").select("group", "shard", "members")
        cells = keep(
            staying.unionByName(after).where("members > 0").groupBy("group", "shard")
            .agg(F.sum("members").cast("long").alias("members")),
            "cells", "snappy",
        )
    return cells


def sharded(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """Per row: id, size, text_crc32, shard, slot, and the members its group has in that shard."""
    spark = docs.sparkSession
    value = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = keep(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(value) + OVERHEAD).cast("long").alias("size"),
        F.crc32(value.cast("binary")).alias("text_crc32"), F.md5(value).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    ), "rows")
    total = rows.count()
    buckets = max(64, -(-total // ROWS_PER_BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    groups = rows.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    linked = keep(rows.join(groups.select("group"), "group", "left_semi"), "linked")
    free_rows = rows.join(groups.select("group"), "group", "left_anti")

    room = spark.range(shards).select(
        F.col("id").cast("int").alias("shard"),
        (F.lit(total // shards) + (F.col("id") < total % shards).cast("int")).cast("long").alias("quota"),
    )
    # Dealing by number keeps each shard within its quota from the start.
    dealt = numbered(linked.withColumn("all", F.lit(0)), ["all"], "number")
    start = F.pmod("number", F.lit(shards)).cast("int").alias("shard")
    cells = dealt.groupBy("group", start).agg(F.count("*").alias("members"))
    cells = keep(propagated(keep(cells, "dealt", "snappy"), room, rounds), "settled", "snappy")

    # Members of a group are told apart by their number in it: shard by shard.
    ends = F.sum("members").over(W.partitionBy("group").orderBy("shard"))
    plan = cells.withColumn("end", ends).groupBy("group").agg(
        F.sort_array(F.collect_list(F.struct("end", "shard", "members"))).alias("cells")  # at most one per shard
    )
    # Members meet their group's plan in parts of bounded size, so a hot group fills several tasks.
    part = F.floor(F.col("number") / ROWS_PER_BUCKET)
    last = F.floor((F.element_at("cells", -1).end - 1) / ROWS_PER_BUCKET)
    plan = plan.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    cell = F.filter("cells", lambda c: F.col("number") < c.end)[0]
    settled = (
        numbered(linked, ["group"], "number").withColumn("part", part).join(plan, ["group", "part"]).withColumn("cell", cell)
        .select("id", "size", "text_crc32", "bucket", "row", F.col("cell.shard").alias("shard"),
                F.col("cell.members").alias("together"))
    )

    load = cells.groupBy("shard").agg(F.sum("members").alias("load"))
    one = W.orderBy("shard")  # one row per shard
    gaps = room.join(load, "shard", "left").withColumn("free", F.col("quota") - F.coalesce("load", F.lit(0)))
    gaps = gaps.select("shard", F.sum("free").over(one).alias("end"))
    gaps = gaps.agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("gaps"))
    filling = (
        numbered(free_rows.withColumn("all", F.lit(0)), ["all"], "number")
        .join(F.broadcast(gaps.withColumn("all", F.lit(0))), "all")  # one row
        .select("id", "size", "text_crc32", "bucket", "row",
                F.filter("gaps", lambda g: F.col("number") < g.end)[0].shard.alias("shard"),
                F.lit(1).cast("long").alias("together"))
    )
    placed = keep(settled.unionByName(filling), "placed")
    return numbered(placed, ["shard"], "slot").drop("bucket", "row").withColumnRenamed("id", id_col)


def op3(docs: DataFrame) -> DataFrame:
    return sharded(docs.select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "together",
    )
