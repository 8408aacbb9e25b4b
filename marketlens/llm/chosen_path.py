"""Near-duplicate texts by a chosen-path set similarity join (operator 5).

A text is the set of its word shingles. Independent trees branch on minwise tokens: a node keeps the
documents that share the tokens chosen on the path to it, and each child is one more chosen token of a
node. Nodes of few documents are compared exhaustively; larger ones choose further tokens. A large node
of similar documents would never split: there every member is compared with one pivot, and those much
like it leave the node as the pivot's followers. Once links are confirmed, followers are compared, in
blocks, with all members of their node that are in another component and near enough to the pivot to be
like a follower; so are all members of a node that is still large after the last level. Every tree starts
from a path of two tokens, which a pair of similarity 0.8 shares with probability 0.64: twelve trees miss it
in small nodes with 0.36 ** 12.

Texts with equal sets are one class from the start. Comparisons use 64 four-bit minwise values, which
only discard pairs far below the threshold; every link is then confirmed on the full sets, first one
link per document and only then those between documents that are not yet connected.

Defined results: a null or empty text, or one without words, has an empty set and is linked with
nothing; with fewer words than a shingle the whole sequence is one shingle; repeated rows are copies of
each other; a null id never names a component unless no other id is in it; an empty table gives no rows.
Only the columns named as parameters are read; `distinct_documents` returns all columns.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, merged
from .support import hint_if_small, keep, text_key, without, workers_find_package
from .words import mixed, word_hashes

TREES = 12  # each starts from a path of two chosen tokens
CHOSEN = 2  # tokens chosen per node further down
MINWISE = 64
SMALL_NODE = 16  # members that a plain join compares with each other
WIDE_NODE = 2048  # members that one task compares by their sketches
PROPOSED = 1  # best partners a member of a wide node proposes; the rest is compared by full sets
DEPTH = 6
BLOCK = 1024  # members of a large node's followers, and of those near them, that meet in one task
LIKELY = 38  # equal four-bit values of 64 that a pair of similarity 0.8 (52 expected) keeps
ALIKE = 55  # from this many on, a member of a large node is left to its pivot
AROUND = ALIKE - (MINWISE - LIKELY)  # least a likely partner of such a member equals the pivot: differences add up
BLOCK_SHINGLES = 1 << 19  # of the members of a wide node that meet in one task, twice

_FACTORS = np.random.default_rng(20).integers(1, 1 << 63, MINWISE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    hashes = word_hashes(text.encode().lower())  # bytes: lowers A-Z only
    if not len(hashes):
        return hashes
    size = min(width, len(hashes))
    rolled = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        rolled = mixed(rolled * np.uint64(3) + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(rolled)


def minwise(hashes: np.ndarray) -> np.ndarray:
    """The smallest of the shingles under each of the hash functions."""
    best = np.full(MINWISE, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        best = np.minimum(best, (hashes[None, at : at + 2048] * _FACTORS[:, None]).min(axis=1))
    return (best >> np.uint64(32)).astype(np.uint32)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u8")


def signed(docs: DataFrame, id_col: str, text_col: str, width: int, keyed: bool = False) -> DataFrame:
    """Per row: id, text_key (null unless `keyed`), size of its set, digest, first path of each tree, sketch
    and the set itself."""
    workers_find_package(docs.sparkSession)

    def sign(batches):
        for batch in batches:
            sizes, keys, values, sketches, sets = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text or "", width)
                data = own.astype("<u8").tobytes()
                least = minwise(own)
                sizes.append(len(own))
                keys.append(hashlib.md5(data).digest() if len(own) else None)
                paths = least[: 2 * TREES].astype(np.uint64)
                values.append((paths[::2] << np.uint64(32) | paths[1::2]).view(np.int64))
                four = (least & np.uint32(15)).astype(np.uint64).reshape(4, 16) << (4 * np.arange(16, dtype=np.uint64))
                sketches.append(np.bitwise_or.reduce(four, axis=1).view(np.int64))
                sets.append(data)
            flat = np.concatenate(values) if values else np.array([], np.int64)
            offsets = np.arange(0, len(flat) + 1, TREES, dtype=np.int32)
            parts = np.array(sketches, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 *(pa.array(parts[:, k]) for k in range(4)), pa.array(sets, pa.binary())],
                names=["id", "text_key", "n", "key", "paths", "s0", "s1", "s2", "s3", "shingles"],
            )

    named = text_key(text_col) if keyed else F.lit(None).cast("string")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), named.alias("text_key"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)]).add("text_key", T.StringType())
    schema = schema.add("n", T.LongType()).add("key", T.BinaryType()).add("paths", T.ArrayType(T.LongType()))
    for k in range(4):
        schema = schema.add(f"s{k}", T.LongType())
    return source.mapInArrow(sign, schema.add("shingles", T.BinaryType()))


SKETCH = ["s0", "s1", "s2", "s3"]


def _equal_values(a: str, b: str) -> Column:
    """How many of the 64 four-bit values of two sketches agree."""
    ones, differ = 0x1111111111111111, F.lit(0)
    for s in SKETCH:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2))
        any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, 3)).bitwiseAND(F.lit(ones))
        differ = differ + F.bit_count(any_bit)
    return F.lit(MINWISE) - differ


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _within(nodes: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of every (small) node."""
    return nodes.alias("a").join(
        nodes.alias("b"),
        (F.col("a.node") == F.col("b.node")) & (F.col("a.c") < F.col("b.c"))
        & _similar_sizes("a", "b", percent) & (_equal_values("a", "b") >= LIKELY),
    ).select(F.col("a.c").alias("u"), F.col("b.c").alias("v"))


def _with_pivots(nodes: DataFrame, percent: int) -> DataFrame:
    """Members of large nodes beside one pivot each: its class, how many values are equal, and how alike they
    are (0: not of similar size)."""
    lead = F.struct(F.xxhash64("node", "c").alias("turn"), "c", "n", *SKETCH)
    pivots = nodes.groupBy("node").agg(F.min(lead).alias("p")).select("node", "p.c", "p.n", *(f"p.{s}" for s in SKETCH))
    joined = nodes.alias("a").join(pivots.alias("p"), "node")
    equal = _equal_values("a", "p")
    alike = F.when(_similar_sizes("a", "p", percent), equal).otherwise(0)
    return joined.select(
        "node", "a.c", "a.n", *(f"a.{s}" for s in SKETCH), F.col("p.c").alias("pivot"), equal.alias("equal"),
        alike.alias("alike"),
    )


def _star(beside: DataFrame) -> DataFrame:
    pair = (F.col("alike") >= LIKELY) & (F.col("c") != F.col("pivot"))
    return beside.where(pair).select(F.least("c", "pivot").alias("u"), F.greatest("c", "pivot").alias("v"))


def _proposals(nodes: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (node, u, v) of wide nodes: each member with its most alike partners. A row without v
    is a member with more likely partners than that, or one that such a member leaves out."""

    def propose(table: pa.Table) -> pa.Table:
        c, n = table.column("c").to_numpy(), table.column("n").to_numpy()
        sketch = np.stack([table.column(k).to_numpy() for k in SKETCH], axis=1).view(np.uint64)
        u, v, left_out = [], [], np.zeros(len(c), dtype=bool)
        for at in range(0, len(c), 128):
            rows = slice(at, at + 128)
            x = sketch[rows, None, :] ^ sketch[None, :, :]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            equal = MINWISE - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=2, dtype=np.int64)
            small, large = np.minimum(n[rows, None], n), np.maximum(n[rows, None], n)
            equal[(small * 100 < large * percent) | (c[rows, None] == c)] = 0
            likely = equal >= LIKELY
            many = likely.sum(axis=1) > PROPOSED
            if many.any():
                places = np.flatnonzero(many)
                best = np.argpartition(-equal[many], PROPOSED - 1, axis=1)[:, :PROPOSED]
                left = likely[many]
                np.put_along_axis(left, best, False, axis=1)
                left_out[at + places] = True
                left_out |= left.any(axis=0)
                chosen = np.zeros_like(left)
                np.put_along_axis(chosen, best, True, axis=1)
                likely[places] = chosen & likely[places]
            i, j = np.nonzero(likely)
            u.append(c[rows][i])
            v.append(c[j])
        u, v = np.concatenate(u), np.concatenate(v)
        alone = c[left_out]
        return pa.table({
            "node": np.full(len(u) + len(alone), table.column("node")[0].as_py()),
            "u": np.concatenate([np.minimum(u, v), alone]),
            "v": pa.array(np.concatenate([np.maximum(u, v), alone]), mask=np.arange(len(u) + len(alone)) >= len(u)),
            "n": np.concatenate([np.zeros(len(u), dtype=np.int64), n[left_out]]),
        })

    workers_find_package(nodes.sparkSession)
    return nodes.groupBy("node").applyInArrow(propose, "node long, u long, v long, n long")


def _exhaustive(members: DataFrame, label: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect members (node, c, n) of the same node further, by their full sets.

    Members of a node meet in blocks of about BLOCK_SHINGLES, all blocks with all, so a task holds the sets
    of two blocks, however long the texts are.
    """
    members = _with_components(members, label)
    apart = members.groupBy("node").agg(
        F.min("component").alias("a"), F.max("component").alias("b"),
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"),
    ).where("a <> b")
    members = keep(members.join(apart.select("node", "blocks"), "node"), "members")

    def connect(table: pa.Table) -> pa.Table:
        c, label = table.column("c").to_numpy(), table.column("component").to_numpy().copy()
        block = table.column("block").to_numpy()
        one_block = (block == block[0]).all()
        own = [_unpacked(x.as_py()) for chunk in table.column("shingles").chunks for x in chunk]
        n = np.array([len(x) for x in own])
        values, flat = np.unique(np.concatenate(own), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        u, v = [], []
        for i in range(len(c)):
            other = label != label[i]
            if not one_block:
                other &= block != block[i]  # members of one block meet in a task of theirs
            if not other.any():
                continue
            marked = np.zeros(len(values), dtype=bool)
            marked[flat[starts[i] : starts[i] + n[i]]] = True
            both = np.add.reduceat(marked[flat], starts, dtype=np.int64)
            near = other & (100 * both >= percent * (n[i] + n - both))
            for j in np.flatnonzero(near):
                if label[j] != label[i]:
                    u.append(c[i])
                    v.append(c[j])
                    label[label == label[j]] = label[i]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    needed = keep(members.select("c").distinct(), "needed")
    own = sets.join(hint_if_small(needed), "c").select("c", "shingles")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("c", F.lit("part")), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other"))
    joined = met.select(task.alias("node"), "c", "component", "block").join(own, "c")
    return joined.groupBy("node").applyInArrow(connect, "u long, v long")


def _with_components(members: DataFrame, label: DataFrame | None) -> DataFrame:
    if label is None:
        return members.withColumn("component", F.col("c"))
    members = members.join(label.withColumnRenamed("id", "c"), "c", "left")
    return members.withColumn("component", F.coalesce("component", "c"))


def _sides(around: DataFrame, label: DataFrame | None) -> DataFrame:
    """Rows (task, side, c, n, s0..s3, component) of what large nodes still have to compare: left with right.

    `around` has the followers of each node and the members near them. Pairs within a component need no
    comparison, so the followers in the node's main component meet the members outside it only.
    """
    members = keep(_with_components(around, label), "around")
    counts = members.groupBy("node", "component").agg(F.count("*").alias("there"))
    main = counts.groupBy("node").agg(
        F.max_by("component", F.struct("there", "component")).alias("main"), F.count("*").alias("parts")
    ).where("parts > 1")
    members = keep(members.join(main.drop("parts"), "node"), "around")
    other = F.col("component") != F.col("main")
    columns = ["c", "n", *SKETCH, "component"]
    parts = (
        (0, "left", F.col("follows") & other), (0, "right", F.lit(True)),
        (1, "left", ~F.col("follows") & other), (1, "right", F.col("follows") & ~other),
    )
    rows = [members.where(chosen).select(
        F.xxhash64("node", F.lit(k)).alias("task"), F.lit(side).alias("side"), *columns
    ) for k, side, chosen in parts]
    return functools.reduce(DataFrame.unionByName, rows)


def _blocks(sides: DataFrame) -> DataFrame:
    """The rows of every task dealt to blocks: each left block meets each right block in a node of its own."""
    sizes = sides.groupBy("task").agg(
        *(F.ceil(F.count_if(F.col("side") == side) / BLOCK).cast("int").alias(side) for side in ("left", "right"))
    ).where("left > 0 and right > 0")
    rows = sides.join(sizes, "task")
    of_left, here = F.col("side") == "left", F.xxhash64("c", F.lit("block"))
    own = F.pmod(here, F.when(of_left, F.col("left")).otherwise(F.col("right"))).cast("int")
    others = F.sequence(F.lit(0), F.when(of_left, F.col("right")).otherwise(F.col("left")) - 1)
    met = rows.withColumn("own", own).withColumn("other", F.explode(others))
    pair = F.when(of_left, F.xxhash64("task", "own", "other")).otherwise(F.xxhash64("task", "other", "own"))
    return met.select(pair.alias("node"), of_left.alias("of_left"), "c", "n", *SKETCH, "component")


def _across(blocks: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (node, u, v) of left and right members in different components: the most alike one of
    each left member. Rows without v are the members with further likely partners, and those partners."""

    def propose(table: pa.Table) -> pa.Table:
        left = table.column("of_left").to_numpy()
        c, n, component = (table.column(k).to_numpy() for k in ("c", "n", "component"))
        sketch = np.stack([table.column(k).to_numpy() for k in SKETCH], axis=1).view(np.uint64)
        ours, theirs = np.flatnonzero(left), np.flatnonzero(~left)
        u, v, alone = [], [], []
        for at in range(0, len(ours) if len(theirs) else 0, 128):
            rows = ours[at : at + 128]
            x = sketch[rows, None, :] ^ sketch[None, theirs, :]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            equal = MINWISE - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=2, dtype=np.int64)
            small, large = np.minimum(n[rows, None], n[theirs]), np.maximum(n[rows, None], n[theirs])
            equal[(small * 100 < large * percent) | (component[rows, None] == component[theirs])] = 0
            likely = equal >= LIKELY
            some, many = likely.any(axis=1), likely.sum(axis=1) > 1
            u.append(c[rows[some]])
            v.append(c[theirs[equal.argmax(axis=1)[some]]])
            alone += [c[rows[many]], c[theirs[likely[many].any(axis=0)]]]
        none = [np.array([], dtype=np.int64)]
        u, v, alone = np.concatenate(u + none), np.concatenate(v + none), np.unique(np.concatenate(alone + none))
        by_c = np.argsort(c)
        return pa.table({
            "node": np.full(len(u) + len(alone), table.column("node")[0].as_py()),
            "u": np.concatenate([np.minimum(u, v), alone]),
            "v": pa.array(np.concatenate([np.maximum(u, v), alone]), mask=np.arange(len(u) + len(alone)) >= len(u)),
            "n": np.concatenate([np.zeros(len(u), dtype=np.int64), n[by_c[np.searchsorted(c[by_c], alone)]]]),
        })

    workers_find_package(blocks.sparkSession)
    return blocks.groupBy("node").applyInArrow(propose, "node long, u long, v long, n long")


def _sized(nodes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of small, wide and larger nodes; a node of one member holds no pair."""
    sizes = nodes.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    rows = keep(nodes.join(sizes, "node"), "nodes")
    size = F.col("size")
    parts = (size <= SMALL_NODE, size.between(SMALL_NODE + 1, WIDE_NODE), size > WIDE_NODE)
    return tuple(rows.where(p).drop("size") for p in parts)


def candidates(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Distinct likely pairs (u < v) of classes (c, n, paths, s0..s3), the rows of wide nodes, and those of
    large nodes' followers and the members around them, if there are any."""
    nodes = classes.select("c", "n", *SKETCH, F.posexplode("paths").alias("tree", "path")).select(
        F.xxhash64("tree", "path").alias("node"), "c", "n", *SKETCH
    )
    found, wide, around = [], [], []
    for level in range(DEPTH + 1):
        small, middle, large = _sized(nodes)
        found.append(_within(small, percent))
        wide.append(middle)
        if large.isEmpty():
            break
        beside = keep(_with_pivots(large, percent), "pivots")
        found.append(_star(beside))
        others = beside.where(F.col("c") != F.col("pivot"))
        # What still shares all chosen tokens after the last level is compared whole.
        follows = F.col("alike") >= ALIKE if level < DEPTH else F.lit(True)
        near = others.where((F.col("equal") >= AROUND) | follows)
        around.append(near.select("node", "c", "n", *SKETCH, follows.alias("follows")))
        staying = others.where(~follows).drop("pivot", "equal", "alike")
        # Further tokens are the four-bit values of the sketch, chosen anew for every node.
        chosen = F.array(*(F.pmod(F.xxhash64("node", F.lit(k)), F.lit(MINWISE)).cast("int") for k in range(CHOSEN)))
        value = F.expr("shiftrightunsigned(array(s0, s1, s2, s3)[token div 16], 4 * (token % 16)) & 15")
        nodes = staying.select("node", "c", "n", *SKETCH, F.explode(F.array_distinct(chosen)).alias("token")).select(
            F.xxhash64("node", "token", value).alias("node"), "c", "n", *SKETCH
        )
    union = functools.partial(functools.reduce, DataFrame.unionByName)
    return keep(union(found).distinct(), "candidates"), union(wide), union(around) if around else None


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def confirm(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            similar = []
            for x, y in zip(a, b):
                left, right = _unpacked(x.as_py()), _unpacked(y.as_py())
                both = len(np.intersect1d(left, right, assume_unique=True))
                similar.append(100 * both >= percent * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(similar, pa.bool_())], names=["u", "v", "linked"]
            )

    ends = pairs.select(F.col("u").alias("c")).unionByName(pairs.select(F.col("v").alias("c")))
    needed = keep(ends.distinct(), "needed")
    own = keep(sets.join(hint_if_small(needed), "c"), "sets")
    joined = pairs.join(own.select(F.col("c").alias("u"), F.col("shingles").alias("a")), "u").join(
        own.select(F.col("c").alias("v"), F.col("shingles").alias("b")), "v"
    )
    return joined.select("u", "v", "a", "b").mapInArrow(confirm, "u long, v long, linked boolean")


def _apart(pairs: DataFrame, label: DataFrame | None) -> DataFrame:
    """The pairs whose ends are not connected yet."""
    if label is None:
        return pairs
    for end in ("u", "v"):
        pairs = pairs.join(label.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    return pairs.where(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v")


def linked(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(id, component) of the linked classes; None without any link.

    One likely pair per class is confirmed first, and of the others only those still apart. Members of
    wide nodes that had more partners than they could propose are then compared by their sets, all with
    all where they are not connected. Last come the followers in large nodes, in the same two steps.
    """
    found, wide, around = candidates(classes, percent)
    proposed = keep(_proposals(wide, percent), "proposed")
    pairs = found.unionByName(proposed.where("v is not null").select("u", "v"))
    pairs = keep(pairs.distinct(), "pairs")
    first = keep(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "first")
    links = keep(_confirmed(first, sets, percent).where("linked").select("u", "v"), "links")
    label = None if links.isEmpty() else components(links)
    rest = keep(_apart(pairs.join(first, ["u", "v"], "left_anti"), label), "rest")
    more = keep(_confirmed(rest, sets, percent).where("linked").select("u", "v"), "links")
    if not more.isEmpty():
        label = merged(label, more)
    members = proposed.where("v is null").select("node", F.col("u").alias("c"), "n")
    last = keep(_exhaustive(members, label, sets, percent), "links")
    if not last.isEmpty():
        label = merged(label, last)
    if around is None:
        return label
    proposed = keep(_across(_blocks(_sides(around, label)), percent), "proposed")
    pairs = keep(proposed.where("v is not null").select("u", "v").distinct(), "pairs")
    if pairs.isEmpty():
        return label
    more = keep(_confirmed(pairs, sets, percent).where("linked").select("u", "v"), "links")
    if not more.isEmpty():
        label = merged(label, more)
    members = proposed.where("v is null").select("node", F.col("u").alias("c"), "n")
    last = keep(_exhaustive(members, label, sets, percent), "links")
    return label if last.isEmpty() else merged(label, last)


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, keyed: bool) -> DataFrame:
    """Per row: id, text_key (null unless `keyed`), n, component_id."""
    rows = signed(docs, id_col, text_col, width, keyed).withColumn("row", F.monotonically_increasing_id())
    rows = keep(rows, "signed")
    some = [F.any_value(c).alias(c) for c in ("n", "paths", *SKETCH)]
    classes = keep(
        rows.where("n > 0").groupBy("key").agg(F.min("row").alias("c"), F.min("id").alias("least_id"), *some), "classes"
    )
    sets = rows.select(F.col("row").alias("c"), "shingles")
    label = linked(classes.drop("key", "least_id"), sets, percent)
    named = classes.select("key", "c", "least_id")
    if label is not None:
        named = named.join(label.withColumnRenamed("id", "c"), "c", "left")
    named = named.withColumn("component", F.coalesce("component", "c") if label is not None else F.col("c"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(least, "component").select("key", "component_id")
    return rows.select("id", "text_key", "n", "key").join(by_key, "key", "left").select(
        "id", "text_key", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links), kept."""
    return _grouped(docs, id_col, text_col, width, percent, keyed=False).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """The rows kept: one of each group of near-duplicates, that with the smallest id.

    Rows are told apart by id and text: where an id occurs with several texts, each text is judged by its
    own group, and of texts of one group under the group's id that with the smallest digest stays. Equal
    rows (id and text) count once; rows without an id stay.
    """
    found = _grouped(docs, id_col, text_col, width, 80, keyed=True).where(F.col("id").isNotNull())
    found = keep(found.select("id", "text_key", "n", "component_id"), "found")
    dropped = found.where(F.col("id") != F.col("component_id")).select("id", "text_key")
    repeated = not found.groupBy("id").count().where("count > 1").isEmpty()
    if repeated or not docs.where(F.col(id_col).isNull()).isEmpty():
        docs = docs.dropDuplicates([id_col, text_col])
    if repeated:
        own = found.where((F.col("id") == F.col("component_id")) & (F.col("n") > 0)).select("id", "text_key").distinct()
        first = own.groupBy("id").agg(F.min("text_key").alias("first"))
        dropped = dropped.unionByName(own.join(first, "id").where("text_key <> first").select("id", "text_key"))
    return without(docs, dropped.withColumnRenamed("id", id_col), id_col, text_col)


def op5(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"), width=2, percent=80)


#: DuckDB: all pairs that share a shingle, then components by iteration.
SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
flat AS (SELECT doc_id, n, hash(unnest(s)) AS h FROM sized),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common, any_value(a.n) AS m, any_value(b.n) AS n
    FROM flat a JOIN flat b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY 1, 2),
links AS (SELECT u, v FROM shared WHERE 100 * common >= 80 * (m + n - common)),
edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT doc_id AS id, doc_id AS other FROM sized UNION SELECT r.id, e.v FROM reach r JOIN edges e ON r.other = e.u)
SELECT s.doc_id, s.n AS n_shingles, r.c AS component_id, s.doc_id = r.c AS kept
FROM sized s JOIN (SELECT id, min(other) AS c FROM reach GROUP BY id) r ON s.doc_id = r.id
"""
