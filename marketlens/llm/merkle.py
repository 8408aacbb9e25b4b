"""Merkle manifest of a dataset by sibling-shift self-joins (operator 13).

Every row is a leaf: the digest of its fields, each with its length, so no two rows run together. Leaves
are numbered within their tree in the order of the key. On every level each node meets its siblings by an
equijoin on a computed index, the own index XOR 1 in a binary tree, the next slots of the same run
otherwise; the row in slot zero then emits the parent. Node keys are unique, so a tree that holds most of
the rows is no hot key. The roots of the trees, in the order of their names, are the leaves of a tree of
trees. Walking down again, each node adds its siblings to the steps of its parent: every leaf gets the
proof that leads from it to the root.

A digest is sha256 in lowercase hex; what is hashed are texts, digests as hex. In a run shorter than the
arity (the last of a level, also a single node) the nodes there are make the parent. A tree of one leaf
has that leaf as root.

Defined results: a null field counts as `-`, an empty text as `0:`; rows with equal keys follow each other
by digest, and copies of a row each are a leaf; null keys come first and are never altered by the
tampering probe; a null tree name is a tree of its own, before all others; an empty table gives no rows.
Only the columns named as parameters are read, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import running_in_segments
from .support import crc32_sql, keep

KEPT_EVERY = 4  # levels between two written frames on the way down


def field(value: Column) -> Column:
    """`-` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*texts: Column) -> Column:
    """Binary, half the size of the hex text that goes into the next digest."""
    return F.unhex(F.sha2(F.concat(*texts), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def joined_hex(digests: Column) -> Column:
    return F.array_join(F.transform(digests, hex_text), "")


@dataclass(frozen=True)
class Tree:
    """Level 0 holds the leaves; a level's rows: tree, idx, digest, siblings (of the run, left to right)."""

    levels: list[DataFrame]
    top: DataFrame  # tree, digest: one row per tree
    arity: int


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    slot = F.col("idx") % arity
    found, places = nodes, []
    for shift in range(1, arity):
        place = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + shift) % arity
        other = nodes.select(
            F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.struct("idx", "digest").alias(f"_sibling{shift}")
        )
        same = (F.col("tree") == F.col("_tree")) & (place == F.col("_idx"))
        found = found.join(other, same, "left").drop("_tree", "_idx")
        places.append(F.col(f"_sibling{shift}"))
    # By index, that is from left to right, and without the siblings a short run lacks.
    ordered = F.array_sort(F.filter(F.array(*places), lambda s: s.isNotNull()))
    return found.select(*nodes.columns, F.transform(ordered, lambda s: s["digest"]).alias("siblings"))


def _finished() -> Column:
    """A node without siblings in slot zero of the first run is the root of its tree."""
    return (F.col("idx") == 0) & (F.size("siblings") == 0)


def built(leaves: DataFrame, arity: int = 2) -> Tree:
    """The levels over `leaves` (tree, idx from 0 without gaps, digest, further columns), all trees at once."""
    if arity < 2:
        raise ValueError("a parent needs at least two children")
    widest = leaves.agg(F.max("idx")).first()[0]
    nodes, levels = leaves, []
    while True:
        level = keep(_with_siblings(nodes, arity), f"level-{len(levels)}")
        levels.append(level)
        parent = digest(hex_text(F.col("digest")), joined_hex(F.col("siblings")))
        nodes = level.where(F.col("idx") % arity == 0).select(
            "tree", F.floor(F.col("idx") / arity).cast("long").alias("idx"),
            F.when(_finished(), F.col("digest")).otherwise(parent).alias("digest"),
        )
        if not widest:
            return Tree(levels, nodes.select("tree", "digest"), arity)
        widest //= arity


def proofs(tree: Tree, above: DataFrame) -> DataFrame:
    """The rows of level 0 with `steps` to the root: per level the slot and the siblings. `above` (tree,
    steps, further columns) holds the steps that follow for each tree's root."""
    passed = [c for c in above.columns if c not in ("tree", "steps")]
    parents = above.withColumn("idx", F.lit(0).cast("long"))
    for height in reversed(range(len(tree.levels))):
        children = tree.levels[height]
        up = parents.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), "steps", *passed)
        own = F.struct((F.col("idx") % tree.arity).cast("int").alias("slot"), "siblings")
        steps = F.when(_finished(), F.col("steps")).otherwise(F.concat(F.array(own), "steps"))
        place = F.floor(F.col("idx") / tree.arity).cast("long")
        met = children.join(up, (F.col("tree") == F.col("_tree")) & (place == F.col("_idx")))
        rest = [c for c in children.columns if c != "siblings"]
        parents = met.select(*rest, steps.alias("steps"), *passed)
        if height and height % KEPT_EVERY == 0:
            parents = keep(parents, f"steps-{height}")
    return parents


def folded(leaf: Column, steps: Column) -> Column:
    """The root, as hex, that a leaf's hex digest leads to along its steps."""

    def up(node: Column, step: Column) -> Column:
        left = F.slice(step["siblings"], 1, step["slot"])
        right = F.slice(step["siblings"], step["slot"] + 1, F.size(step["siblings"]))
        return F.sha2(F.concat(joined_hex(left), node, joined_hex(right)), 256)

    return F.aggregate(steps, leaf, up)


def tree_name(value: Column) -> Column:
    """Never null, and in the order of `value`, null first."""
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit("="), value.cast("string")))


def manifest(rows: DataFrame, arity: int = 2) -> DataFrame:
    """`rows` (tree from tree_name(), key, digest, further columns) with subroot, root (binary) and the
    steps from the leaf to the root. The root is one value, so the driver may hold it."""
    order = [F.col("key").asc_nulls_first(), F.col("digest").asc()]
    leaves = running_in_segments(rows, ["tree"], order, "idx")
    trees = built(leaves, arity)
    subroots = keep(trees.top, "subroots").withColumn("all", F.lit(""))
    numbered = running_in_segments(subroots, ["all"], [F.col("tree").asc()], "idx").select(
        F.col("all").alias("tree"), "idx", "digest", F.col("tree").alias("name")
    )
    forest = built(numbered, arity)
    last = forest.top.first()
    root = F.lit(bytes(last["digest"]) if last else None).cast("binary")
    above = proofs(forest, forest.top.select("tree", _no_steps().alias("steps"))).select(
        F.col("name").alias("tree"), "steps", F.col("digest").alias("subroot"), root.alias("root")
    )
    return proofs(trees, keep(above, "above"))


def _no_steps() -> Column:
    return F.array().cast("array<struct<slot:int,siblings:array<binary>>>")


def document_leaf(n_chars: Column) -> Column:
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    return digest(*map(field, fields))


def op13(docs: DataFrame) -> DataFrame:
    probed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = F.when(probed, document_leaf(F.col("n_chars") + 1)).otherwise(F.col("digest"))
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").withColumn("digest", document_leaf(F.col("n_chars")))
    rows = rows.select(tree_name(F.col("lang")).alias("tree"), F.col("doc_id").alias("key"), "digest", claimed.alias("claimed"))
    proven = manifest(keep(rows, "leaves"))
    siblings = F.flatten(F.transform("steps", lambda s: s["siblings"]))
    out = proven.select(
        F.col("key").alias("doc_id"),
        hex_text(F.col("digest")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        F.sha2(joined_hex(siblings), 256).alias("proof_sha256"),
        folded(hex_text(F.col("claimed")), F.col("steps")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR) || ':' || {name}::VARCHAR END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join([*map(_sql_field, ("doc_id", "source", "lang")), _sql_field(n_chars), _sql_field("text")]) + ")"


_CRC_TABLE, _CRC = crc32_sql("doc_id::VARCHAR")

SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, {_sql_leaf('n_chars')} AS leaf,
        CASE WHEN {_CRC} % 7 = 0 THEN {_sql_leaf('(n_chars + 1)')} ELSE {_sql_leaf('n_chars')} END AS claimed
    FROM documents, crc_table),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY tree) AS size FROM leaves),
nodes AS (
    SELECT tree, 0 AS height, idx, size, leaf AS digest FROM numbered
    UNION ALL
    SELECT tree, height + 1, idx // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE size > 1 GROUP BY tree, height, idx // 2, size),
subroots AS (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS size
    FROM nodes WHERE size = 1),
top AS (
    SELECT 0 AS height, idx, size, digest FROM subroots
    UNION ALL
    SELECT height + 1, idx // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
    FROM top WHERE size > 1 GROUP BY height, idx // 2, size),
steps AS (
    SELECT n.tree, n.height, n.idx, s.digest AS sibling
    FROM nodes n LEFT JOIN nodes s ON n.tree = s.tree AND n.height = s.height AND s.idx = xor(n.idx, 1)
    WHERE n.size > 1),
top_steps AS (
    SELECT n.height, n.idx, s.digest AS sibling
    FROM top n LEFT JOIN top s ON n.height = s.height AND s.idx = xor(n.idx, 1) WHERE n.size > 1),
walk AS (
    SELECT doc_id, tree, leaf, idx AS leaf_idx, 0 AS height, idx, claimed AS node, '' AS proof FROM numbered
    UNION ALL
    SELECT w.doc_id, w.tree, w.leaf, w.leaf_idx, w.height + 1, w.idx // 2,
        sha256(CASE WHEN w.idx % 2 = 1 THEN s.sibling || w.node ELSE w.node || coalesce(s.sibling, '') END),
        w.proof || coalesce(s.sibling, '')
    FROM walk w JOIN steps s ON w.tree = s.tree AND w.height = s.height AND w.idx = s.idx),
at_subroot AS (
    SELECT w.*, r.digest AS subroot, r.idx AS place
    FROM (SELECT *, max(height) OVER (PARTITION BY tree, leaf_idx) AS last FROM walk) w
    JOIN subroots r ON w.tree = r.tree WHERE w.height = w.last),
climb AS (
    SELECT doc_id, tree, leaf, leaf_idx, subroot, 0 AS height, place AS idx, node, proof FROM at_subroot
    UNION ALL
    SELECT c.doc_id, c.tree, c.leaf, c.leaf_idx, c.subroot, c.height + 1, c.idx // 2,
        sha256(CASE WHEN c.idx % 2 = 1 THEN s.sibling || c.node ELSE c.node || coalesce(s.sibling, '') END),
        c.proof || coalesce(s.sibling, '')
    FROM climb c JOIN top_steps s ON c.height = s.height AND c.idx = s.idx)
SELECT c.doc_id, c.leaf, c.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256,
    c.node AS folded_root, c.node = t.digest AS verified
FROM (SELECT *, max(height) OVER (PARTITION BY tree, leaf_idx) AS last FROM climb) c, (SELECT digest FROM top WHERE size = 1) t
WHERE c.height = c.last
"""
