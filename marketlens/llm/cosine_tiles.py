"""Near-duplicate vectors by PCA-ordered tiled comparison (operator 8).

Unit vectors are turned into the basis of their principal components, which leaves every cosine as it
is. Vectors are laid into tiles by a grid over the first components; two tiles are compared only if the
boxes around them come near enough. Within a pair of tiles the products of the leading components are added
first; by Cauchy-Schwarz the rest of a product is at most the product of the norms of the remaining
components, so pairs that cannot reach the threshold are given up, and the others go on.

A task holds two tiles of bounded size. It does not return pairs: each vector's number of links, and
those links that connect what the task has not yet seen connected. Equal vectors are one class from the
start, with a weight. The basis is fitted on a bounded sample (any orthogonal basis gives right results,
a good one is faster); everything is compared in double precision, and a pair so near the threshold that
the turned basis cannot decide is compared again as its vectors came.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; shorter vectors count as padded with zeros; repeated rows are equal vectors; a null id never
names a component unless no other id is in it; an empty table gives no rows. Only the columns named as
parameters are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .support import keep, workers_find_package

THRESHOLD = 0.9
TILE = 4096  # vectors of a tile
BLOCK = 1024  # vectors compared at once
AXES = 3  # components along which tiles are cut
SAMPLE = 20_000  # vectors that fit the basis
SAMPLE_BYTES = 64 << 20  # that they fill at most
SLACK = 1e-9  # of the bounds, against rounding


def unit(vector: list | None) -> np.ndarray | None:
    """The vector with length one; None if it can't have one."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    values = np.array(vector, dtype=np.float64)
    largest = np.abs(values).max()
    if not np.isfinite(largest) or largest == 0 or np.isnan(values).any():
        return None
    values = values / largest  # so that squares neither overflow nor vanish
    return values / np.sqrt((values * values).sum())


def basis(vectors: np.ndarray) -> np.ndarray:
    """Principal directions of unit vectors as columns, the one that explains most first."""
    if not len(vectors):
        return np.eye(vectors.shape[1])
    return np.linalg.eigh(vectors.T @ vectors)[1][:, ::-1].copy()


def stages(dims: int) -> list[int]:
    """Where accumulation pauses to give up pairs."""
    return sorted({min(dims, d) for d in (8, 16, 32, 64, 128, 256)} | {dims})


class Compared:
    """Links between two tiles (or within one)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, weight_a, weight_b, same: bool, threshold: float):
        self.a, self.b, self.same, self.threshold = a, b, same, threshold
        self.weights = weight_a, weight_b
        self.links = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        self.shift = 0 if same else len(a)
        self.label = np.arange(len(a) + (0 if same else len(b)))
        self.forest: list[tuple[int, int]] = []
        self.unsure: list[tuple[int, int]] = []
        self.pauses = stages(a.shape[1])

    def suffix(self, x: np.ndarray, at: int) -> np.ndarray:
        return np.sqrt((x[:, at:] ** 2).sum(axis=1))

    def block(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the linked pairs of two blocks."""
        x, y = self.a[i : i + BLOCK], self.b[j : j + BLOCK]
        done = self.pauses[0]
        product = x[:, :done] @ y[:, :done].T
        rows = columns = None
        for pause in [*self.pauses[1:], None]:
            left, right = self.suffix(x, done), self.suffix(y, done)
            if rows is None:
                open_ = product + left[:, None] * right[None, :] >= self.threshold - SLACK
                if open_.mean() < 0.05 or pause is None:
                    rows, columns = np.nonzero(open_)
                    product = product[rows, columns]
            else:
                open_ = product + left[rows] * right[columns] >= self.threshold - SLACK
                rows, columns, product = rows[open_], columns[open_], product[open_]
            if pause is None or (rows is not None and not len(rows)):
                break
            if rows is None:
                product = product + x[:, done:pause] @ y[:, done:pause].T
            else:
                product = product + np.einsum("ij,ij->i", x[rows, done:pause], y[columns, done:pause])
            done = pause
        if self.same and i == j:
            once = rows < columns
            rows, columns, product = rows[once], columns[once], product[once]
        # Rounding in the turned basis may not decide: such pairs are compared again as they came.
        unsure = np.abs(product - self.threshold) <= SLACK
        self.unsure += zip((rows[unsure] + i).tolist(), (columns[unsure] + j + self.shift).tolist())
        good = (product >= self.threshold) & ~unsure
        return rows[good] + i, columns[good] + j

    def connect(self, u: np.ndarray, v: np.ndarray) -> None:
        """Note the links that join parts not yet connected."""
        while True:
            a, b = self.label[u], self.label[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            # One link for each part that is the larger of two: these can't form a cycle.
            high, low = np.maximum(a, b), np.minimum(a, b)
            _, first = np.unique(high, return_index=True)
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            self.forest += zip(u[first].tolist(), v[first].tolist())
            while True:
                further = parent[parent]
                if (further == parent).all():
                    break
                parent = further
            self.label = parent[self.label]

    def run(self) -> None:
        weight_a, weight_b = self.weights
        for i in range(0, len(self.a), BLOCK):
            for j in range(i if self.same else 0, len(self.b), BLOCK):
                u, v = self.block(i, j)
                if len(u):
                    self.links[0][:] += np.bincount(u, weights=weight_b[v], minlength=len(self.a)).astype(np.int64)
                    self.links[1][:] += np.bincount(v, weights=weight_a[u], minlength=len(self.b)).astype(np.int64)
                    self.connect(u, v + self.shift)


def _classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Per row: id, place, digest and unit vector; digest and vector are null if it links with nothing."""
    workers_find_package(vectors.sparkSession)

    def normalise(batches):
        for batch in batches:
            units = [unit(v) for v in batch.column(1).to_pylist()]
            keys = [None if u is None else hashlib.md5(u.tobytes()).digest() for u in units]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array([None if u is None else u.tobytes() for u in units], pa.binary())],
                names=["id", "key", "unit"],
            )

    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)])
    rows = source.mapInArrow(normalise, schema.add("key", "binary").add("unit", "binary"))
    return keep(rows.withColumn("row", F.monotonically_increasing_id()), "units")


def _tiles(classes: DataFrame, total: int) -> DataFrame:
    """One row per tile: its number, box, and members as packed arrays. A tile has a bounded size."""
    spark = classes.sparkSession
    dims = classes.agg(F.max(F.octet_length("unit"))).first()[0] // 8
    wanted = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))
    share = max(1, total // wanted)
    some = classes.where(F.pmod(F.xxhash64("c"), F.lit(share)) == 0).select("unit").limit(2 * wanted).collect()
    padded = lambda data: np.pad(v := np.frombuffer(data), (0, dims - len(v)))
    turn = spark.sparkContext.broadcast(basis(np.stack([padded(r.unit) for r in some]) if some else np.zeros((0, dims))))

    def rotate(batches):
        for batch in batches:
            turned = np.stack([padded(x) for x in batch.column(2).to_pylist()]) @ turn.value
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(turned[:, :AXES].tolist(), pa.list_(pa.float64())),
                 pa.array([x.tobytes() for x in turned], pa.binary())],
                names=["c", "weight", "leading", "turned"],
            )

    rotated = keep(classes.select("c", "weight", "unit").mapInArrow(
        rotate, "c long, weight long, leading array<double>, turned binary"), "turned")
    # A grid over the leading components, so that the cuts along each are few and boxes exclude much.
    axes = min(AXES, dims)
    parts = max(1, round((-(-total // TILE)) ** (1 / axes)))
    parted = rotated.select("*", *(F.get("leading", F.lit(k)).alias(f"x{k}") for k in range(axes)))
    shares = [k / parts for k in range(1, parts)]
    cuts = parted.approxQuantile([f"x{k}" for k in range(axes)], shares, 0.2 / parts) if parts > 1 else [[]] * axes
    place = F.lit(0)
    for k, found in enumerate(cuts):
        for cut in sorted(set(found)):
            place = place + F.when(F.col(f"x{k}") >= cut, parts**k).otherwise(0)
    rotated = parted.withColumn("part", place).select("c", "weight", "turned", "part")
    # Many vectors at one place of the grid share a part: deal those out further.
    sizes = rotated.groupBy("part").agg(F.ceil(F.count("*") / TILE).alias("splits"))
    dealt = rotated.join(F.broadcast(sizes), "part").withColumn("split", F.pmod(F.xxhash64("c"), "splits"))

    def pack(table: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(table.column("turned").to_pylist())).reshape(len(table), dims)
        numbers = [table.column(k).to_numpy().astype("<i8").tobytes() for k in ("c", "weight")]
        return pa.table({
            "low": pa.array([x.min(axis=0).tolist()]), "high": pa.array([x.max(axis=0).tolist()]),
            "ids": pa.array([numbers[0]]), "weights": pa.array([numbers[1]]), "data": pa.array([x.tobytes()], pa.binary()),
        })

    tiles = dealt.groupBy("part", "split").applyInArrow(
        pack, "low array<double>, high array<double>, ids binary, weights binary, data binary"
    )
    return keep(tiles.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def _near(tiles: DataFrame, threshold: float) -> DataFrame:
    """Pairs of tiles (a <= b) whose boxes hold points near enough for a link."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))  # the distance of unit vectors at the threshold
    boxes = tiles.select("tile", "low", "high")
    cells = F.sequence(F.floor(F.get("low", F.lit(0)) / reach), F.floor((F.get("high", F.lit(0)) + reach) / reach))
    celled = boxes.select("*", F.explode(cells).alias("cell"))
    a = celled.select("cell", F.col("tile").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"))
    b = celled.select("cell", F.col("tile").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"))
    gap = F.zip_with(
        F.zip_with("la", "hb", lambda x, y: F.greatest(x - y, F.lit(0.0))),
        F.zip_with("lb", "ha", lambda x, y: F.greatest(x - y, F.lit(0.0))), lambda x, y: F.greatest(x, y),
    )
    apart = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    return a.join(b, "cell").where((F.col("a") <= F.col("b")) & (apart <= reach * reach + SLACK)).select("a", "b").distinct()


def _decided(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (u, v) those linked by the product of their unit vectors as they came, with their weights."""

    def compare(batches):
        for batch in batches:
            products = [
                float(np.dot(x[: len(y)], y[: len(x)]))
                for x, y in ((np.frombuffer(a), np.frombuffer(b)) for a, b in zip(*(batch.column(k).to_pylist() for k in (4, 5))))
            ]
            yield batch.filter(pa.array([p >= threshold for p in products], pa.bool_())).select([0, 1, 2, 3])

    def side(s: str) -> DataFrame:
        return classes.select(F.col("c").alias(s), F.col("weight").alias(f"weight_{s}"), F.col("unit").alias(f"unit_{s}"))

    met = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "weight_u", "weight_v", "unit_u", "unit_v")
    return met.mapInArrow(compare, "u long, v long, weight_u long, weight_v long")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: id, n_links, component_id (smallest id reachable by links), kept."""
    rows = _classes(vectors, id_col, vector_col)
    classes = keep(
        rows.where("key is not null").groupBy("key")
        .agg(F.min("row").alias("c"), F.min("id").alias("least_id"), F.count("*").alias("weight"), F.any_value("unit").alias("unit")),
        "classes",
    )
    total = classes.count()
    named = classes.select("key", "c", "least_id", "weight")
    if total:
        tiles = _tiles(classes, total)
        pairs = keep(_near(tiles, threshold), "tile-pairs")

        def compare(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    ids = [np.frombuffer(r[f"ids_{s}"], "<i8") for s in "ab"]
                    weights = [np.frombuffer(r[f"weights_{s}"], "<i8") for s in "ab"]
                    a, b = (np.frombuffer(r[f"data_{s}"]).reshape(len(i), -1) for s, i in zip("ab", ids))
                    same = r["a"] == r["b"]
                    found = Compared(a, b, *weights, same, threshold)
                    found.run()
                    everyone = ids[0] if same else np.concatenate(ids)
                    counted = found.links[0] + found.links[1] if same else np.concatenate(found.links)
                    linked = np.flatnonzero(counted)
                    ends = np.array(found.forest + found.unsure, dtype=np.int64).reshape(-1, 2)
                    u, v = everyone[ends[:, 0]], everyone[ends[:, 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([everyone[linked], u])),
                         pa.array([None] * len(linked) + v.tolist(), pa.int64()),
                         pa.array(counted[linked].tolist() + [None] * len(u), pa.int64()),
                         pa.array(np.arange(len(linked) + len(u)) >= len(linked) + len(found.forest))],
                        names=["u", "v", "links", "unsure"],
                    )

        def side(s: str) -> DataFrame:
            return tiles.select(F.col("tile").alias(s), *(F.col(k).alias(f"{k}_{s}") for k in ("ids", "weights", "data")))

        joined = pairs.join(side("a"), "a").join(side("b"), "b")
        found = keep(joined.mapInArrow(compare, "u long, v long, links long, unsure boolean"), "links")
        counted = found.where("v is null").select(F.col("u").alias("c"), "links")
        edges = found.where("v is not null AND NOT unsure").select("u", "v")
        unsure = found.where("unsure").select("u", "v")
        if not unsure.isEmpty():
            again = keep(_decided(unsure, classes, threshold), "decided")
            edges = edges.unionByName(again.select("u", "v"))
            for end, other in (("u", "weight_v"), ("v", "weight_u")):
                counted = counted.unionByName(again.select(F.col(end).alias("c"), F.col(other).alias("links")))
        links = counted.groupBy("c").agg(F.sum("links").alias("links"))
        label = components(edges)
        named = named.join(links, "c", "left").join(label.withColumnRenamed("id", "c"), "c", "left")
    else:
        named = named.withColumns({"links": F.lit(0).cast("long"), "component": F.lit(None).cast("long")})
    named = named.withColumn("component", F.coalesce("component", "c"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_key = named.join(least, "component").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links")
    )
    done = rows.select("id", "key").join(by_key, "key", "left").withColumns({
        "component_id": F.when(F.col("key").isNotNull(), F.col("component_id")).otherwise(F.col("id")),
        "n_links": F.coalesce("n_links", F.lit(0).cast("long")),
    })
    return done.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op8(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings.select("vec_id", "embedding"))


#: DuckDB: all pairs of usable vectors, then components by iteration.
SQL = """
WITH RECURSIVE usable AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS id, vec_id AS other FROM embeddings UNION SELECT r.id, l.v FROM reach r JOIN links l ON r.other = l.u),
least AS (SELECT id, min(other) AS c FROM reach GROUP BY id),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(n, 0) AS n_links, l.c AS component_id, e.vec_id = l.c AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.id LEFT JOIN counts k ON k.u = e.vec_id
"""
