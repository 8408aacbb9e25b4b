"""Quality classifier as a sparse rule ensemble (operator 12).

Shallow regression trees are boosted on labelled rows; every path from a root to any of its nodes is a
rule, a conjunction of thresholds on statistics of the text. A logistic model with an absolute-value
penalty gives each rule a weight and most of them none; the penalty is the strongest one whose deviance
on rows kept aside is within `RuleEnsemble.slack` of the best. The rules that are left are compiled into
one Spark column expression, so scoring is a sum of conditions that can be read.

Trees and weights are fitted on a bounded sample of labelled rows (a parameter); texts are measured and
scored whole, all of them. Ids, labels, language and source are no inputs of a score.

Defined results: null, empty and wordless texts measure 0 and are scored like all others; an id labelled
both ways, or null, is not learned from; without labels of both kinds the score is the share of label 1,
0.5 without any; repeated rows each get a row; an empty table gives no rows. Only the columns named as
parameters are read, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decision_list import measured, shares
from .support import keep


@dataclass(frozen=True)
class RuleEnsemble:
    labelled_rows: int = 20_000  # at most twice as many labelled rows are fitted, about as many on average
    trees: int = 40
    depth: int = 3  # conditions of a rule at most
    shrinkage: float = 0.2
    cuts: int = 64  # thresholds tried per statistic
    leaf: int = 10  # rows in a node at least
    penalties: int = 16  # tried, from all weights zero downwards
    rounds: int = 300  # of descent per penalty
    slack: float = 0.01  # share of deviance given up for fewer rules


Condition = tuple[int, bool, float]  # statistic, whether above, threshold
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Model:
    base: float  # log odds
    weights: tuple[tuple[Rule, float], ...] = ()


def holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    covered = np.ones(len(x), dtype=bool)
    for statistic, above, threshold in rule:
        covered &= (x[:, statistic] > threshold) == above
    return covered


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _thresholds(x: np.ndarray, cuts: int) -> list[np.ndarray]:
    """Per statistic the values to cut at: between neighbouring quantiles, so no row lies on one."""
    found = []
    for values in x.T:
        points = np.unique(np.quantile(values, np.linspace(0, 1, cuts + 1), method="lower"))
        above = np.unique(values)
        following = above[np.minimum(np.searchsorted(above, points, side="right"), len(above) - 1)]
        found.append(((points + following) / 2)[points < following])
    return found


def _split(bins: np.ndarray, residual: np.ndarray, curve: np.ndarray, thresholds, leaf: int):
    """The (statistic, cut) that lowers the deviance most; None if none does."""
    total, weight = residual.sum(), curve.sum()
    best, gain = None, 1e-6
    for statistic, cuts in enumerate(thresholds):
        size = len(cuts) + 1
        below = [np.cumsum(np.bincount(bins[:, statistic], w, size))[:-1] for w in (residual, curve, None)]
        rest = (total - below[0]) ** 2 / (weight - below[1] + 1) + below[0] ** 2 / (below[1] + 1)
        rest[(below[2] < leaf) | (len(bins) - below[2] < leaf)] = -1
        if len(cuts) and rest.max() - total**2 / (weight + 1) > gain:
            best, gain = (statistic, int(rest.argmax())), rest.max() - total**2 / (weight + 1)
    return best


def simplified(path: list[Condition]) -> Rule:
    """At most one lower and one upper threshold per statistic, in a fixed order."""
    tight: dict[tuple[int, bool], float] = {}
    for statistic, above, threshold in path:
        key = statistic, above
        tight[key] = threshold if key not in tight else (max if above else min)(tight[key], threshold)
    return tuple((s, a, t) for (s, a), t in sorted(tight.items()))


def tree_rules(x: np.ndarray, y: np.ndarray, how: RuleEnsemble) -> list[Rule]:
    """The paths to all nodes of the boosted trees, each once, in the order of their first occurrence."""
    thresholds = _thresholds(x, how.cuts)
    # Bin k holds the values between cuts k - 1 and k, so "above cut k" is bin > k.
    bins = np.stack([np.searchsorted(cuts, values, side="left") for cuts, values in zip(thresholds, x.T)], axis=1)
    share = y.mean()
    z = np.full(len(y), np.log(share / (1 - share)))
    rules: dict[Rule, None] = {}
    for _ in range(how.trees):
        p = _sigmoid(z)
        residual, curve = y - p, p * (1 - p)
        open_: list[tuple[np.ndarray, list[Condition]]] = [(np.arange(len(y)), [])]
        while open_:
            rows, path = open_.pop()
            cut = None
            if len(path) < how.depth and len(rows) >= 2 * how.leaf:
                cut = _split(bins[rows], residual[rows], curve[rows], thresholds, how.leaf)
            if path:
                rules.setdefault(simplified(path))
            if cut is None:
                z[rows] += how.shrinkage * residual[rows].sum() / (curve[rows].sum() + 1)
                continue
            statistic, k = cut
            threshold = float(thresholds[statistic][k])
            above = bins[rows, statistic] > k
            open_ += [(rows[above], [*path, (statistic, True, threshold)]), (rows[~above], [*path, (statistic, False, threshold)])]
    return list(rules)


def _deviance(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def _descended(r: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray, step: float, rounds: int) -> np.ndarray:
    """Accelerated proximal gradient; the first column is the constant and is not penalised."""
    w, ahead, t = start, start, 1.0
    for _ in range(rounds):
        moved = ahead - step * (r.T @ (_sigmoid(r @ ahead) - y)) / len(y)
        moved[1:] = np.sign(moved[1:]) * np.maximum(np.abs(moved[1:]) - step * penalty, 0)
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, change = moved + (t - 1) / following * (moved - w), np.abs(moved - w).max()
        w, t = moved, following
        if change < 1e-5:
            break
    return w


def lasso(r: np.ndarray, y: np.ndarray, aside: np.ndarray, how: RuleEnsemble) -> np.ndarray:
    """Weights of the columns of `r` and the constant in front; `aside` marks the rows that pick the penalty."""
    spread = np.maximum(r.std(axis=0), 1e-3)
    design = np.column_stack([np.ones(len(r)), r / spread])
    fit, held = design[~aside], design[aside]
    norm = float(np.linalg.norm(fit.T @ fit / len(fit), 2))
    step = 4 / max(norm, 1e-9)
    share = np.clip(y[~aside].mean(), 1e-3, 1 - 1e-3)
    w = np.zeros(design.shape[1])
    w[0] = np.log(share / (1 - share))
    strongest = np.abs(fit[:, 1:].T @ (y[~aside] - share)).max(initial=0) / len(fit)
    tried = []
    for penalty in strongest * np.geomspace(1, 1e-3, how.penalties):
        w = _descended(fit, y[~aside], penalty, w, step, how.rounds)
        tried.append((_deviance(held @ w, y[aside]), w))
    least = min(d for d, _ in tried)
    chosen = next(w for d, w in tried if d <= least * (1 + how.slack))
    return np.concatenate([chosen[:1], chosen[1:] / spread])


def learned(x: np.ndarray, y: np.ndarray, how: RuleEnsemble = RuleEnsemble()) -> Model:
    """x: statistics per row, y: 1 or 0. Every fourth row picks the penalty; rows come in a fixed order."""
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    if len(y) < 4 * how.leaf or y.min() == y.max():
        share = y.mean() if len(y) else 0.5
        return Model(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    aside = np.arange(len(y)) % 4 == 3
    rules = tree_rules(x[~aside], y[~aside], how)
    if not rules:
        return Model(float(np.log(share / (1 - share))))
    held = np.column_stack([holds(x, rule) for rule in rules]).astype(np.float64)
    w = lasso(held, y.astype(float), aside, how)
    return Model(float(w[0]), tuple((rule, float(v)) for rule, v in zip(rules, w[1:]) if v))


def expression(model: Model, statistics: list[Column]) -> Column:
    """The score as a column: the logistic function of the weights of the rules that hold."""
    odds = F.lit(model.base)
    for rule, weight in model.weights:
        met = F.lit(True)
        for statistic, above, threshold in rule:
            value = statistics[statistic]
            met = met & ((value > threshold) if above else (value <= threshold))
        odds = odds + F.when(met, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def described(model: Model) -> list[str]:
    names = list(shares())
    return [
        f"{weight:+.3f} if " + " and ".join(f"{names[s]} {'>' if a else '<='} {t:.4g}" for s, a, t in rule)
        for rule, weight in sorted(model.weights, key=lambda r: -abs(r[1]))
    ]


def fitted(rows: DataFrame, labels: DataFrame, id_col: str, label_col: str, learnable: Column, how: RuleEnsemble) -> Model:
    """The model of the measured `rows` (id, counts) whose label counts: `learnable` is a condition on `id`."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("id").isNotNull() & learnable).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other"))
    known = keep(known.where("y = other").drop("other"), "known", "snappy")
    share = max(1, -(-known.count() // how.labelled_rows))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).limit(2 * how.labelled_rows)
    fit = rows.join(F.broadcast(sample), "id").select("y", F.array(*shares().values()).alias("x")).limit(2 * how.labelled_rows)
    found = sorted(((r.x, r.y) for r in fit.collect()))  # a fixed order, whatever the partitions
    return learned(np.array([x for x, _ in found], dtype=float).reshape(-1, len(shares())), np.array([y for _, y in found]), how)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    learnable: Column | None = None,
    how: RuleEnsemble = RuleEnsemble(),
) -> DataFrame:
    """Per row: id, text_key, the counts, score. `learnable`: which ids (column `id`) labels count for."""
    rows = keep(measured(docs, id_col, text_col), "statistics")
    model = fitted(rows, labels, id_col, label_col, F.lit(True) if learnable is None else learnable, how)
    return rows.withColumn("score", expression(model, list(shares().values()))).withColumnRenamed("id", id_col)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def op12(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(docs.select("doc_id", "text"), labels, learnable=~held_out(F.col("id")))
    predicted = (F.col("score") >= 0.3).cast("int")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
