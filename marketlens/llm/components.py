"""Connected components of an edge list, as joins."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import few, keep

FEW_LABELS = 1_000_000  # 16 MB; beyond that labels are shuffled


def _sender(labels: DataFrame):
    """How labels, and others of no more rows, go into a join."""
    return F.broadcast if few(labels, FEW_LABELS) else (lambda df: df)


def _ends(labels: DataFrame, sent, rounds: int) -> DataFrame:
    """Labels followed to their ends: each round looks up the label of the label, twice as far, and only ids
    whose label has moved go on."""
    ended, going = [], labels
    for _ in range(rounds):
        known = functools.reduce(DataFrame.unionByName, [*ended, going])
        further = known.select(F.col("id").alias("component"), F.col("component").alias("further"))
        after = going.join(sent(further), "component").select(
            "id", F.col("further").alias("component"), (F.col("further") != F.col("component")).alias("moved")
        )
        after = keep(after, "labels", "snappy")
        ended.append(after.where("NOT moved").select("id", "component"))
        going = after.where("moved").select("id", "component")
        if going.isEmpty():
            return functools.reduce(DataFrame.unionByName, ended)
    raise RuntimeError(f"labels did not end in {rounds} rounds")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id of the edges (u, v): the smallest id it is connected with.

    Each round labels every id with its smallest neighbour, follows the labels to their ends, and goes on
    with the edges between different ends only, so an edge within one component is met once or twice
    however many rounds the others need. An id that no neighbour takes as its label has neighbours with
    smaller ends, so two rounds leave at most half of the ids.
    """
    ends = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    edges = keep(edges.select(*ends).distinct(), "edges", "snappy")
    steps, sent = [], None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        labels = both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("component"))
        labels = keep(labels, "labels", "snappy")
        sent = sent or _sender(labels)
        steps.append(_ends(labels, sent, rounds))
        edges = keep(_between(edges, steps[-1], sent, "inner").distinct(), "edges", "snappy")
        if edges.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    labels = steps.pop()
    while steps:
        labels = keep(_relabelled(steps.pop(), labels, sent), "labels", "snappy")
    return labels


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The components once `edges` join those of `labels`, as `components` of all edges would give them;
    only the edges between different components are followed."""
    if labels is None:
        return components(edges)
    sent = _sender(labels)
    between = keep(_between(edges, labels, sent, "left").distinct(), "edges", "snappy")
    if between.isEmpty():
        return labels
    further = components(between)
    new = further.join(sent(labels.select("id")), "id", "left_anti")
    return keep(_relabelled(labels, further, _sender(further)).unionByName(new), "labels", "snappy")


def _between(edges: DataFrame, labels: DataFrame, sent, how: str) -> DataFrame:
    """The edges as pairs (u < v) of the labels of their ends, where these differ; an id without a label is its own."""
    for end in ("u", "v"):
        edges = edges.join(sent(labels.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))), end, how)
    u, v = F.coalesce("of_u", "u"), F.coalesce("of_v", "v")
    return edges.where(u != v).select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))


def _relabelled(labels: DataFrame, further: DataFrame, sent) -> DataFrame:
    """`labels` with each component replaced by its own component in `further`, if it has one."""
    further = further.select(F.col("id").alias("component"), F.col("component").alias("further"))
    return labels.join(sent(further), "component", "left").select(
        "id", F.coalesce("further", "component").alias("component")
    )
