"""The queries opN_<name>: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from . import (
    chosen_path, cosine_tiles, decision_list, merkle, packing, permuterm, prefix_counts, rule_ensemble, sanitise, sharding, tree_bpe,
    warc, weak_labels,
)
from .support import table, workers_find_package

Query = Callable[[SparkSession, str], DataFrame]


def _over(*names_and_operator) -> Query:
    """A query that applies an operator to the named tables of a folder."""
    *names, operator = names_and_operator

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        workers_find_package(spark)
        return operator(*(table(spark, sf_dir, name) for name in names))

    return query


def queries() -> dict[str, Query]:
    return {
        "op1_sanitise": _over("documents", sanitise.op1),
        "op2_prefix_counts": _over("documents", prefix_counts.op2),
        "op3_sharding": _over("documents", sharding.op3),
        "op4_warc": _over("pages", warc.op4),
        "op5_chosen_path": _over("documents", chosen_path.op5),
        "op6_decision_list": _over("documents", "labels", decision_list.op6),
        "op7_weak_labels": _over("documents", "labels", weak_labels.op7),
        "op8_cosine_tiles": _over("embeddings", cosine_tiles.op8),
        "op9_packing": _over("documents", packing.op9),
        "op10_tree_bpe": _over("documents", tree_bpe.op10),
        "op11_permuterm": _over("documents", permuterm.op11),
        "op12_rule_ensemble": _over("documents", "labels", rule_ensemble.op12),
        "op13_merkle": _over("documents", merkle.op13),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": warc.SQL,
        "op5_chosen_path": chosen_path.SQL,
        "op8_cosine_tiles": cosine_tiles.SQL,
        "op11_permuterm": permuterm.SQL,
        "op13_merkle": merkle.SQL,
    }
