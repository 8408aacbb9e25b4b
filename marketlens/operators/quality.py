"""Declared data checks: what may not be in a table, and two ways to look for it.

`offending` gives the rows that break a check, `compiled` the findings of all checks at once: every row
rule, count and sum of a table is one column of a single aggregation over it, and each key that has to be
unique costs one pass of its own. So a table is read once, plus once per key, however many checks it has.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import side_by_side

Table = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Never:
    """No row of a table may fulfil `broken`; offending rows are shown by these columns."""

    table: str
    broken: Column
    shown: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """One row per key. `also` counts further findings within a key; more than none breaks the check."""

    table: str
    keys: tuple[str, ...]
    also: Column | None = None


@dataclass(frozen=True)
class Measure:
    table: str
    value: Column  # an aggregate
    name: str


@dataclass(frozen=True)
class Equal:
    """Two aggregates of two tables, of one type, agree; both unknown agree too."""

    left: Measure
    right: Measure


Rule = Never | Unique | Equal


def _as_json(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _broken_keys(rule: Unique, df: DataFrame) -> DataFrame:
    also = F.lit(0) if rule.also is None else rule.also
    keys = df.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("n"), also.alias("also"))
    return keys.where((F.col("n") > 1) | (F.col("also") > 0)).drop("also")


def offending(rules: list[Rule], table: Table) -> DataFrame:
    """The rows that break any of the rules of one check; rules of one check show the same columns."""

    def rows(rule: Rule) -> DataFrame:
        if isinstance(rule, Never):
            return table(rule.table).where(rule.broken).select(*rule.shown)
        if isinstance(rule, Unique):
            return _broken_keys(rule, table(rule.table))
        sides = [table(m.table).agg(m.value.alias(m.name)) for m in (rule.left, rule.right)]
        return side_by_side(*sides).where(~F.col(rule.left.name).eqNullSafe(F.col(rule.right.name)))

    return reduce(DataFrame.unionAll, map(rows, rules))


def _finding(name: str, bad: Column, sample: Column, left: Column, right: Column) -> Column:
    values = {"check_name": F.lit(name), "bad_rows": bad, "sample": sample, "left": left, "right": right}
    return F.struct(*[c.alias(k) for k, c in values.items()])


def compiled(checks: dict[str, list[Rule]], table: Table) -> DataFrame:
    """One row per check: check_name, bad_rows and one offending row as JSON (the first in its order)."""
    none, nothing = F.lit(None).cast("string"), F.lit(0).cast("long")
    aggregates: dict[str, list[Column]] = defaultdict(list)
    findings: dict[str, list[Column]] = defaultdict(list)
    parts: list[DataFrame] = []
    shown = none

    def aggregate(name: str, value: Column) -> Column:
        at = f"a{len(aggregates[name])}"
        aggregates[name].append(value.alias(at))
        return F.col(at)

    for check, rules in checks.items():
        for rule in rules:
            if isinstance(rule, Never):
                bad = aggregate(rule.table, F.count_if(rule.broken))
                sample = aggregate(rule.table, F.min(F.when(rule.broken, _as_json(*rule.shown))))
                findings[rule.table].append(_finding(check, bad, sample, none, none))
            elif isinstance(rule, Unique):
                keys = _broken_keys(rule, table(rule.table))
                found = keys.agg(F.count(F.lit(1)).alias("bad"), F.min(_as_json(*keys.columns)).alias("sample"))
                parts.append(found.select(F.inline(F.array(_finding(check, F.col("bad"), F.col("sample"), none, none)))))
            else:
                for side, measure in (("left", rule.left), ("right", rule.right)):
                    value = aggregate(measure.table, measure.value)
                    both = {"left": none, "right": none, side: value.cast("string")}
                    findings[measure.table].append(_finding(check, nothing, none, both["left"], both["right"]))
    for name, columns in aggregates.items():
        parts.append(table(name).agg(*columns).select(F.inline(F.array(*findings[name]))))
    found = reduce(DataFrame.unionByName, parts).groupBy("check_name").agg(
        F.sum("bad_rows").alias("bad_rows"), F.min("sample").alias("sample"),
        F.max("left").alias("left"), F.max("right").alias("right"),
    )
    for check, rules in checks.items():
        for rule in rules:
            if isinstance(rule, Equal):
                unlike = (F.col("check_name") == check) & ~F.col("left").eqNullSafe(F.col("right"))
                values = _as_json(F.col("left").alias(rule.left.name), F.col("right").alias(rule.right.name))
                shown = F.when(unlike, values).otherwise(shown)
    differs = shown.isNotNull()
    return found.select(
        "check_name", F.when(differs, 1).otherwise(F.col("bad_rows")).cast("long").alias("bad_rows"),
        F.when(differs, shown).otherwise(F.col("sample")).alias("sample"),
    )
