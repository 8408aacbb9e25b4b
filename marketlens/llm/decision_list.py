"""Quality rules as a learned decision list (operator 6).

Each text is measured once. Sequential covering then learns an ordered list of rules from labelled rows:
a rule is a conjunction of thresholds on the measures that finds texts of low quality; conditions are
added while they gain information on one part of the labelled rows, and cut back on the other part; the
texts a rule covers are set aside and the next rule is grown on the rest. The list becomes one Spark
conditional expression, in order, that can be read.

The rules are fitted on a bounded sample of labelled rows (a parameter); texts are measured and judged
whole, all of them. A fixed base rule comes first: fewer than 50 words, or more than half of the words in
repeated three-word windows.

Defined results: a null, empty or wordless text measures 0 everywhere and fails the base rule; without
labelled rows of both kinds there is only the base rule; repeated rows each get a row; null ids are
never labelled; an empty table gives no rows. Only the columns named as parameters are read;
`good_documents` returns all columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .support import keep, text_key, without, workers_find_package
from .words import mixed, word_hashes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_lines", "n_distinct")
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Covering:
    labelled_rows: int = 40_000  # at most about so many labelled rows are fitted
    cuts: int = 48  # thresholds tried per measure
    conditions: int = 4  # per rule
    rules: int = 12
    precision: float = 0.9  # of a rule on the part it was not grown on
    support: int = 4  # texts a rule covers there


def measures_of(text: str) -> list[int]:
    """The counts of one text, in the order of COUNTS."""
    hashes = word_hashes(text.encode())  # of words between ASCII white space
    n = len(hashes)
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    repeated = 0
    if n > 3:
        windows = mixed(mixed(mixed(hashes[:-2]) + hashes[1:-1]) + hashes[2:])
        order = np.argsort(windows)
        equal = windows[order[1:]] == windows[order[:-1]]
        again = np.zeros(n - 2, dtype=bool)
        again[order[1:][equal]] = again[order[:-1][equal]] = True
        covered = np.zeros(n, dtype=bool)
        for k in range(3):
            covered[k : n - 2 + k] |= again
        repeated = int(covered.sum())
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    return [
        n, len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
        capitals, text.count("!"), len(lines), len(np.unique(hashes)),
    ]


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, text_key and the counts."""
    workers_find_package(docs.sparkSession)

    def measure(batches):
        for batch in batches:
            rows = [measures_of(t or "") for t in batch.column(1).to_pylist()]
            table = np.array(rows, dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(table[:, k]) for k in range(len(COUNTS)))],
                names=["id", "text_key", *COUNTS],
            )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), text_key(text_col).alias("k"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)]).add("text_key", "string")
    for name in COUNTS:
        schema = schema.add(name, T.LongType())
    return source.mapInArrow(measure, schema)


def shares() -> dict[str, Column]:
    """What rules may test: counts, and counts in proportion to a text's size."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "repeated_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / words,
        "capitals_per_char": F.col("n_capitals") / chars,
        "marks_per_word": F.col("n_marks") / words,
        "words_per_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
        "distinct_words": F.col("n_distinct") / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


Condition = tuple[int, bool, float]  # measure, whether above, threshold


def _holds(x: np.ndarray, rule: list[Condition]) -> np.ndarray:
    covered = np.ones(len(x), dtype=bool)
    for measure, above, threshold in rule:
        covered &= (x[:, measure] > threshold) == above
    return covered


def _grown(x: np.ndarray, bad: np.ndarray, how: Covering) -> list[Condition]:
    """Conditions one by one, each the one that gains most information about the bad rows."""
    rule: list[Condition] = []
    covered = np.ones(len(x), dtype=bool)
    while len(rule) < how.conditions:
        p, n = (covered & bad).sum(), (covered & ~bad).sum()
        if p < how.support or n == 0:
            break
        best, gain = None, 1e-9
        for measure in range(x.shape[1]):
            values = x[covered, measure]
            order = np.argsort(values, kind="stable")
            ordered, good_below = values[order], np.cumsum(~bad[covered][order])
            bad_below = np.cumsum(bad[covered][order])
            for cut in np.unique(np.quantile(values, np.linspace(0, 1, how.cuts + 2)[1:-1])):
                k = np.searchsorted(ordered, cut, side="right")
                if k == len(ordered) or k == 0:
                    continue
                threshold = float((ordered[k - 1] + ordered[k]) / 2)
                below = bad_below[k - 1], good_below[k - 1]
                for above, (q, m) in ((False, below), (True, (p - below[0], n - below[1]))):
                    if q < how.support:
                        continue
                    g = q * (np.log2(q / (q + m)) - np.log2(p / (p + n)))
                    if g > gain:
                        best, gain = (measure, above, threshold), g
        if best is None:
            break
        rule.append(best)
        covered &= _holds(x, [best])
    return rule


def _value(x: np.ndarray, bad: np.ndarray, rule: list[Condition]) -> float:
    covered = _holds(x, rule)
    p, n = (covered & bad).sum(), (covered & ~bad).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learned(x: np.ndarray, bad: np.ndarray, how: Covering = Covering()) -> list[list[Condition]]:
    """The rules, first one first. Row i of x belongs to the growing part unless i % 3 == 2."""
    rules: list[list[Condition]] = []
    left = np.ones(len(x), dtype=bool)
    grow_part = np.arange(len(x)) % 3 != 2
    while len(rules) < how.rules:
        grow, prune = left & grow_part, left & ~grow_part
        rule = _grown(x[grow], bad[grow], how)
        if not rule:
            break
        # Shorter beginnings of the rule that are at least as good on the other part replace it.
        cuts = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(cuts, key=lambda r: (_value(x[prune], bad[prune], r), -len(r)))
        covered = _holds(x, rule)
        p, n = (covered & prune & bad).sum(), (covered & prune & ~bad).sum()
        if p < how.support or p / (p + n) < how.precision:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def expression(rules: list[list[Condition]]) -> Column:
    """True for texts that no rule rejects: the rules in their order."""
    names, columns = list(shares()), shares()
    verdict = None
    for rule in rules:
        holds = F.lit(True)
        for measure, above, threshold in rule:
            value = columns[names[measure]]
            holds = holds & ((value > threshold) if above else (value <= threshold))
        verdict = F.when(holds, False) if verdict is None else verdict.when(holds, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def described(rules: list[list[Condition]]) -> list[str]:
    names = list(shares())
    return [" and ".join(f"{names[m]} {'>' if a else '<='} {t:.4g}" for m, a, t in rule) for rule in rules]


def judged(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Covering = Covering()
) -> DataFrame:
    """Per row: id, text_key, the counts, base_failed, kept."""
    rows = keep(measured(docs, id_col, text_col), "measures")
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col(id_col).alias("id"), "quality").distinct()
    known = keep(known.where("id is not null"), "known", "snappy")
    share = max(1, -(-known.count() // how.labelled_rows))
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).limit(2 * how.labelled_rows)
    # The list judges what passes the base rule, so it is fitted on that.
    fit = rows.join(F.broadcast(known), "id").where(~base_failed()).select("quality", F.array(*shares().values()).alias("x"))
    fit = sorted(fit.collect(), key=lambda r: r.x)  # at most 2 * labelled_rows rows
    rules = learned(np.array([r.x for r in fit]), np.array([r.quality == 0 for r in fit]), how) if fit else []
    failed = base_failed()
    judged = rows.withColumn("base_failed", failed).withColumn("kept", ~failed & expression(rules))
    return judged.withColumnRenamed("id", id_col)


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows the base rule and the list keep."""
    rejected = judged(docs, labels, id_col, text_col).where("not kept")
    return without(docs, rejected, id_col, text_col)


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs.select("doc_id", "text"), labels).select("doc_id", *COUNTS[:5], "base_failed", "kept")
