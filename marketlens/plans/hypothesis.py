"""Statistical tests as closed forms over small distributed aggregates.

Nothing is collected: group moments, value histograms and 2x2 counts carry all a test needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import distributions as D
from ..functions import expressions as X
from ..operators.ranking import counts_ahead_in_segments
from ..operators.shape import spread



def _moments(delivered: DataFrame) -> DataFrame:
    """Count, mean and sample variance of the review score, late (1) and on time (0), in one row.

    Scores are whole numbers, so the sums are exact.
    """
    score = F.col("review_score").cast("long")

    def parts(flag: Column, tag: str) -> list[Column]:
        mine = F.when(flag, score)
        return [
            F.count(mine).alias(f"n{tag}"),
            F.sum(mine).cast("double").alias(f"s{tag}"),
            F.sum(mine * mine).cast("double").alias(f"q{tag}"),
        ]

    sums = delivered.where("review_score IS NOT NULL").agg(
        *parts(F.col("is_late"), "1"), *parts(~F.col("is_late"), "0")
    )

    def finished(tag: str) -> list[Column]:
        n, s, q = F.col(f"n{tag}"), F.col(f"s{tag}"), F.col(f"q{tag}")
        variance = F.try_divide(q - F.try_divide(s * s, n), n - 1)
        return [n, F.try_divide(s, n).alias(f"mean{tag}"), variance.alias(f"var{tag}")]

    return sums.select(*finished("1"), *finished("0"))


def _welch(delivered: DataFrame) -> DataFrame:
    e1, e0 = F.try_divide(F.col("var1"), F.col("n1")), F.try_divide(F.col("var0"), F.col("n0"))
    t = F.try_divide(F.col("mean1") - F.col("mean0"), F.sqrt(e1 + e0))
    df = F.try_divide(
        (e1 + e0) * (e1 + e0),
        F.try_divide(e1 * e1, F.col("n1") - 1) + F.try_divide(e0 * e0, F.col("n0") - 1),
    )
    return _moments(delivered).withColumn("t", t).withColumn("df", df)


def welch_review_late(delivered: DataFrame) -> DataFrame:
    """Late against on-time review means, unequal variances."""
    return _welch(delivered).select(
        F.col("n1").alias("late_n"),
        X.rounded(F.col("mean1"), 6).alias("late_mean"),
        F.col("n0").alias("on_time_n"),
        X.rounded(F.col("mean0"), 6).alias("on_time_mean"),
        X.rounded(F.col("mean0") - F.col("mean1"), 6).alias("difference"),
        X.rounded(F.col("t"), 6).alias("t_stat"),
        X.rounded(F.col("df"), 4).alias("df"),
    )


def cohens_d(delivered: DataFrame) -> DataFrame:
    pooled = F.sqrt((F.col("var1") + F.col("var0")) / 2)
    d = F.try_divide(F.col("mean0") - F.col("mean1"), pooled)
    return _moments(delivered).select(X.rounded(d, 6).alias("cohens_d"))


def _mannwhitney(delivered: DataFrame) -> DataFrame:
    """U of the late sample and z with tie and continuity corrections, from the score histogram."""
    levels = (
        delivered.where("review_score IS NOT NULL AND is_late IS NOT NULL")
        .groupBy("review_score")
        .agg(
            F.count_if("is_late").cast("double").alias("late"),
            F.count(F.lit(1)).cast("double").alias("ties"),
        )
    )
    # One row per score on the 1..5 scale.
    ahead = F.sum("ties").over(W.orderBy("review_score")) - F.col("ties")
    ties = F.col("ties")
    sums = levels.withColumn("rank", ahead + (ties + 1) / 2).agg(
        F.sum("late").alias("n1"),
        F.sum("ties").alias("n"),
        F.sum(F.col("late") * F.col("rank")).alias("rank_sum"),
        F.sum(ties * ties * ties - ties).alias("tie_term"),
    )
    n1, n = F.col("n1"), F.col("n")
    n2 = n - n1
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    spread_ = F.sqrt(n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("tie_term"), n * (n - 1))))
    larger = F.greatest(u, n1 * n2 - u)
    z = F.try_divide(larger - n1 * n2 / 2 - 0.5, spread_)
    return sums.select(n1.alias("n1"), n2.alias("n2"), u.alias("u"), z.alias("z"))


def mannwhitney_review_late(delivered: DataFrame) -> DataFrame:
    return _mannwhitney(delivered).select(
        F.col("n1").cast("long").alias("late_n"),
        F.col("n2").cast("long").alias("on_time_n"),
        F.col("u").alias("u_stat"),
        X.rounded(F.col("z"), 6).alias("z_stat"),
    )


def late_repeat_crosstab(delivered: DataFrame, people: DataFrame) -> DataFrame:
    """First orders: late or not, by whether the person ever ordered again."""
    first = delivered.where((F.col("customer_order_number") == 1) & F.col("is_late").isNotNull())
    first = first.select("customer_unique_id", "is_late")
    counted = (
        first.join(people.select("customer_unique_id", "total_orders"), "customer_unique_id")
        .groupBy("is_late", (F.col("total_orders") > 1).alias("repeated"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = spread(counted, "is_late", "repeated", [False, True], F.sum("n")).fillna(0)
    return grid.select(
        "is_late", F.col("false").alias("did_not_return"), F.col("true").alias("returned")
    )


def _chi2(crosstab: DataFrame) -> DataFrame:
    def cell(late: bool, column: str) -> Column:
        return F.sum(F.when(F.col("is_late") == late, F.col(column))).cast("double")

    counts = crosstab.agg(
        cell(False, "did_not_return").alias("a"),
        cell(False, "returned").alias("b"),
        cell(True, "did_not_return").alias("c"),
        cell(True, "returned").alias("d"),
    )
    a, b, c, d = (F.col(x) for x in "abcd")
    n = a + b + c + d
    # Yates: the common deviation from the expected counts moves half a case towards zero.
    excess = F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0))
    chi2 = F.try_divide(n * excess * excess, (a + b) * (c + d) * (a + c) * (b + d))
    on_time = F.try_divide(b, a + b) * 100.0
    late = F.try_divide(d, c + d) * 100.0
    return counts.select(on_time.alias("on_time"), late.alias("late"), chi2.alias("chi2"))


def chi2_late_repeat(crosstab: DataFrame) -> DataFrame:
    drop = (F.lit(1.0) - F.try_divide(F.col("late"), F.col("on_time"))) * 100.0
    return _chi2(crosstab).select(
        X.rounded(F.col("on_time"), 4).alias("on_time_repeat_pct"),
        X.rounded(F.col("late"), 4).alias("late_repeat_pct"),
        X.rounded(drop, 4).alias("relative_drop_pct"),
        X.rounded(F.col("chi2"), 6).alias("chi2"),
    )


def _average_ranks(cells: DataFrame) -> DataFrame:
    """Average rank of each distinct value of each (measure, side): all of them in one seating."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("value")) for s in ("x", "y")])
    values = cells.select("measure", "n", F.inline(sides))
    levels = counts_ahead_in_segments(values, ["measure", "side"], "value", weight="n")
    rank = F.col("ahead") + (F.col("ties") + 1) / F.lit(2.0)
    return levels.select("measure", "side", "value", rank.alias("rank"))


def spearman(df: DataFrame, measures: list[str], against: str) -> DataFrame:
    """(measure, n, rho) for each measure against one column, over the rows where both are known.

    One pass counts the distinct value pairs of all measures; ranks and sums work on those counts. Pass
    a stored frame: it is read for the ranks and again for the sums.
    """
    pairs = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("x")) for m in measures]
    )
    cells = (
        df.select(F.col(against).cast("double").alias("y"), F.inline(pairs))
        .dropna()
        .groupBy("measure", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranks = _average_ranks(cells)

    def of(side: str) -> DataFrame:
        mine = ranks.where(F.col("side") == side)
        return mine.select("measure", F.col("value").alias(side), F.col("rank").alias(f"rank_{side}"))

    ranked = cells.join(of("x"), ["measure", "x"]).join(of("y"), ["measure", "y"])
    rx, ry, w = F.col("rank_x"), F.col("rank_y"), F.col("n")

    def sums(i: int, measure: str) -> list[Column]:
        parts = {"n": w, "xy": rx * ry * w, "xx": rx * rx * w, "yy": ry * ry * w}
        mine = F.col("measure") == measure
        return [F.sum(F.when(mine, x)).alias(f"{name}{i}") for name, x in parts.items()]

    def finished(i: int, measure: str) -> Column:
        n = F.col(f"n{i}").cast("double")
        # The ranks 1..n have mean (n + 1) / 2, ties or not.
        centre = n * (n + 1) * (n + 1) / 4
        xx, yy = (F.greatest(F.col(f"{c}{i}") - centre, F.lit(0.0)) for c in ("xx", "yy"))
        rho = F.try_divide(F.col(f"xy{i}") - centre, F.sqrt(xx) * F.sqrt(yy))
        known = F.coalesce(F.col(f"n{i}"), F.lit(0))
        return F.struct(F.lit(measure).alias("measure"), known.alias("n"), rho.alias("rho"))

    totals = ranked.agg(*[c for i, m in enumerate(measures) for c in sums(i, m)])
    return totals.select(F.inline(F.array(*[finished(i, m) for i, m in enumerate(measures)])))


DELIVERY_MEASURES = ["delivery_days", "days_vs_estimate"]


def spearman_delivery_review(delivered: DataFrame) -> DataFrame:
    """Rank correlation of delivery time, and of lateness, with the review score."""
    return spearman(delivered, DELIVERY_MEASURES, "review_score").withColumn(
        "rho", X.rounded(F.col("rho"), 6)
    )


def spearman_handling_late(sellers: DataFrame) -> DataFrame:
    return spearman(sellers, ["avg_handling_days"], "late_rate").select(
        "n", X.rounded(F.col("rho"), 6).alias("rho")
    )


def p_values(delivered: DataFrame, people: DataFrame, sellers: DataFrame) -> DataFrame:
    """One row per test: its statistic and two-sided p-value."""

    def row(name: str, frame: DataFrame, statistic: Column, p: Column) -> DataFrame:
        return frame.select(
            F.lit(name).alias("test"), statistic.alias("statistic"), p.alias("p_value")
        )

    def spearman_rows(frame: DataFrame, measures: list[str], against: str) -> DataFrame:
        freedom = (F.col("n") - 2).cast("double")
        rho = F.col("rho")
        t = rho * F.sqrt(F.try_divide(freedom, (1 - rho) * (1 + rho)))
        return spearman(frame, measures, against).select(
            F.concat(F.lit("spearman_"), "measure").alias("test"),
            rho.alias("statistic"),
            F.when(F.abs(rho) >= 1, 0.0).otherwise(D.p_student_t(t, freedom)).alias("p_value"),
        )

    welch, mw = _welch(delivered), _mannwhitney(delivered)
    chi2 = _chi2(late_repeat_crosstab(delivered, people))
    tests = [
        row("welch_review_late", welch, F.col("t"), D.p_student_t(F.col("t"), F.col("df"))),
        row("mannwhitney_review_late", mw, F.col("u"), F.least(D.p_normal(F.col("z")), F.lit(1.0))),
        row("chi2_late_repeat", chi2, F.col("chi2"), D.p_chi_square(F.col("chi2"))),
        spearman_rows(delivered, DELIVERY_MEASURES, "review_score"),
        spearman_rows(sellers, ["avg_handling_days"], "late_rate"),
    ]
    return reduce(DataFrame.unionByName, tests)
