"""Column expressions with the exact semantics the analyses depend on.

Dates: differences count calendar boundaries crossed. Money: summed as whole cents in a long, which
is exact in any order and stays in the fast aggregation path. Rounding: decimal, half away from zero.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rows() -> Column:
    return F.count(F.lit(1))


def cents(amount: str | Column) -> Column:
    return F.rint(_col(amount) * 100).cast("long")


def money(whole_cents: Column) -> Column:
    return whole_cents / F.lit(100.0)


def sum_cents(amount: str | Column) -> Column:
    return F.sum(cents(amount))


def sum_money(amount: str | Column) -> Column:
    return money(sum_cents(amount))


def mean_fixed(value: str | Column, decimals: int) -> Column:
    """Average of the non-NULL values of a column with that many decimals; order independent."""
    scale = 10**decimals
    whole = F.sum(F.rint(_col(value) * scale).cast("long"))
    return ratio(whole / F.lit(float(scale)), F.count(_col(value)))


def mean_money(amount: str | Column) -> Column:
    return mean_fixed(amount, 2)


def whole_units(whole_cents: Column) -> Column:
    """Cents rounded to whole currency units."""
    return F.round(whole_cents, -2) / F.lit(100.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL instead of an error on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return rounded(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def rounded(x: Column, digits: int) -> Column:
    return F.round(x.cast("decimal(38,10)"), digits).cast("double")


def share_true(flag: str | Column) -> Column:
    """Average of a boolean as 0/1; NULLs are left out of both sides."""
    return F.avg(_col(flag).cast("int"))


def date_lit(d: date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def ts_lit(d: date) -> Column:
    return F.lit(d.isoformat()).cast("timestamp_ntz")


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(_col(end), _col(start)).cast("long")


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Hour boundaries crossed, independent of any time zone."""
    start, end = _col(start), _col(end)
    return (F.datediff(end, start) * 24 + F.hour(end) - F.hour(start)).cast("long")


def months_between_starts(start: Column, end: Column) -> Column:
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("long")


def month_start(day: str | Column) -> Column:
    return F.trunc(_col(day).cast("date"), "month")


def month_text(day: str | Column) -> Column:
    return F.date_format(_col(day), "yyyy-MM")


def iso_weekday(day: str | Column) -> Column:
    return (F.weekday(_col(day)) + 1).cast("long")


def ladder(*steps: tuple[Column, str], otherwise: str | None = None) -> Column:
    """First matching label; a NULL condition falls through to the next step."""
    (condition, label), *rest = steps
    chain = F.when(condition, label)
    for condition, label in rest:
        chain = chain.when(condition, label)
    return chain if otherwise is None else chain.otherwise(otherwise)
