"""SQL fragments used by many statements."""


def rnd(x: str, digits: int) -> str:
    """Decimal rounding, half away from zero."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def total(x: str, where: str = "") -> str:
    """Exact money sum."""
    return f"SUM({dec(x)})" + (f" FILTER (WHERE {where})" if where else "")


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def units(x: str) -> str:
    """Money sum rounded to whole units."""
    return f"CAST(round({x}, 0) AS DOUBLE)"


def mean_money(x: str) -> str:
    return f"({dbl(total(x))} / nullif(count({x}), 0))"


def pct(part: str, whole: str, digits: int) -> str:
    return rnd(f"{dbl(part)} * 100.0 / nullif({dbl(whole)}, 0)", digits)


def hours(start: str, end: str) -> str:
    """Hour boundaries crossed."""
    return f"date_diff('hour', {start}, {end})"
