"""The expected result of every query as one DuckDB statement over the test tables."""

from .analyses import ANALYSES
from .layers import CHAIN


def statements() -> dict[str, str]:
    prefix = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in CHAIN.items())
    return {name: f"{prefix}\n{body}" for name, body in ANALYSES.items()}
