"""The three table layers of one source, each table built once and kept as Parquet.

Raw tables and marts are written on first use to the shared folder, so every analysis starts from a
stored fact instead of repeating the joins behind it. Staging models are cheap projections and stay
lazy. Paths, not DataFrames, are remembered: any session of the application may read them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .config import Settings
from .plans import marts, staging
from .session import CODEC, scratch_path

RAW = (
    "customers", "geolocation", "order_items", "order_payments", "order_reviews", "orders",
    "products", "sellers", "category_translation",
)
STAGING = (
    "stg_customers", "stg_order_items", "stg_orders", "stg_payments", "stg_products",
    "stg_reviews", "stg_sellers",
)
# In build order: a mart only needs those before it.
MARTS = (
    "dim_date", "dim_customers", "dim_products", "dim_sellers", "fct_order_items", "fct_orders",
    "customer_rfm", "seller_scorecard",
)
RAW_INPUTS = {
    "dim_date": ("orders",),
    "dim_customers": ("orders", "customers"),
    "dim_products": ("products", "category_translation"),
    "dim_sellers": ("sellers",),
    "fct_order_items": ("orders", "customers", "order_items"),
    "fct_orders": ("orders", "customers", "order_items", "order_payments", "order_reviews"),
}
# The marts that a mart is made from; all others need only the raw tables.
MART_INPUTS = {
    "customer_rfm": ("fct_orders",),
    "seller_scorecard": ("fct_order_items", "fct_orders", "dim_sellers"),
}
JOBS_AT_ONCE = 4


def mart_waves() -> list[tuple[str, ...]]:
    """The marts in waves: those of a wave need only earlier waves, so their jobs may run together."""
    order = TopologicalSorter({name: MART_INPUTS.get(name, ()) for name in MARTS})
    order.prepare()
    waves = []
    while order.is_active():
        waves.append(tuple(sorted(order.get_ready())))
        order.done(*waves[-1])
    return waves


def together(get: Callable[[str], object], names: Iterable[str]) -> list:
    """Work on tables that do not need each other: their jobs are submitted at the same time and share
    the executors."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return list(pool.map(get, names))


def staging_model(name: str, raw: Callable[[str], DataFrame], settings: Settings) -> DataFrame:
    if name == "stg_products":
        return staging.stg_products(raw("products"), raw("category_translation"), settings)
    source = {"stg_payments": "order_payments", "stg_reviews": "order_reviews"}.get(name, name[4:])
    return getattr(staging, name)(raw(source))


def mart_model(
    name: str,
    stg: Callable[[str], DataFrame],
    mart: Callable[[str], DataFrame],
    settings: Settings,
) -> DataFrame:
    match name:
        case "dim_date":
            return marts.dim_date(stg("stg_orders"), settings)
        case "dim_customers":
            return marts.dim_customers(stg("stg_orders"), stg("stg_customers"))
        case "dim_products":
            return marts.dim_products(stg("stg_products"))
        case "dim_sellers":
            return marts.dim_sellers(stg("stg_sellers"))
        case "fct_order_items":
            return marts.fct_order_items(
                stg("stg_order_items"), stg("stg_orders"), stg("stg_customers")
            )
        case "fct_orders":
            return marts.fct_orders(
                stg("stg_orders"), stg("stg_customers"), stg("stg_order_items"),
                stg("stg_payments"), stg("stg_reviews"), settings,
            )
        case "customer_rfm":
            return marts.customer_rfm(mart("fct_orders"), settings)
        case "seller_scorecard":
            return marts.seller_scorecard(
                mart("fct_order_items"), mart("fct_orders"), mart("dim_sellers"), settings
            )
    raise KeyError(name)


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        sources: dict[str, Callable[[], DataFrame]],
        settings: Settings,
        stored_raw: tuple[str, ...] = RAW,
        written: dict[str, tuple[str, StructType]] | None = None,
    ):
        """`stored_raw` names the raw tables worth storing; the others are cheap to read again."""
        self.spark = spark
        self.stored_raw = stored_raw
        self.sources = sources
        self.settings = settings
        self._written = {} if written is None else written

    def stored(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        if label not in self._written:
            df = build()
            path = scratch_path(self.spark, label)
            df.write.option("compression", CODEC).parquet(path)
            self._written[label] = (path, df.schema)
        path, schema = self._written[label]
        return self.spark.read.schema(schema).parquet(path)

    def raw(self, name: str) -> DataFrame:
        if name not in self.stored_raw:
            return self.sources[name]()
        return self.stored(f"raw.{name}", self.sources[name])

    def stg(self, name: str) -> DataFrame:
        return staging_model(name, self.raw, self.settings)

    def mart_model(self, name: str) -> DataFrame:
        """The mart as a plan over the layers below it, not its stored copy."""
        return mart_model(name, self.stg, self.mart, self.settings)

    def mart(self, name: str) -> DataFrame:
        if f"marts.{name}" not in self._written:
            inputs = [t for t in RAW_INPUTS.get(name, ()) if t in self.stored_raw]
            together(self.raw, inputs)
        return self.stored(f"marts.{name}", lambda: self.mart_model(name))

    def load(self) -> None:
        together(self.raw, self.stored_raw)

    def build(self) -> None:
        """Store the raw tables worth it and all marts."""
        self.load()
        for wave in mart_waves():
            together(self.mart, wave)

    def layers(self, names: Iterable[str] = ("raw", "staging", "marts")) -> dict:
        """Layer -> table name -> DataFrame."""
        members = {"raw": (RAW, self.raw), "staging": (STAGING, self.stg), "marts": (MARTS, self.mart)}
        return {
            layer: {table: get(table) for table in tables}
            for layer, (tables, get) in members.items()
            if layer in names
        }
