"""The batch job: load raw tables, build staging and marts, run the checks, write the extracts.

    spark-submit run_build.py --csv /data/raw --out /shared/warehouse
    python run_build.py --standin /root/testdata/sf0.01 --out /tmp/out

A run writes the raw tables and the marts to a new version under --out/versions, marts that do not need
each other at the same time; staging models are views. Only when all checks of the version pass do the
tables of the layer databases point to it. So a check that finds offending rows (exit status 1) leaves
the tables as they were, and the rejected version can be looked at.
"""

from __future__ import annotations

import argparse
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import STANDIN, Settings
from ..functions import expressions as X
from ..plans import checks, extracts
from ..session import configure, make_folder, release, remove, shared_dir, size_shuffles, subfolders
from ..sources import catalog
from ..sources.csv_files import load_raw
from ..sources.standin import standin_sources
from ..warehouse import MARTS, RAW, STAGING, mart_model, mart_waves, staging_model, together

MONTHLY_FACTS = ("fct_orders", "fct_order_items")


class CheckFailure(Exception):
    """At least one data check found offending rows."""


@dataclass
class Report:
    rows: dict[str, int]
    checks: list[tuple[str, int, str | None]]
    extracts: dict[str, tuple[int, int]]

    @property
    def failed(self) -> list[str]:
        return [name for name, bad, _ in self.checks if bad]

    def lines(self) -> list[str]:
        out = [f"table={name} rows={n}" for name, n in self.rows.items()]
        out += [f"check={name} findings={bad}" + (f" first={sample}" if bad else "") for name, bad, sample in self.checks]
        return out + [f"extract={name} rows={n} bytes={size}" for name, (n, size) in self.extracts.items()]


def by_month(fact: DataFrame) -> DataFrame:
    """Spread a fact so that each task writes few months and a busy month is written by many."""
    month = fact.withColumn("order_month", X.month_text("order_date"))
    return month.repartitionByRange(F.col("order_month"), F.col("order_id"))


class Build:
    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, Callable[[], DataFrame]],
        settings: Settings,
        root: str,
        prefix: str = "",
        monthly_facts: bool = False,
        retained: int = 2,
    ):
        """`monthly_facts` partitions both facts by order month; use it when months are large. `retained`
        published versions stay, the newest included."""
        self.spark = configure(spark)
        shared_dir(spark)  # a cluster without a shared folder fails here, before anything is written
        self.sources, self.settings = raw, settings
        self.root, self.prefix, self.monthly_facts = root.rstrip("/"), prefix, monthly_facts
        self.retained = retained
        self.version = f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        self.rows: dict[str, int] = {}

    def table(self, layer: str, name: str) -> DataFrame:
        """A published table, or a staging view of this run."""
        if layer == "staging":
            return self._stg(name)
        return self.spark.table(f"{self.prefix}{layer}.{name}")

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/versions/{self.version}/{layer}/{name}"

    def _candidate(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(layer, name))

    def _write(self, layer: str, name: str, df: DataFrame) -> None:
        month = None
        if self.monthly_facts and name in MONTHLY_FACTS:
            df, month = by_month(df), "order_month"
        catalog.write_version(df, self._path(layer, name), month)
        self.rows[f"{layer}.{name}"] = self._candidate(layer, name).count()

    def load(self) -> None:
        together(lambda name: self._write("raw", name, self.sources[name]()), RAW)

    def models(self) -> None:
        for name in STAGING:
            self._stg(name).createOrReplaceTempView(f"{self.prefix}staging_{name}")
            self.rows[f"staging.{name}"] = self._stg(name).count()
        for wave in mart_waves():
            together(lambda name: self._write("marts", name, self._model(name)), wave)

    def _model(self, name: str) -> DataFrame:
        return mart_model(name, self._stg, self._mart, self.settings)

    def _raw(self, name: str) -> DataFrame:
        return self._candidate("raw", name)

    def _stg(self, name: str) -> DataFrame:
        return staging_model(name, self._raw, self.settings)

    def _mart(self, name: str) -> DataFrame:
        return self._candidate("marts", name)

    def run_checks(self) -> list[tuple[str, int, str | None]]:
        found = checks.run_checks(self._raw, self._stg, self._mart)
        return [tuple(row) for row in found.orderBy("check_name").collect()]

    def publish(self) -> None:
        """Point the tables to this version, raw first. Rejected versions and all but the last published ones
        are removed, so a query that began before the publication can go on."""
        catalog.create_layers(self.spark, self.root, self.prefix)
        for layer, names in (("raw", RAW), ("marts", MARTS)):
            for name in names:
                catalog.point_to(self.spark, f"{self.prefix}{layer}.{name}", self._path(layer, name))
        published = f"{self.root}/published"
        make_folder(self.spark, f"{published}/{self.version}")
        known = subfolders(self.spark, published)
        for version in subfolders(self.spark, f"{self.root}/versions"):
            if version < self.version and version not in known[-self.retained :]:
                remove(self.spark, f"{self.root}/versions/{version}")
        for version in known[: -self.retained]:
            remove(self.spark, f"{published}/{version}")

    def export(self) -> dict[str, tuple[int, int]]:
        orders, people = self._mart("fct_orders"), self._mart("dim_customers")
        frames = {
            "orders": extracts.export_orders(orders, self.settings),
            "items": extracts.export_items(
                self._mart("fct_order_items"), self._mart("dim_products"),
                self._mart("dim_sellers"), people, self.settings,
            ),
            "rfm": extracts.export_rfm(self._mart("customer_rfm"), people),
            "sellers": extracts.export_sellers(self._mart("seller_scorecard")),
        }
        return {
            name: catalog.write_extract(df, f"{self.root}/extracts/{name}")
            for name, df in frames.items()
        }

    def run(self) -> Report:
        """Load, build, check, publish, export. After a failed check nothing is published or exported."""
        self.load()
        self.models()
        report = Report(self.rows, self.run_checks(), {})
        if report.failed:
            raise CheckFailure("\n".join([f"rejected version {self.version}: {', '.join(report.failed)}", *report.lines()]))
        self.publish()
        report.extracts = self.export()
        return report


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--csv", help="folder of the nine raw CSV files")
    source.add_argument("--standin", help="folder of the generic test tables")
    parser.add_argument("--out", required=True, help="root folder of the layers and extracts")
    parser.add_argument("--prefix", default="", help="prefix of the layer databases")
    parser.add_argument("--monthly-facts", action="store_true")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("marketlens-build").getOrCreate()
    size_shuffles(spark, options.csv or options.standin)
    if options.csv:
        frames = load_raw(spark, options.csv)
        raw, settings = {name: (lambda df=df: df) for name, df in frames.items()}, Settings()
    else:
        raw, settings = standin_sources(spark, options.standin), STANDIN
    job = Build(spark, raw, settings, options.out, options.prefix, options.monthly_facts)
    try:
        print("\n".join(job.run().lines()))
    except CheckFailure as failure:
        sys.exit(str(failure))
    finally:
        release(spark)


if __name__ == "__main__":
    main()
