"""Benchmark: build the star schema, then run the headline queries. Prints one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query, the median counts (default 3)
BENCH_DUCKDB   1 = also time DuckDB: the tables that Spark stores are stored, the rest are views
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "fct_orders", "dim_customers", "customer_rfm", "seller_scorecard", "export_orders",
    "check_summary", "monthly_trend", "category_pareto", "state_revenue", "weekday_hour_grid",
    "repeat_summary", "cohort_retention_filled", "returned_within_180d", "repeat_by_first_category",
    "rfm_segments", "delivery_kpis", "delivery_stages", "late_rate_by_state", "review_by_arrival",
    "seller_concentration", "welch_review_late", "mannwhitney_review_late",
    "spearman_delivery_review", "chi2_late_repeat", "dash_kpis", "dash_customer_kpis",
]


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("marketlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def bench_spark() -> dict[str, float]:
    from marketlens import catalogue
    from marketlens.session import release
    from marketlens.warehouse import Warehouse

    spark = session()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    def fresh() -> Warehouse:
        shared = catalogue.warehouse(spark, FOLDER)
        return Warehouse(spark, shared.sources, shared.settings, shared.stored_raw)

    catalogue.warehouse(spark, FOLDER).build()  # warm up; the queries below read these tables
    warehouse = fresh()
    times = {"load_raw": timed(warehouse.load), "build_marts": timed(warehouse.build)}

    def run(name: str) -> None:
        catalogue.run(name, spark, FOLDER).write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        run(name)  # warm up
        times[name] = statistics.median(timed(lambda: run(name)) for _ in range(RUNS))
    release(spark)
    spark.stop()
    return times


def bench_duckdb() -> dict[str, float]:
    import duckdb

    import oracle
    from oracle.layers import CHAIN

    con = duckdb.connect()
    con.execute(f"SET threads = {CPUS}")
    for table in "region nation customer supplier part orders lineitem".split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")

    def build(raw: bool) -> None:
        for name, body in CHAIN.items():
            if name.startswith("raw_") == raw:
                # As in Spark, staging and the steps within a mart are not stored.
                kind = "TABLE" if name[:2] in ("ra", "d_", "f_") or name in ("rfm", "scorecard") else "VIEW"
                con.execute(f"CREATE {kind} {name} AS {body}")

    times = {"load_raw": timed(lambda: build(True)), "build_marts": timed(lambda: build(False))}
    layer_source = {"fct_orders": "f_orders", "dim_customers": "d_customers", "customer_rfm": "rfm",
                    "seller_scorecard": "scorecard", "export_orders": "x_orders"}
    for name in HEADLINE:
        body = CHAIN[layer_source[name]] if name in layer_source else oracle.ANALYSES[name]
        run = lambda: con.execute(body).fetchall()
        run()
        times[name] = statistics.median(timed(run) for _ in range(RUNS))
    return times


def main() -> None:
    times = bench_spark()
    result = {
        "metric": "raw load, star schema build and headline queries, warm, median per query",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(t, 3) for name, t in times.items()},
        "sf": os.path.basename(FOLDER),
    }
    if os.environ.get("BENCH_DUCKDB") == "1":
        result["duckdb"] = {name: round(t, 3) for name, t in bench_duckdb().items()}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
