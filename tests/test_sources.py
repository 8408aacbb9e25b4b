"""CSV source, catalog helpers, and the batch job end to end."""

import csv
import random
import re
from datetime import datetime

import pytest
from comparing import spark_result

from marketlens.config import STANDIN
from marketlens.plans import profiling
from marketlens.jobs import build as build_module
from marketlens.jobs.build import Build, CheckFailure
from marketlens.sources import catalog
from marketlens.sources.csv_files import load_raw, read_csv_table
from marketlens.sources.csv_records import open_after
from marketlens.sources.schemas import RAW_SCHEMAS
from marketlens.sources.standin import standin_sources
from marketlens.session import shared_dir, stash
from marketlens.warehouse import MART_INPUTS, MARTS, mart_waves

FOLDER = "/root/testdata/sf0.001"


def test_reviews_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "order_reviews.csv"
    path.write_text(
        "review_id,order_id,review_score,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"said ""great""\nand left, happy",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "r2,o2,,,2018-03-10 00:00:00,\n"
    )
    rows = read_csv_table(spark, str(path), "order_reviews").orderBy("review_id").collect()
    assert rows[0].review_comment_message == 'said "great"\nand left, happy'
    assert rows[0].review_answer_timestamp == datetime(2018, 1, 18, 21, 46, 59)
    assert rows[1].review_score is None and rows[1].review_answer_timestamp is None


def test_zip_codes_keep_leading_zeros(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01045,x,SP\n")
    assert read_csv_table(spark, str(path), "sellers").collect()[0].seller_zip_code_prefix == "01045"


def test_missing_file_names_the_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="customers"):
        load_raw(spark, str(tmp_path))


def test_missing_column_is_an_error(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_city\ns1,x\n")
    with pytest.raises(ValueError, match="seller_state"):
        read_csv_table(spark, str(path), "sellers")


@pytest.mark.parametrize("row", [
    'o1,1,p1,s1,2017-01-02 00:00:00,"1.234,50",1.0', "o1,1,p1,s1,2017-01-02 00:00:00,abc,1.0",
    "o1,x,p1,s1,2017-01-02 00:00:00,1.0,1.0", "o1,1,p1,s1,01/02/2017,1.0,1.0",
    "o1,1,p1,s1", "o1,1,p1,s1,2017-01-02 00:00:00,1.0,1.0,surplus",
])
def test_damaged_rows_fail(spark, tmp_path, row):
    path = tmp_path / "items.csv"
    head = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    path.write_text(f"{head}o0,1,p1,s1,2017-01-02 00:00:00,1.5,1.0\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED"):
        stash(read_csv_table(spark, str(path), "order_items"))


def test_a_quoted_line_break_in_any_table(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        'c1,u1,01045,"sao\npaulo",SP\n\nc2,u2,"01046",rio,"R""J"\n'
    )
    rows = read_csv_table(spark, str(path), "customers").orderBy("customer_id").collect()
    assert [tuple(r) for r in rows] == [("c1", "u1", "01045", "sao\npaulo", "SP"), ("c2", "u2", "01046", "rio", 'R"J')]


def reviews_file(path, n, ending="\n"):
    """Reviews with quotes, commas and line breaks, one of them longer than several byte ranges."""
    rng = random.Random(n)
    texts = ["", "plain", "a, b", 'said "x"', "two\nlines", '\n\n"', '","', '5" screen\n', "x\n" * 40, '"', ",\n,", '\n"quoted"\n,end']
    rows = []
    for i in range(n):
        text = rng.choice(texts) if i != n // 2 else 'long "text", of\nmany lines\n' * 400
        rows.append([f"r{i}", f"o{i}", str(1 + i % 5), rng.choice(texts), text, "2018-01-18 00:00:00", "2018-01-18 21:46:59"])
    head = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
            "review_creation_date", "review_answer_timestamp"]
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=ending)
        writer.writerows([head, *rows])
    return [tuple(r[:5]) for r in rows]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("limit", ["700", "2000", "1000000"])
def test_records_over_many_byte_ranges(spark, tmp_path, ending, limit):
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    rows = reviews_file(folder / "one.csv", 150, ending) + reviews_file(folder / "two.csv", 31, ending)
    spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_csv_table(spark, str(folder), "order_reviews")
        if limit == "700":
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
        got = [tuple("" if v is None else str(v) for v in tuple(r)[:5]) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(got) == sorted(rows)


def test_open_quotes_against_a_plain_reader():
    """A line leaves a value open exactly if the standard reader wants another line."""
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice('",a"b, ') for _ in range(rng.randrange(12)))
        if re.search(r'(?:^|,)"(?:[^"]|"")*"[^,"]', text):
            continue  # text after a closing quote is read differently by every reader
        consumed = len(next(csv.reader(iter([text + "\n", 'x"\n'])), [])) and csv_lines_of_first(text)
        if consumed is not None:
            assert open_after(text, False) == (consumed == 2), text


def csv_lines_of_first(text):
    reader = csv.reader(iter([text + "\n", 'x"\n']))
    next(reader, None)
    return reader.line_num


def test_a_value_that_never_ends_and_a_damaged_record_fail(spark, tmp_path):
    head = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    path = tmp_path / "open.csv"
    path.write_text(head + 'c1,u1,01045,"sao\npaulo,SP\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv_table(spark, str(path), "customers").count()
    path = tmp_path / "short.csv"
    path.write_text(head + 'c1,u1,01045,"sao\npaulo",SP\nc2,u2\n')
    with pytest.raises(Exception, match="MALFORMED"):
        stash(read_csv_table(spark, str(path), "customers"))


def test_catalog_helpers(spark, tmp_path):
    df = catalog.inline_rows(spark, [(2, "b"), (1, "a")], "id int, name string")
    assert [tuple(r) for r in catalog.preview(df, 1, "id").collect()] == [(1, "a")]
    described = [tuple(r) for r in profiling.describe_columns(df).collect()]
    assert described == [("id", "int", 2), ("name", "string", 2)]
    rows, size = catalog.write_extract(df, str(tmp_path / "x"))
    assert rows == 2 and size > 0
    assert spark_result(spark.read.parquet(str(tmp_path / "x"))) == spark_result(df)


def test_shared_folder_is_the_one_named_by_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    kept = stash(spark.range(3))
    assert shared_dir(spark).removeprefix("file:") in kept.inputFiles()[0]


def test_a_job_without_a_shared_folder_fails_before_it_writes(spark, monkeypatch, tmp_path):
    def missing(_):
        raise RuntimeError("set spark.checkpoint.dir")

    monkeypatch.setattr(build_module, "shared_dir", missing)
    with pytest.raises(RuntimeError, match="checkpoint"):
        Build(spark, {}, STANDIN, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """Raw stand-in tables written as CSV, read back and built, with facts partitioned by month."""
    folder = tmp_path_factory.mktemp("csv")
    sources = standin_sources(spark, FOLDER)
    for name, make in sources.items():
        make().coalesce(1).write.option("header", True).option("escape", '"').option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
        ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
            f"{folder}/{name}.csv"
        )
    raw = load_raw(spark, str(folder))
    assert set(raw) == set(RAW_SCHEMAS)
    job = Build(
        spark, {n: (lambda df=df: df) for n, df in raw.items()}, STANDIN,
        str(tmp_path_factory.mktemp("out")), prefix="t_", monthly_facts=True,
    )
    job.report = job.run()
    yield job
    for layer in catalog.LAYERS:
        spark.sql(f"DROP DATABASE t_{layer} CASCADE")


def test_job_builds_every_layer(spark, job):
    rows = job.report.rows
    assert len(rows) == 24 and rows["marts.fct_orders"] == rows["raw.orders"]
    assert len(job.report.checks) == 12 and not job.report.failed
    assert set(job.report.extracts) == {"orders", "items", "rfm", "sellers"}
    assert len(job.report.lines()) == 24 + 12 + 4
    assert catalog.list_tables(spark, "t_").count() == 24


def test_job_agrees_with_the_queries(spark, job):
    """Same marts from string keys out of CSV as from the typed tables."""
    from marketlens import catalogue
    from marketlens.plans import marts, revenue

    trend = revenue.monthly_trend(marts.valid_orders(job.table("marts", "fct_orders"), STANDIN))
    assert spark_result(trend) == spark_result(catalogue.run("monthly_trend", spark, FOLDER))


def test_month_partitions_are_pruned(job):
    from marketlens.plans import marts

    valid = marts.valid_orders(job.table("marts", "fct_orders"), STANDIN)
    plan = valid._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert re.search(r"order_month#\d+ >= 1999-01", filters) and re.search(r"order_month#\d+ <= 2000-08", filters)
    assert len({r[0] for r in valid.select("order_month").distinct().collect()}) == 20


def build(spark, out, prefix, sources=None):
    return Build(spark, sources or standin_sources(spark, FOLDER), STANDIN, str(out), prefix=prefix)


def drop(spark, prefix):
    for layer in catalog.LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")


def negative_prices(spark):
    from pyspark.sql import functions as F

    sources = standin_sources(spark, FOLDER)
    items = sources["order_items"]
    sources["order_items"] = lambda: items().withColumn(
        "price", F.when(F.col("order_item_id") == 1, -F.col("price")).otherwise(F.col("price"))
    )
    return sources


def test_a_failed_check_leaves_the_old_marts(spark, tmp_path):
    first = build(spark, tmp_path, "old_")
    first.run()
    before = spark_result(spark.table("old_marts.fct_order_items"))
    second = build(spark, tmp_path, "old_", negative_prices(spark))
    with pytest.raises(CheckFailure, match="chk_no_negative_money"):
        second.run()
    assert spark_result(spark.table("old_marts.fct_order_items")) == before
    assert second._mart("fct_order_items").where("price < 0").count() > 0
    third = build(spark, tmp_path, "old_")
    reading = spark.table("old_marts.fct_orders")
    third.run()
    files = spark.table("old_marts.fct_orders").inputFiles()
    assert files and all(third.version in f for f in files)
    assert reading.count() == third.rows["marts.fct_orders"]
    assert sorted(p.name for p in (tmp_path / "versions").iterdir()) == [first.version, third.version]
    drop(spark, "old_")


def test_marts_run_in_waves_after_their_inputs():
    done = set()
    for wave in mart_waves():
        assert all(set(MART_INPUTS.get(name, ())) <= done for name in wave)
        done |= set(wave)
    assert done == set(MARTS) and len(mart_waves()) == 2


def test_job_fails_on_a_failing_check(spark, tmp_path):
    job = build(spark, tmp_path, "bad_", negative_prices(spark))
    with pytest.raises(CheckFailure, match="chk_no_negative_money"):
        job.run()
    assert not (tmp_path / "extracts").exists()
    drop(spark, "bad_")


def test_one_calendar_for_settings_and_orders(spark, job):
    from datetime import date

    from marketlens.config import Settings
    from marketlens.plans import marts

    orders = job.table("staging", "stg_orders")
    published = marts.dim_date(orders, Settings())
    assert published.count() == 791 and published.agg({"date": "max"}).first()[0] == date(2018, 10, 31)
    assert spark_result(marts.dim_date(orders, STANDIN)) == spark_result(job.table("marts", "dim_date"))


def test_a_changed_folder_gives_new_results(spark, tmp_path):
    import gc
    import os
    import shutil

    import pyarrow.parquet as pq

    from marketlens import catalogue

    folder = tmp_path / "tables"
    shutil.copytree(FOLDER, folder)
    first = catalogue.run("correct_revenue", spark, str(folder))
    before = first.collect()
    held = [path for path, _ in catalogue.warehouse(spark, str(folder))._written.values()]
    assert held and all(os.path.exists(p.removeprefix("file:")) for p in held)
    assert catalogue.run("correct_revenue", spark, str(folder)).collect() == before
    items = pq.read_table(f"{FOLDER}/lineitem.parquet")
    pq.write_table(items.slice(0, len(items) // 2), folder / "lineitem.parquet")
    after = catalogue.run("correct_revenue", spark, str(folder)).collect()
    assert after != before
    assert first.collect() == before  # what is still held can still be read
    del first
    gc.collect()
    assert not any(os.path.exists(p.removeprefix("file:")) for p in held)
