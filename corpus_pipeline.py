"""From raw documents to packed sequences: the order in which the operators clean a corpus.

Each stage takes the documents its predecessor kept, whole, and returns documents (the last one pieces of
sequences). Toxicity and quality reject documents, near-duplicates keep one of each group, personal data
is masked in the texts, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import chosen_path, decision_list, packing, sanitise, weak_labels
from marketlens.llm.support import keep, workers_find_package
from marketlens.session import configure

ORACLE_SQL = None  # learned and iterative stages; tested stage by stage against brute-force versions


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak_labels.clean_documents(docs, _labels(spark, sf_dir))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decision_list.good_documents(docs, _labels(spark, sf_dir))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chosen_path.distinct_documents(docs, width=5)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    safe = sanitise.sanitised(docs)
    return safe.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.op9(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("pii", masked),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    workers_find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
