"""The pipeline stage by stage, each held against a plain version of what it should do."""

import re

import numpy as np
import public_tokenizers
import pytest
from test_chosen_path import brute_force
from test_sanitise import base
from test_tokens import check_packing
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from marketlens.llm import decision_list, weak_labels

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.keep(stage(spark, out[-1], FOLDER), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "pii", "packing"]
    for df in steps[:-1]:
        assert df.dtypes == steps[0].dtypes


def test_filters_keep_what_their_operator_keeps(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    toxic = {r.doc_id for r in weak_labels.op7(steps[0], labels).where("predicted = 1").collect()}
    assert texts(steps[1]) == {k: t for k, t in texts(steps[0]).items() if k not in toxic}
    good = {r.doc_id for r in decision_list.op6(steps[1], labels).where("kept").collect()}
    assert texts(steps[2]) == {k: t for k, t in texts(steps[1]).items() if k in good}
    marked = {r.doc_id: r for r in labels.collect()}
    clean = [k for k, t in texts(steps[0]).items() if k in marked and marked[k].quality and not marked[k].toxic]
    assert sum(k in good for k in clean) > 0.9 * len(clean)


def test_one_document_of_each_group(steps):
    before, after = texts(steps[2]), texts(steps[3])
    keepers = {k for k, _, _, kept in brute_force(list(before.items()), 5) if kept}
    assert after == {k: before[k] for k in keepers}


def test_no_personal_data_is_left(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    for k, text in after.items():
        assert not base(text)
        if not base(before[k]):
            assert text == before[k] or re.search(r"\[WORD\]|  ", text)
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_packed_sequences(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    documents = [
        (k, np.array([*library.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")) for k, t in texts(steps[4]).items()
    ]
    check_packing(steps[5].collect(), documents)


def test_run_gives_the_last_stage(spark, steps):
    def tokens(df):
        found = {}
        for r in df.collect():
            found.setdefault(r.doc_id, [r.doc_tokens, 0])[1] += r.length
        return found

    rows = contract.queries()["pipeline"](spark, FOLDER)
    assert rows.dtypes == steps[-1].dtypes
    assert tokens(rows) == tokens(steps[-1]) and all(a == b for a, b in tokens(rows).values())


def test_empty_documents(spark, steps):
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
