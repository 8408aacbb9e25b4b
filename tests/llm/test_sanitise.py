"""Spans of personal data against a plain search, and the corpus layer on planted terms."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlens.llm import sanitise

FOLDER = "/root/testdata/sf0.01"
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, digits[::-1])))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    ]


def expected(text):
    spans = base(text)
    counts = [sum(s.startswith(kind) for s in spans) for kind, _ in PATTERNS]
    return (*counts, hashlib.sha256(",".join(spans).encode()).hexdigest())


def got(row):
    return (row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256)


def random_texts(n):
    rng = random.Random(5)
    parts = ["a@b.c", "_", "%x@y-z.org", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (249) 555-6835", " ",
             "é", "中", "x", "0", "00012.3.4.5.6", "378282246310005", "-", "+4", "@", "\n", "5500-0000-0000-0004"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(n)]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in sanitise.op1(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys()
    assert all(got(rows[k]) == expected(t) for k, t in texts.items())
    for k, t in texts.items():
        assert rows[k].spans.split(",")[: len(base(t))] == (base(t) or [""])[: len(base(t))]


def test_random_and_edge_texts(spark):
    texts = [None, "", *random_texts(400), "1" * 5000, "a" * 20000 + "@", ("a@b" + ".c" * 5000), "1.2.3.4 " * 3000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    docs = docs.unionByName(docs.where("doc_id = 5").selectExpr("doc_id", "text", "found"))
    rows = sanitise.op1(docs).collect()
    assert len(rows) == len(texts) + 1
    assert [got(r) for r in rows if got(r) != expected(texts[r.doc_id])] == []
    assert sanitise.op1(docs.limit(0)).count() == 0
    assert sanitise.op1(docs.where("doc_id is null")).count() == 0


PLANTED = [f"text {i} by Zorblatt the {w} person mail zed@corp.example here {w}" for i, w in enumerate(["one", "two", "ten", "six"])]
OTHERS = [f"the person mail number {i} here by six and two one ten" for i in range(60)]


def test_terms_that_give_an_entity_away(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PLANTED + OTHERS)], "doc_id long, text string")
    rows = {r.doc_id: r for r in sanitise.op1(docs).collect()}
    for i, text in enumerate(PLANTED):
        at = text.index("Zorblatt")
        assert f"term:{at}:{at + 8}" in rows[i].spans.split(",")
        assert "term:0:4" in rows[i].spans.split(",")
        assert rows[i].n_terms == 2  # the word that opens the texts reveals the address as fully
    assert all(rows[i].n_terms == 0 for i in range(len(PLANTED), len(PLANTED + OTHERS)))


def test_copies_of_one_text_are_no_evidence(spark):
    docs = spark.createDataFrame([(i, PLANTED[0]) for i in range(9)] + [(9 + i, t) for i, t in enumerate(OTHERS)],
                                 "doc_id long, text string")
    assert sanitise.op1(docs).agg({"n_terms": "sum"}).first()[0] == 0


def test_copies_hide_no_disclosure(spark):
    texts = PLANTED + OTHERS + [PLANTED[0]] * 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in sanitise.op1(docs).collect()}
    for i, text in enumerate(texts):
        at = text.find("Zorblatt")
        assert (f"term:{at}:{at + 8}" in rows[i].spans.split(",")) == (at >= 0)


def spans_of_zorblatt(spark, texts):
    texts = texts + OTHERS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.spans.split(",") for r in sanitise.op1(docs).collect()}
    return [[f"term:{m.start()}:{m.end()}" in rows[i] for m in re.finditer("Zorblatt", t)] for i, t in enumerate(texts)]


def test_terms_anywhere_in_a_text_that_holds_the_entity(spark):
    far = " and the person" * 20
    texts = [f"{i} Zorblatt{far} mail zed@corp.example here{far} Zorblatt two" for i in range(4)]
    got = spans_of_zorblatt(spark, texts + ["by Zorblatt the person"])
    assert got[:5] == [[True, True]] * 4 + [[False]]


def test_terms_beside_numbers_other_spans_and_the_end(spark):
    card = [f"{i} by Zorblatt, one in 1961, number 12, card 4111 1111 1111 1111 here" for i in range(4)]
    assert spans_of_zorblatt(spark, card)[:4] == [[True]] * 4
    mails = [f"{i} by Zorblatt a@b.example zed@corp.example c@d.example here" for i in range(4)]
    assert spans_of_zorblatt(spark, mails)[:4] == [[True]] * 4
    last = [f"{i} the person mail zed@corp.example Zorblatt" for i in range(4)]
    assert spans_of_zorblatt(spark, last)[:4] == [[True]] * 4


def test_sanitised_texts(spark):
    rows = [(i, t, "a", i) for i, t in enumerate(PLANTED + OTHERS)] + [
        (100, None, "b", 0), (101, "", "b", 0), (102, "x" * 9000 + " a@b.cd " + "y" * 9000 + "+1 (249) 555-6835", "c", 1),
        (103, "4111 1111 1111 1111", "c", 1), (None, "é 1.2.3.4", "c", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more string, row int")
    done = sanitise.sanitised(docs)
    assert done.columns == docs.columns
    texts = {r.doc_id: r.text for r in done.collect()}
    assert texts[0] == " 0 by  the one person mail [EMAIL] here one"
    assert texts[100] is None and texts[101] == "" and texts[103] == "[CARD]" and texts[None] == "é [IP]"
    assert texts[102] == "x" * 9000 + " [EMAIL] " + "y" * 9000 + "[PHONE]"


@pytest.mark.parametrize("n", [0, 1, 2, 7, 50])
def test_running_sums(spark, n):
    df = spark.createDataFrame([([*range(n)],)], "v array<long>")
    assert df.select(sanitise._running(df.v)).first()[0] == [sum(range(i)) for i in range(n)]


def plainly_masked(text, spans):
    """The spans one after the other; one that begins within those before only moves their end."""
    out, at, end, label = "", 0, 0, None
    for start, stop, name in [*sorted(spans), (len(text) + 1, 0, "")]:
        if label is not None and start < end:
            end = max(end, stop)
            continue
        if label is not None:
            out, at = out + text[at : begin] + label, end  # noqa: F821
        begin, end, label = start, stop, name  # noqa: F841
    return out + text[at:]


def test_overlapping_and_many_spans(spark):
    rng, rows = random.Random(8), []
    for n in [1, 2, 3, 5, 8, 20, 60] * 6 + [4000]:
        text = "".join(rng.choice("abcdé中 ") for _ in range(30 if n < 100 else 30_000))
        spans = set()
        while len(spans) < n:
            start = rng.randrange(len(text))
            spans.add((start, min(len(text), start + rng.randrange(1, 7)), rng.choice(["[A]", "[B]", ""])))
        rows.append((text, sorted(spans)))
    df = spark.createDataFrame(rows, "text string, spans array<struct<start:bigint,end:bigint,label:string>>")
    got = [r.t for r in df.select(sanitise._masked(F.col("text"), F.col("spans")).alias("t")).collect()]
    assert got == [plainly_masked(t, s) for t, s in rows]
