"""Archives by round trip, and the reader on broken ones."""

import base64
import hashlib
import io

import duckdb
import pytest

from marketlens.llm import warc

FOLDER = "/root/testdata/sf0.01"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(pages):
    best = {}
    for r in pages:
        best[r.html or ""] = max(best.get(r.html or "", -1), r.page_id if r.page_id is not None else -1)
    return best


@pytest.mark.parametrize("segment", [warc.SEGMENT, 700])
def test_whole_table(spark, segment):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    rows = {r.page_id: r for r in warc.round_trip(pages, segment=segment).collect()}
    source = pages.collect()
    best = expected(source)
    assert rows.keys() == {r.page_id for r in source}
    for r in source:
        got, first = rows[r.page_id], best[r.html or ""]
        assert (got.payload_bytes, got.payload_digest, got.intact) == (len(r.html.encode()), digest(r.html), True)
        assert (got.record_type, got.refers_to) == (("response", None) if first == r.page_id else ("revisit", first))


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    cursor = con.execute(warc.SQL)
    names = [d[0] for d in cursor.description]
    rows = warc.op4(spark.read.parquet(f"{FOLDER}/pages.parquet")).select(*names).collect()
    assert sorted(map(tuple, rows)) == sorted(cursor.fetchall())


def test_edge_rows(spark):
    texts = [(1, None), (2, ""), (3, "x\r\n\r\nWARC/1.1\r\n"), (4, "é中" * 90000), (5, "é中" * 90000), (6, "a"), (6, "a"), (None, "null id")]
    pages = spark.createDataFrame([(k, t, "r", 1) for k, t in texts], "page_id long, html string, record string, segment int")
    rows = warc.op4(pages).collect()
    assert len(rows) == len(texts) and all(r.intact for r in rows)
    by = {(r.page_id, r.record_type): r for r in rows}
    assert by[2, "response"].payload_bytes == 0 and by[1, "revisit"].refers_to == 2
    assert by[4, "revisit"].refers_to == 5 and by[5, "response"].payload_bytes == 450000
    assert by[6, "revisit"].refers_to == 6 and (6, "response") in by
    assert by[None, "response"].payload_digest == digest("null id")
    assert warc.op4(pages.limit(0)).count() == 0


def test_broken_archives():
    good = b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(io.BytesIO(good * 2))] == [b"abc", b"abc"]
    for bad in (good[:-3], good.replace(b": 3", b": 9"), b"junk\r\n", good[:20]):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(bad)))
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert warc.dechunked(head + b"3;x=1\r\nabc\r\n2\r\nde\r\n0\r\n\r\n") == b"abcde"
    assert warc.dechunked(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"
    with pytest.raises(ValueError):
        warc.dechunked(head + b"9\r\nabc\r\n0\r\n\r\n")


def test_segments_that_do_not_add_up(spark, tmp_path):
    pages = spark.createDataFrame([(1, "x" * 5000)], "page_id long, html string")
    rows = warc.records(pages, "page_id", "html", 700)[0].collect()
    kept = [r for r in rows if "WARC-Segment-Number: 3" not in r.value]
    path = str(tmp_path / "broken")
    spark.createDataFrame(kept).coalesce(1).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    with pytest.raises(Exception, match="segments"):
        warc.read(spark, path).collect()


def test_ids_with_any_characters(spark):
    ids = ["a\r\nX: y", " padded ", "", "é中%0A", "100%", "a+b c", "\t", "WARC/1.1"]
    pages = spark.createDataFrame([(k, f"text {i // 2}") for i, k in enumerate(ids)], "page_id string, html string")
    rows = {r.page_id: r for r in warc.op4(pages).collect()}
    assert rows.keys() == set(ids) and all(r.intact for r in rows.values())
    for a, b in zip(ids[::2], ids[1::2]):
        assert rows[min(a, b)].refers_to == max(a, b) and rows[max(a, b)].record_type == "response"


def test_a_hot_page_in_a_shuffled_frame(spark):
    """A third of the rows are one page; rows change their places from one evaluation to the next."""
    hot = "<p>" + "hot " * 500
    pages = spark.range(3000).selectExpr("id AS page_id", f"if(id % 3 = 0, '{hot}', concat('<p>', id % 1000)) AS html")
    rows = warc.op4(pages.repartition(7, "html")).collect()
    best = {}
    source = {r.page_id: r.html for r in pages.collect()}
    for k, html in source.items():
        best[html] = max(best.get(html, -1), k)
    assert len(rows) == 3000 and all(r.intact for r in rows)
    for r in rows:
        first = best[source[r.page_id]]
        assert r.refers_to == (None if first == r.page_id else first)


def test_files_are_cut_by_bytes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FILE_BYTES", 400_000)
    pages = spark.range(1, 601, 1, 1).selectExpr("id AS page_id", "repeat(cast(id AS string), 700) AS html")
    warc.write(pages, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.gz"))) >= 4
    assert warc.read(spark, str(tmp_path / "out")).where("intact").count() == 600


def test_records_are_not_built_for_a_filter(spark):
    lines, _ = warc.records(spark.read.parquet(f"{FOLDER}/pages.parquet"), "page_id", "html")
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not [line for line in filters if "transform" in line or "HTTP" in line]
