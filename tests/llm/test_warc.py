import base64
import hashlib

import pytest

from broadsheet.llm import queries as Q
from broadsheet.llm import warc as W
from tests.compare import duck, rows


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert rows(Q.op4_arc_to_warc(spark, sf).toPandas()) == rows(duck(sf).execute(Q.OP4_SQL).df())


def test_odd_pages(spark):
    pages = [(1, "http://a/ b", "x"), (2, None, "x"), (3, "u", None), (4, "u\n", ""), (5, "u", "WARC/1.1\r\n\r\n\r\n" + "é日" * 40000), (6, "u", "x"), (7, "u", "y"), (7, "u", "y"), (None, "u", "x")]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, digest string")
    found = {(r["page_id"], r["record_type"], r["refers_to"]) for r in W.warc_report(df).collect()}
    assert found == {(1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "revisit", 3), (5, "response", None), (6, "revisit", 1), (7, "response", None), (None, "revisit", 1)}
    back = W.warc_report(df).collect()
    assert len(back) == len(pages)
    for r in back:
        if r["page_id"] is not None:
            data = next(p[2] or "" for p in pages if p[0] == r["page_id"]).encode()
            assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    assert W.warc_report(df.limit(0)).count() == 0


def test_small_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")], "page_id long, url string, html string")
    W.write_archives(df, f"file://{tmp_path}/w", version=2, min_revisit_bytes=3)
    assert {(r["page_id"], r["record_type"]) for r in W.read_archives(spark, f"file://{tmp_path}/w").collect()} == {(1, "response"), (2, "response"), (3, "response"), (4, "revisit")}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    records = [W.ArcRecord("http://a b/c", "1.2.3.4", "19970102030405", "text/html", b"HTTP/1.0 200 OK\r\n\r\nbody\nhttp://x 1.2.3.4 1997 t 3\nabc", "200"), W.ArcRecord("", "::1", "19970102", "no-type", b"", ""), W.ArcRecord("u", "0.0.0.0", "199701020304", "text/html; charset=x", b"\n\n\n", "404")]
    data = W.arc_version_block(version, "f.arc", "19970101000000") + b"".join(W.arc_record(version, r) for r in records)
    back = list(W.read_arc(data))
    assert [(r.url, r.ip, r.date, r.content_type, r.body) for r in back] == [(r.url, r.ip, r.date, r.content_type, r.body) for r in records]
    if version == 2:
        assert [r.status for r in back] == ["200", "", "404"]
    with pytest.raises(ValueError):
        list(W.read_arc(data[:-30]))
    with pytest.raises(ValueError):
        list(W.read_arc(b"not a header\n"))


def test_warc_records():
    arc = W.ArcRecord("http://a", "1.2.3.4", "1997", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\npay\r\n\r\nload")
    data = b"".join(x + b"\n" for x in (W.warc_record(arc, "k"), W.warc_record(arc, "l", "k"), W.warc_record(W.ArcRecord("dns:a", "", "19970102", "text/dns", b"a\r\n\r\n"), "m")))
    (one, block), (two, head), (three, plain) = W.read_warc(data)
    assert (one["warc-type"], two["warc-type"], three["warc-type"]) == ("response", "revisit", "resource")
    assert block == arc.body and head.endswith(b"\r\n\r\n") and plain == b"a\r\n\r\n"
    assert two["warc-refers-to"] == one["warc-record-id"] and one["warc-payload-digest"] == two["warc-payload-digest"]
    assert one["warc-date"] == "1997-01-01T00:00:00Z" and three["warc-date"] == "1997-01-02T00:00:00Z" and one["warc-ip-address"] == "1.2.3.4"
    with pytest.raises(ValueError):
        list(W.read_warc(data[:-3]))
