"""Archives read back, against SQL and by parts."""

import gzip
import io

import pytest

from compare import connect, duck_rows, spark_rows
from conftest import SF_DIR
from profilelake.llm import archives as ar
from profilelake.llm import queries


def test_query(spark):
    sql = queries.oracle_sql()["op7_warc"]
    assert spark_rows(queries.op7_warc(spark, SF_DIR)) == duck_rows(connect(SF_DIR), sql)


def test_repeated_payloads_and_odd_rows(spark, tmp_path):
    long = "<p>same é</p>\r\n\r\n" * 20
    rows = [
        (7, "http://a/", long), (3, "http://b/ c\nd", long), (9, None, long), (4, "ftp://x", "short"),
        (5, "http://e", "short"), (6, "http://f", None), (8, "http://g", ""), (None, "http://h", long),
        (10, "http://i", long + "x"), (10, "http://i", long + "x"), (11, "", "WARC/1.1\r\n" + "z" * 200),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'q' AS file")
    got = ar.round_trip(pages.repartition(3), str(tmp_path)).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got)
    assert kinds == [
        (0, "response", 0), (3, "response", 0), (4, "response", 0), (5, "response", 0), (6, "response", 0),
        (7, "revisit", 3), (8, "response", 0), (9, "revisit", 3), (10, "response", 0), (10, "revisit", 10),
        (11, "response", 0),
    ]
    bodies = {i: (h or "").encode() for i, _, h in rows}
    assert all(r.payload_bytes == len(bodies[r.page_id]) for r in got)
    none = pages.where("false")
    assert ar.round_trip(none, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions(version):
    block = b"HTTP/1.1 200 OK\r\nX-Archive-Key: 5\r\n\r\nbody\n\nwith lines\n"
    dns = b"20240101\nexample.org 1.2.3.4\n"
    data = ar.version_block(version, "x.arc", ar.DATE)
    data += ar.arc_header(version, "http://e/", ar.DATE, "text/html", "x.arc", block, 9) + block + b"\n"
    data += ar.arc_header(version, "dns:e", ar.DATE, "text/dns", "x.arc", dns, 99) + dns + b"\n"
    page, name = ar.read_arc(io.BytesIO(data))
    assert page.key == 5 and page.http[1] == b"body\n\nwith lines\n" and name.block == dns
    warc = ar.converted(page, "p") + ar.converted(name, "q") + ar.converted(page, "p", {"refers_to": 2})
    (f1, b1), (f2, b2), (f3, b3) = ar.read_warc(io.BytesIO(warc))
    assert (f1["WARC-Type"], f2["WARC-Type"], f3["WARC-Type"]) == ("response", "resource", "revisit")
    assert b1 == block and b2 == dns and b3 == page.http[0]
    assert f1["WARC-Date"] == "2024-01-01T00:00:00Z" and f1["WARC-Record-ID"].startswith("<urn:uuid:")
    assert f1["WARC-Payload-Digest"] == f3["WARC-Payload-Digest"]


@pytest.mark.parametrize("damage", [
    lambda d: d[:-8], lambda d: d.replace(b"http://e/ 0.0.0.0", b"http://e/", 1), lambda d: b"junk" + d,
])
def test_damaged_archives(damage):
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    data = ar.version_block(1, "x", ar.DATE) + ar.arc_header(1, "http://e/", ar.DATE, "t", "x", block, 0) + block
    with pytest.raises(ValueError):
        list(ar.read_arc(io.BytesIO(damage(data)), "x"))


def test_files_are_plain_archives(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x" * 300)], "page_id bigint, url string, html string")
    ar.round_trip(pages.coalesce(1), str(tmp_path)).collect()
    (arc,) = (tmp_path / "arc").glob("*.arc.gz")
    (warc,) = (tmp_path / "warc").glob("*.warc.gz")
    assert gzip.open(arc).readline().startswith(b"filedesc://")
    assert gzip.open(warc).readline() == b"WARC/1.1\r\n"
