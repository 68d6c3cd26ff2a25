import gzip
from datetime import datetime, timezone

import pytest

from skytally.llm import warc
from skytally.llm.common import prepare
from skytally.llm.oracles import ORACLES
from skytally.llm.queries import op9_warc
from skytally.session import scratch_path
from tests.llm.conftest import agrees_with_sql

WHEN = datetime(2001, 2, 3, 4, 5, 6, tzinfo=timezone.utc)


def test_agrees_with_sql(spark, tables):
    agrees_with_sql(op9_warc, ORACLES["op9_warc"], spark, tables)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "VOLUME_BYTES", 200)
    rows = [(1, "http://a/x y", "same"), (2, None, "same"), (3, "http://b/#page=9", "GET http://x 1.1.1.1 2 text 5\n\r\n\r\nWARC/1.0"),
            (4, "u", None), (5, "u", ""), (6, "u", "é" * 5000), (6, "u", "é" * 5000), (None, "u", "none")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "url AS digest")
    got = warc.archive_pages(pages.repartition(3), WHEN).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str) == sorted([
        (1, 4, "revisit", 2), (2, 4, "response", None), (3, len(rows[2][2]), "response", None), (4, 0, "revisit", 5),
        (5, 0, "response", None), (6, 10000, "response", None), (6, 10000, "response", None),
        (None, 4, "response", None)], key=str)
    assert {r.payload for r in got if r.page_id in (2, 3, 6)} == {"same", rows[2][2], "é" * 5000}
    assert {r.payload for r in got if r.record_type == "revisit"} == {None}
    longer = warc.archive_pages(pages, WHEN, least_bytes=1).collect()
    assert {r.record_type for r in longer if r.page_id in (4, 5)} == {"response"}
    assert warc.archive_pages(pages.limit(0), WHEN).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    data = warc.arc_head(version, "v", "20010203040506")
    data += warc.arc_record(version, "http://a", "20010203040506", "text/html", b"a\n\nb", "D", len(data), "v")
    data += warc.arc_record(version, "http://b", "20010203040506", "text/html", b"", "E", len(data), "v")
    (first, body), (second, empty) = warc.parse_arc(data)
    assert body == b"a\n\nb" and empty == b"" and first["URL"] == "http://a"
    assert list(first) == warc.FIELDS[version] and second["Archive-length"] == "0"
    if version == 2:
        assert second["Checksum"] == "E" and second["Result-code"] == "200"


def test_malformed_arc_raises():
    good = warc.arc_head(1, "v", "20010203040506")
    for bad in (b"no version block 1 2 3\nabc", good + b"http://a 0.0.0.0 1 text/html 99\nshort",
                good + b"http://a 0.0.0.0 1 2 text/html 1\nx", good + b"no end of line"):
        with pytest.raises(ValueError):
            list(warc.parse_arc(bad))


def test_written_files_follow_the_format(spark):
    pages = prepare(spark).createDataFrame([(1, "u", "one"), (2, "v", "two"), (3, "w", "one")], "page_id long, url string, html string")
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(pages.coalesce(1), arc, WHEN)
    warc.convert(spark, arc, out)
    files = [gzip.decompress(r.content) for r in spark.read.format("binaryFile").load(out).collect()]
    records = [r for f in files for r in warc.parse_warc(f)]
    assert [f["WARC-Type"] for f, _ in records if f["WARC-Type"] != "warcinfo"].count("revisit") == 1
    named = {f["WARC-Record-ID"] for f, _ in records}
    for fields, body in records:
        assert {"WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To"] in named and body.endswith(b"\r\n\r\n")
        if fields["WARC-Type"] != "warcinfo":
            assert fields["WARC-Date"] == "2001-02-03T04:05:06Z"
