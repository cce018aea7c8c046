"""ARC in, WARC out, read back: against the pages themselves and hand-made archives."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from terraloom.llm import warc
from terraloom.llm.common import shared_path
from tests.compare import connect, differences
from tests.llm.conftest import SF_DIR


def check(out, rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    got = {}
    for r in out.collect():
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    responses = {}
    for page, _, html in rows:
        data = (html or "").encode()
        for r in got[page]:
            if r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode():
                assert r.payload_bytes == len(data)
                assert (r.record_type == "revisit") == (r.refers_to is not None)
                assert r.record_type == "response" or r.refers_to == first[html or ""]
    for rs in got.values():
        for r in rs:
            responses[r.payload_digest] = responses.get(r.payload_digest, 0) + (r.record_type == "response")
    assert set(responses.values()) <= {1}
    assert len(responses) == len({html or "" for _, _, html in rows})


def test_awkward_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 40_000)
    rows = [
        (1, "http://a/x y\n", "<p>é</p>"), (2, None, None), (3, "", ""), (4, "http://b", "a\r\n\r\nWARC/1.1\r\n\r\n"), (5, "http://c", "x" * 200_000),
        (7, "http://d", "HTTP/1.1 200 OK\r\n\r\nin"), (6, "http://e", "<p>é</p>"), (6, "http://e", "<p>é</p>"), (9, "u", "\x00\n\n\x1f\x8b"), (None, "http://n", "none")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS payload", "2 AS page", "'z' AS digest", "3 AS path")
    check(warc.archived_pages(df), rows)
    assert warc.archived_pages(df.limit(0)).count() == 0


def test_against_sql(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    assert differences(warc.archived_pages(pages), connect(SF_DIR), warc.ORACLE) == []


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(["ab", "ab", "abcdef", "abcdef"])], "page_id bigint, url string, html string")
    out = sorted(warc.archived_pages(df, least=3).collect())
    assert [(r.record_type, r.refers_to) for r in out] == [("response", None), ("response", None), ("response", None), ("revisit", 2)]


@pytest.mark.parametrize("version", [1, 2])
def test_parse_versions(version):
    data = warc.arc_version_block("old.arc", version)
    blocks = [b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\n", b"dns: text", b""]
    for block in blocks:
        data += b"\n" + warc.arc_record(version, "old.arc", "http://x/a b", block, "199912")
    found = list(warc.parse_arc(data))
    assert [r.block for r in found] == blocks and [r.payload for r in found] == [b"body\n\n", b"dns: text", b""]
    assert {r.uri for r in found} == {"http://x/a%20b"} and {r.date for r in found} == {"1999-12-01T00:00:00Z"}
    assert [r.record_id for r in found] == [r.record_id for r in warc.parse_arc(data)] and len({r.record_id for r in found}) == 3
    assert len(found[0].fields) == len(warc.ARC_FIELDS[version])
    with pytest.raises(ValueError):
        list(warc.parse_arc(warc.arc_version_block("old.arc", version) + warc.arc_record(version, "old.arc", "u", b"cut off")[:-3]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data.replace(b"URL IP-address", b"URL Address")))
    spaced = warc.arc_version_block("old.arc", 1) + b"http://x/a b 1.2.3.4 20010203040506 text/plain 2\nok"
    assert [(r.uri, r.date, r.block) for r in warc.parse_arc(spaced)] == [("http://x/a b", "2001-02-03T04:05:06Z", b"ok")]


def test_gzip_members():
    assert warc.unzipped(gzip.compress(b"one") + gzip.compress(b"two")) == b"onetwo" and warc.unzipped(b"plain") == b"plain"


def test_files_are_warc(spark):
    """The written files hold one record per page and one about each archive, and only responses carry payloads."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").limit(20)
    arcs, warcs = shared_path(spark, "arc"), shared_path(spark, "warc")
    warc.write_arc(pages.union(pages), arcs)
    warc.convert_arc(spark, arcs, warcs)
    kinds = []
    for row in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(warcs).collect():
        for headers, block in warc.parse_warc(gzip.decompress(row.content)):
            kinds.append(headers["warc-type"])
            if kinds[-1] == "revisit":
                assert warc.split_http(block)[1] == b"" and headers["warc-profile"] == warc.REVISIT_PROFILE
    assert sorted(set(kinds)) == ["response", "revisit", "warcinfo"] and kinds.count("response") == kinds.count("revisit") == 20
    back = {r.page_id: r.payload.decode() for r in warc.read_warc(spark, warcs).where("record_type = 'response'").collect()}
    assert back == {r.page_id: r.html for r in pages.collect()}
