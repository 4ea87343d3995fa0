"""ARC parsing, conversion and the exact round trip of pages."""

import base64
import hashlib
import os
import time

import pytest

from shopscope.llm import catalog, web_archives
from shopscope.llm.storage import Output
from shopscope.llm.web_archives import arc_record, arc_records, arc_version_block, packed

PAGES = "url string, page_id long, html string, status string"


def brute_force(pages):
    rows, first = [], {}
    for page, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kept = digest in first
        rows.append((page, len(data), digest, "revisit" if kept else "response", first.get(digest)))
        first.setdefault(digest, page)
    return sorted(rows, key=str)


def result(df):
    return sorted((tuple(row[:5]) for row in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip_of_odd_pages(spark):
    pages = [
        ("http://a/ b\n", 3, "<p>é\r\n\r\nHTTP/1.1 x</p>", "x"),
        ("http://a/", 1, "<p>é\r\n\r\nHTTP/1.1 x</p>", None),
        (None, 4, None, None),
        ("", 2, "", None),
        ("u", 7, "x" * 300_000, None),
        ("u", 7, "x" * 300_000, None),
        ("u", None, "lone", None),
    ]
    rows = web_archives.round_trip(spark, spark.createDataFrame(pages, PAGES))
    assert result(rows) == brute_force([(p[1], p[2]) for p in pages])
    ids = [row["record_id"] for row in rows.collect()]
    assert len(set(ids)) == len(pages)
    assert web_archives.round_trip(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_query_over_the_whole_table(spark):
    directory = "/root/testdata/sf0.001"
    pages = [(r["page_id"], r["html"]) for r in catalog.table(spark, directory, "pages").collect()]
    assert result(catalog.op5_web_archives(spark, directory)) == brute_force(pages)


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("press", [bytes, packed])
def test_arc_versions(spark, tmp_path, workspace, version, press):
    http = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nbody\n\nhttp://b 1.1.1.1 2 text/html 3\n"
    parts = [
        arc_version_block("old.arc", version, "19990102030405"),
        arc_record(version, "http://a/with blank", "19990102030406", http, "old.arc", 99),
        arc_record(version, "dns:a", "19990102030407", b"a. 1 IN A 1.2.3.4", "old.arc", 999, mime="text/dns"),
    ]
    data = b"".join(map(press, parts))
    found = [(fields["url"], fields["date"], body) for _, _, fields, body in arc_records(data)]
    assert found == [("http://a/with blank", "19990102030406", http), ("dns:a", "19990102030407", b"a. 1 IN A 1.2.3.4")]
    out = Output(str(tmp_path), ".arc")
    out.write(data)
    out.close()
    warcs = web_archives.convert(spark.createDataFrame([(out.uri,)], "archive string"), workspace)
    rows = {row["target_uri"]: row for row in web_archives.read_warcs(warcs).collect()}
    assert rows["http://a/with blank"]["record_type"] == "response" and rows["dns:a"]["record_type"] == "resource"
    assert rows["dns:a"]["date"] == "1999-01-02T03:04:07Z"
    assert rows["http://a/with blank"]["payload_bytes"] == len(http.split(b"\r\n\r\n", 1)[1])


def test_members_in_linear_time():
    def seconds(n):
        data = b"".join(packed(bytes([k % 251]) * 300 + str(k).encode() * 200) for k in range(n))
        best = 1e9
        for _ in range(3):
            begin = time.process_time()
            found = list(web_archives.members(data))
            best = min(best, time.process_time() - begin)
        assert len(found) == n and b"".join(data[at : at + size] for at, size, _ in found) == data
        return best

    assert seconds(40_000) < 2.5 * seconds(20_000)
    odd = [b"", b"x", os.urandom(200_000), b"y" * 500_000, b"", b"z"]
    assert [content for _, _, content in web_archives.members(b"".join(map(packed, odd)))] == odd
    with pytest.raises(ValueError, match="cut off"):
        list(web_archives.members(packed(b"one") + packed(b"two")[:-4]))


def test_both_versions_are_written_and_read(spark, workspace):
    pages = catalog.table(spark, "/root/testdata/sf0.001", "pages").repartition(4)
    arcs = workspace.store("arcs", web_archives.write_arcs(pages, workspace.location("arc")))
    assert {row["version"] for row in web_archives.scan_arcs(arcs).select("version").distinct().collect()} == {1, 2}


def test_cut_off_record():
    data = arc_version_block("a", 1, "1999") + arc_record(1, "u", "1999", b"abc", "a", 0)[:-3]
    with pytest.raises(ValueError, match="declares"):
        list(arc_records(data))


def test_small_payloads_are_all_responses(spark, workspace):
    pages = spark.createDataFrame([("u", 1, "ab", ""), ("u", 2, "ab", "")], PAGES)
    arcs = workspace.store("a", web_archives.write_arcs(pages, workspace.location("arc")))
    rows = web_archives.read_warcs(web_archives.convert(arcs, workspace, revisit_from=3)).collect()
    assert {row["record_type"] for row in rows} == {"response"}
