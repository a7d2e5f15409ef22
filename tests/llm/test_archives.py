"""The archive converter."""

from __future__ import annotations

import hashlib
import io
from collections import Counter

import pytest

from freshet.llm import webarchive as wa

LONG = "<html>" + "same words " * 20 + "</html>"


@pytest.mark.parametrize("version", [1, 2])
def test_headers_by_version(version):
    data = wa.arc_version_block("a.arc", version, "20010203040506") + wa.arc_record(version, b"HTTP/1.1 200 OK\r\n\r\nbody\n\nmore", URL="http://x/a%20b", IP_address="1.2.3.4", Archive_date="20010203040506", Content_type="text/html", Result_code="200")
    head, record = wa.read_arc(io.BytesIO(data))
    assert head.fields["URL"] == "filedesc://a.arc" and wa.warc_type(head) == "warcinfo"
    assert tuple(record.fields) == wa.ARC_FIELDS[version] and record.block.endswith(b"body\n\nmore")
    headers, block = next(iter(wa.read_warc(io.BytesIO(wa.convert(record, "a.arc", 1)))))
    assert headers["WARC-Type"] == "response" and headers["WARC-Date"] == "2001-02-03T04:05:06Z" and block == record.block
    assert headers["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(b"body\n\nmore").hexdigest()
    assert headers["WARC-Record-ID"] == wa.record_id("a.arc", 1) != wa.record_id("a.arc", 2)
    info, _ = next(iter(wa.read_warc(io.BytesIO(wa.convert(head, "a.arc", 0)))))
    assert info["WARC-Type"] == "warcinfo" and info["WARC-Filename"] == "a.arc"


def test_blanks_in_urls_and_other_types():
    data = wa.arc_version_block("a", 1, "2001") + wa.arc_record(1, b"1.2.3.4", URL="dns:some host", IP_address="-", Archive_date="200102", Content_type="text/dns")
    record = list(wa.read_arc(io.BytesIO(data)))[1]
    assert record.fields["URL"] == "dns:some host" and wa.warc_type(record) == "resource"
    assert wa.timestamp("200102") == "2001-02-01T00:00:00Z"


@pytest.mark.parametrize("cut", [5, -1, -4])
def test_damage_raises(cut):
    whole = wa.arc_version_block("a", 1, "20010203040506") + wa.arc_record(1, b"x" * 50, URL="u", Archive_date="2001")
    with pytest.raises(ValueError):
        list(wa.read_arc(io.BytesIO(whole[:cut] if cut > 0 else whole[: cut - 3])))
    with pytest.raises(ValueError):
        list(wa.read_arc(io.BytesIO(b"http://x - - - 3\nabc\n")))


def test_against_sql(agree):
    agree(wa.op9_warc, wa.ORACLE_SQL["op9_warc"], "/root/testdata/sf0.001")


def test_revisits(spark, tmp_path, agree):
    rows = [(k, f"http://h/{k} x", LONG) for k in range(60, 20, -1)] + [(5, None, None), (6, "", ""), (7, "\n", "short"), (8, "u", "short"), (9, "u", "é" * 49 + "xy"), (10, "u", "é" * 49 + "xy"), (11, "u", "HTTP/1.1 \r\n\r\n" * 30), (12, "u", "y" * 300_000)]
    spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, archive int, number string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    agree(wa.op9_warc, wa.ORACLE_SQL["op9_warc"], str(tmp_path))
    got = wa.op9_warc(spark, str(tmp_path)).collect()
    assert Counter(r.record_type for r in got if r.payload_bytes == len(LONG)) == {"response": 1, "revisit": 39}
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {21, 9}


def test_nulls_and_repeats(spark, tmp_path):
    rows = [(1, "u", LONG), (1, "u", LONG), (None, "u", LONG), (None, "u", "n" * 200), (None, "v", "n" * 200)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in wa.op9_warc(spark, str(tmp_path)).collect())
    assert got == {(1, "response", None): 1, (1, "revisit", 1): 1, (None, "revisit", 1): 1, (None, "response", None): 1, (None, "revisit", None): 1}
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/no/pages.parquet")
    assert wa.op9_warc(spark, f"{tmp_path}/no").count() == 0


def test_small_files(spark, tmp_path):
    frame = spark.createDataFrame([(k, "u", f"{k} " * 400) for k in range(30)], "page_id long, url string, html string").coalesce(1)
    arcs = wa.write_arcs(frame, str(tmp_path), file_bytes=800).collect()
    assert len(arcs) > 3 and sum(r.n_records for r in arcs) == 30
    index = wa.index_arcs(spark.createDataFrame(arcs), 2).collect()
    assert sorted(r.page_id for r in index) == list(range(30))
