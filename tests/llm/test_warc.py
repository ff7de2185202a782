import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from linkweave.llm import warc

PAGES = "page_id long, url string, html string, digest string, block string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)


def trip(spark, tmp_path, rows, **options):
    path = str(tmp_path / "archives")
    warc.write_archives(pages(spark, rows), path, **options)
    return warc.read_archives(spark, path).collect(), path


ROWS = [(3, "http://a/3", "<p>same</p>"), (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "é😀" * 5000), (4, None, None), (5, "http://a/5\r\nX: y", ""), (6, "u", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\n"), (7, "u", "0\r\n\r\n5\r\nabc")]


@pytest.mark.parametrize("segment", [64, 500, 16384])
def test_round_trip(spark, tmp_path, segment):
    rows, _ = trip(spark, tmp_path, ROWS, segment_bytes=segment, chunk_bytes=37, records_per_file=2)
    got = {r["page_id"]: r for r in rows}
    assert len(rows) == len(ROWS)
    for page, _, html in ROWS:
        raw = (html or "").encode()
        assert got[page]["declared_bytes"] == len(raw)
        assert got[page]["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        if got[page]["record_type"] == "response":
            assert bytes(got[page]["payload"]) == raw
    assert {p: (got[p]["record_type"], got[p]["refers_to"]) for p in (1, 3, 4, 5)} == {1: ("response", None), 3: ("revisit", 1), 4: ("response", None), 5: ("revisit", 4)}


def test_small_payloads_can_stay_responses(spark, tmp_path):
    rows, _ = trip(spark, tmp_path, ROWS, min_revisit_bytes=1)
    assert {r["page_id"] for r in rows if r["record_type"] == "revisit"} == {3}


def test_nulls_repeats_and_no_rows(spark, tmp_path):
    rows, _ = trip(spark, tmp_path, [(None, None, "x"), (1, "u", "x"), (1, "u", "x"), (None, None, "y"), (None, None, "y")])
    assert sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in rows) == [("1", "response", "None"), ("1", "response", "None"), ("None", "response", "None"), ("None", "response", "None"), ("None", "revisit", "1")]
    assert trip(spark, tmp_path / "none", [])[0] == []


def test_files_are_plain_warc(spark, tmp_path):
    _, path = trip(spark, tmp_path, ROWS, segment_bytes=500)
    data = b"".join(bytes(r[0]) for r in spark.read.format("binaryFile").load(path).where(F.col("path").contains("part-")).select("content").collect())
    kinds = [h["warc-type"] for h, _ in warc.parse(data)]
    assert kinds.count("continuation") > 3
    assert kinds.count("revisit") == 2


def test_damage_is_told():
    ok = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(ok * 2)] == [b"abc"] * 2
    for bad in (ok[:-4], ok.replace(b": 3", b": 4"), b"junk" + ok):
        with pytest.raises(ValueError):
            list(warc.parse(bad))
    assert warc.unchunk(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    for bad in (b"3\r\nab", b"3\r\nabcXX", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunk(bad)


def test_missing_segments_are_told(spark, tmp_path):
    path = tmp_path / "a"
    path.mkdir()
    head = "WARC/1.1\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:uuid:{}>\r\nWARC-Segment-Number: {}\r\n{}Content-Length: 3\r\n\r\nabc\r\n\r\n"
    first = head.format("response", "x", 1, "")
    third = head.format("continuation", "x-3", 3, "WARC-Segment-Origin-ID: <urn:uuid:x>\r\nWARC-Segment-Total-Length: 9\r\n")
    (path / "part-0").write_bytes((first + third).encode())
    with pytest.raises(Exception, match="segments"):
        warc.read_archives(spark, str(path)).collect()
