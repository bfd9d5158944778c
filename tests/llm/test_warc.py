"""WARC archives: round trips, the index, and SQL."""

import gzip
import os
import zlib

import oracle
import pytest
from pyspark.sql import functions as F
from signpost.llm import warc
from signpost.llm.queries import QUERIES, SQL
from signpost.session import scratch_dir

SF = "/root/testdata/sf0.001"
KIND = "page_id long, url string, html string, value int"
ROWS = [
    (1, "http://a/ b\n", "<a>é\r\n\r\n</a>\r\n"),
    (2, "http://b", "<a>é\r\n\r\n</a>\r\n"),
    (3, None, None),
    (4, "x", ""),
    (None, "x", ""),
    (None, "y", "z\r\r\n\r\n\r"),
    (7, "q", "\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"),
    (7, "q", "other"),
    (9, "u", "<a>é\r\n\r\n</a>\r\n"),
    (9, "u", "<a>é\r\n\r\n</a>\r\n"),
    (10, "big", "0123456789" * 900_000),
]


@pytest.fixture(scope="module")
def archives(spark):
    pages = spark.createDataFrame([(*r, 1) for r in ROWS], KIND).repartition(3)
    source, target = scratch_dir(spark, "m"), scratch_dir(spark, "n")
    warc.write_monolithic(pages, source)
    warc.normalize(spark, source, target)
    return source, target


def test_records(spark, archives):
    for path in (archives[0], f"{archives[1]}/archive"):
        got = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in warc.read_pages(spark, path).collect()}
        assert got == {
            (1, 15): ("revisit", 9), (2, 15): ("revisit", 9), (9, 15): ("response", None),
            (3, 0): ("revisit", 4), (4, 0): ("response", None), (None, 0): ("revisit", 4),
            (None, 7): ("response", None), (7, 5): ("response", None), (7, 35): ("response", None),
            (10, 9_000_000): ("response", None),
        }
    assert warc.read_pages(spark, archives[0]).count() == len(ROWS)


def test_index_points_at_members(spark, archives):
    folder = f"{archives[1]}/archive".removeprefix("file:")
    index = warc.read_index(spark, archives[1]).collect()
    assert len(index) == len(ROWS)
    covered = {}
    for r in index:
        with open(os.path.join(folder, r.file), "rb") as f:
            f.seek(r.offset)
            inflate = zlib.decompressobj(31)
            record = inflate.decompress(f.read(r.length))
        assert inflate.eof and not inflate.unused_data
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and r.id.encode() in record
        covered[r.file] = covered.get(r.file, 0) + len(record)
    for name in os.listdir(folder):
        if name.endswith(".gz"):
            with gzip.open(os.path.join(folder, name)) as f:
                assert len(f.read()) == covered[name]


def test_small_payloads_can_be_left_alone(spark):
    pages = spark.createDataFrame([(1, "u", "ab", 1), (2, "u", "ab", 1), (3, "u", "abc", 1), (4, "u", "abc", 1)], KIND)
    assert {r.page_id for r in warc.revisits(pages, least_bytes=3).collect()} == {3}


def test_any_cut_of_the_stream():
    record = b"WARC/1.0\r\nContent-Length: 7\r\n\r\nab\r\n\r\nc\r\n\r\n"
    for step in (1, 2, 3, 5, 100):
        parser = warc.Records()
        stream = b"\r\n" + record * 3
        found = [r for i in range(0, len(stream), step) for r in parser.feed(stream[i : i + step])]
        parser.close()
        assert [b for _, b in found] == [b"ab\r\n\r\nc"] * 3


def test_broken_archives():
    parser = warc.Records()
    list(parser.feed(b"WARC/1.0\r\nContent-Length: 7\r\n\r\nab"))
    with pytest.raises(ValueError):
        parser.close()
    with pytest.raises(ValueError):
        list(warc.Records().feed(b"HTTP/1.1 200\r\n\r\n"))


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], KIND)).count() == 0


def test_query_against_sql(spark):
    assert oracle.compare(QUERIES["op2_warc"](spark, SF), oracle.connect(SF), SQL["op2_warc"]) > 0


def test_a_payload_is_digested_once(spark):
    """The SHA-1 stands outside the function that runs for each group of digits."""
    import base64
    import hashlib

    rows = spark.createDataFrame([("a",), ("",), ("é" * 1000,)], "t string")
    coded = rows.select("t", warc.base32_sha1(F.encode("t", "UTF-8")).alias("digest"))
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    assert "array_repeat(sha1" in plan
    for r in coded.collect():
        assert r.digest == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode()
