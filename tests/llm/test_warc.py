import base64
import gzip
import hashlib
import io
import zlib

import pytest
from costmart.llm import queries, warc
from costmart.session import scratch_path

SF = "/root/testdata/sf0.001"


def digest(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def check(rows, pages, min_revisit=0):
    want = {}
    for page_id, html in pages:
        want.setdefault((html or "").encode(), []).append(page_id)
    assert sorted(map(str, (r.page_id for r in rows))) == sorted(str(p) for p, _ in pages)
    text = dict(pages)
    for r in rows:
        raw = (text[r.page_id] or "").encode()
        largest = max((i for i in want[raw] if i is not None), default=None)
        assert (r.payload_bytes, r.payload_digest) == (len(raw), digest(raw))
        if r.page_id == largest or largest is None or len(raw) < min_revisit:
            assert (r.record_type, r.refers_to) == ("response", None)
        else:
            assert (r.record_type, r.refers_to) == ("revisit", largest)


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    check(queries.op4_warc(spark, SF).collect(), pages)


PAGES = [
    (1, "u", "<p>a</p>"), (2, None, "<p>a</p>"), (3, "has space\nand line", ""), (4, "u", None), (9, "x", "é" * 70000),
    (8, "x", "é" * 70000), (None, "n", "<p>a</p>"), (7, "y", "\x1f\u008b\x08 WARC/1.1\r\n\r\n"), (9, "x", "é" * 70000),
]


@pytest.mark.parametrize("range_bytes", [37, 1000, 1 << 20])
def test_round_trip(spark, range_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write(pages.coalesce(2), path)
    rows = warc.read(spark, path, range_bytes).collect()
    check(rows, [(p, h) for p, _, h in PAGES])
    for r in rows:
        if r.record_type == "response":
            assert bytes(r.payload) == (dict((p, h) for p, _, h in PAGES)[r.page_id] or "").encode()


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    check(warc.round_trip(pages, min_revisit=100).collect(), [(p, h) for p, _, h in PAGES], 100)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_members_are_plain_gzip_and_large_ones_end_with_zero():
    raw = bytes(17 << 20)
    member = warc._member(5, "u", raw, digest(raw), len(raw), None)
    assert member[-1] == 0
    assert warc.parse(gzip.decompress(member))["payload"] == raw
    found = list(warc.records(io.BytesIO(member + warc._member(6, "u", b"x", digest(b"x"), 1, None)), 0, 1 << 30))
    assert [warc.parse(m)["page_id"] for _, m in found] == [5, 6]


def test_magic_that_is_no_record_is_passed_over():
    good = warc._member(1, "u", b"x", digest(b"x"), 1, None)
    other = zlib.compressobj(1, zlib.DEFLATED, 31)
    other = other.compress(b"no such record") + other.flush()
    archive = warc.MAGIC + b"junk" + other + good + warc.MAGIC
    for cut in range(len(archive)):
        parts = [(0, cut), (cut, len(archive))]
        found = [warc.parse(m)["page_id"] for a, b in parts for _, m in warc.records(io.BytesIO(archive), a, b)]
        assert found == [1]


def test_a_changed_payload_is_noticed():
    member = gzip.decompress(warc._member(1, "u", b"payload", digest(b"other"), 7, None))
    with pytest.raises(ValueError, match="digest"):
        warc.parse(member)


def test_urls_come_back_as_they_were(spark):
    urls = ["https://münchen.example/straße?q=ä b#é", "http://x.org/a%20b?c=%C3%A9&d=1", "日本.example", "u", "a:b\\c\"d"]
    rows = [(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)] + [(99, None, "x"), (98, "two\r\nlines\t ", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.url for r in warc.round_trip(pages).collect()}
    assert [got[i] for i in range(len(urls))] == urls and got[99] is None
    assert got[98] == "two%0D%0Alines%09%20"
