import io

import pytest
import zstandard

from vidpulse.llm import warc
from vidpulse.llm.queries import QUERIES

ROWS = [
    (1, "http://a/\nb", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 100_000),
    (6, "u", "\r\n\r\n"), (6, "u", "\r\n\r\n"), (None, "u", "x"), (None, "u", "alone"), (0, "q", "\r\n\r\n"), (9, "u", "HTTP/1.1"),
]


def brute(rows):
    first, found = {}, []
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for i, _, h in rows:
        raw, head = (h or "").encode(), first.get(h or "")
        revisit = head is not None and head != i
        found.append((i, len(raw), warc.digest(raw), "revisit" if revisit else "response", head if revisit else None))
    return sorted(found, key=str)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)


def test_odd_rows(spark, pages):
    archives = warc.write_archives(pages)
    rows = warc.read_archives(spark, archives)
    assert found(rows) == brute(ROWS)
    held = {r.page_id: bytes(r.payload) for r in rows.filter("record_type = 'response'").collect()}
    assert held[5] == ("é" * 100_000).encode() and held[3] == b""
    assert {r.url for r in rows.filter("page_id = 1").collect()} == {"http://a/%0Ab"}


def test_small_payloads_are_never_revisits(spark, pages):
    rows = warc.read_archives(spark, warc.write_archives(pages, least=2)).collect()
    assert {r.page_id for r in rows if r.record_type == "revisit"} == {6}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(QUERIES["op5_warc"](spark, sf_dir)) == brute(rows)


def test_copies_refer_to_the_first(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id % 20 * 7 as k", "page_id", "url", "html")
    first = pages.filter("page_id < 20").selectExpr("k", "html as same")
    copies = pages.drop("html").join(first, "k").selectExpr("page_id", "url", "same as html")
    rows = [tuple(r) for r in copies.select("page_id", "url", "html").collect()]
    assert found(warc.read_archives(spark, warc.write_archives(copies))) == brute(rows)


def test_empty_table(spark, pages):
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0))).count() == 0


def test_an_archive_begins_with_its_dictionary_and_has_a_frame_per_record():
    content = zstandard.train_dictionary(4096, [f"<html>{k} the same words {k % 7}</html>".encode() * 3 for k in range(400)]).as_bytes()
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content)).compress
    raw = [warc.record(k, f"http://x/{k}", b"<html>the same words</html>", None) for k in range(3)]
    data = warc.dictionary_frame(content) + b"".join(map(pack, raw))
    assert data[:4] == bytes.fromhex("5d2a4d18") and list(warc.frames(io.BytesIO(data))) == raw
    assert [warc.parse(r)["page_id"] for r in raw] == [0, 1, 2]
    with pytest.raises(ValueError, match="within a frame"):
        list(warc.frames(io.BytesIO(data[:-3])))
    with pytest.raises(ValueError, match="no frame"):
        list(warc.frames(io.BytesIO(data + b"garbage")))


GOOD = warc.record(1, "http://x", b"payload", None)


@pytest.mark.parametrize(
    ("old", "new", "told"),
    [
        (b"WARC/1.1", b"WARC/9", "not a WARC"),
        (b"WARC-Date: ", b"WARC Date: ", "without a name"),
        (b"WARC-Date: " + warc.DATE.encode() + b"\r\n", b"", "missing"),
        (b"payload\r\n\r\n", b"payload!\r\n\r\n", "Content-Length"),
        (b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n", "block's digest"),
        (b"WARC-Type: response", b"WARC-Type: whatever", "unknown type"),
        (b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A", "payload differs"),
        (b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Type: response", "twice"),
    ],
)
def test_broken_records_are_told(old, new, told):
    assert warc.parse(GOOD)["payload"] == b"payload"
    with pytest.raises(ValueError, match=told):
        warc.parse(GOOD.replace(old, new, 1))
