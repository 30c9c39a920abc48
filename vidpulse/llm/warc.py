"""WARC archives under Zstandard: a dictionary first, then one frame per record.

An archive begins with a skippable frame that holds the dictionary (itself a Zstandard
frame), followed by frames that each decompress to exactly one WARC 1.1 record with it.
The reader loads the dictionary, walks the frames, and checks what it reads: magic
numbers, the version line, header syntax, mandatory fields, ``Content-Length`` against
the block, the two line ends behind it, the HTTP header, and the payload's length and digest.

Pages with equal payloads are written once as a ``response``; the others become a
``revisit`` with the HTTP header alone, which refers to the page with the smallest id.

Defined results: a null html is an empty payload; a null url leaves out the target;
line ends in a url are percent-encoded; repeated rows of the smallest id are all
responses; a page without an id revisits the smallest id there is, and without one
is a response; an empty table writes no archive. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.llm.common import file_system, new_folder, slices
from vidpulse.session import stage

#: Skippable frame that marks a dictionary, the dictionary's and a Zstandard frame's magic.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
#: Bytes of the dictionary, pages it is trained on, and bytes of each that count.
DICTIONARY_BYTES = 64 << 10
SAMPLE_PAGES = 512
SAMPLE_BYTES = 16 << 10
#: Payloads shorter than this are never revisits.
LEAST_REVISIT = 0
#: A new archive is begun after this many compressed bytes.
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 4 << 20
LEVEL = 3

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = re.compile(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit where ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    known = page_id is not None
    name = f"page:{page_id}" if known else f"unnamed:{uuid.uuid5(uuid.NAMESPACE_URL, (url or '') + digest(payload))}"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        clean = "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url)
        fields.insert(3, ("WARC-Target-URI", clean))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def head_fields(raw: bytes) -> dict[str, str]:
    """The named fields of a head, names in lower case; raises on bad syntax."""
    fields: dict[str, str] = {}
    for line in raw.decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not NAME.fullmatch(name):
            raise ValueError(f"a field without a name: {line[:80]!r}")
        if name.lower() in fields:
            raise ValueError(f"{name} is given twice")
        fields[name.lower()] = value.strip(" \t")
    return fields


def page_of(name: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name)
    return int(found[1]) if found else None


def parse(raw: bytes) -> dict:
    """The page of one whole record; raises where it breaks a rule."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version.decode() != VERSION:
        raise ValueError("not a WARC 1.1 record")
    fields = head_fields(lines)
    if missing := [x for x in MANDATORY if x not in fields]:
        raise ValueError(f"fields are missing: {missing}")
    if not fields["content-length"].isdigit():
        raise ValueError("the content length is no number")
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("the block's length differs from Content-Length")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("the block's digest differs")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unknown type {kind!r}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not gap or not re.fullmatch(rb"HTTP/1\.[01] \d{3}( .*)?", status):
        raise ValueError("the block is no HTTP response")
    length = int(head_fields(lines)["content-length"])
    told = fields.get("warc-payload-digest", "")
    if not told.startswith("sha1:"):
        raise ValueError("no payload digest")
    if kind == "response" and (length != len(payload) or told != f"sha1:{digest(payload)}"):
        raise ValueError("the payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit with a payload or without a target")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": length,
        "payload_digest": told[5:],
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
    }


def dictionary_frame(content: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(content)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def train(pages: DataFrame, html: str = "html") -> bytes | None:
    """A dictionary from a bounded sample of pages by their hash; none where too few pages are there."""
    total = pages.count()
    if not total:
        return None
    share = min(1.0, 2 * SAMPLE_PAGES / total)
    mark = F.xxhash64(html)
    drawn = pages.filter(F.col(html).isNotNull() & (mark <= F.lit(min(2**63 - 1, int(share * 2**64) - 2**63))))
    drawn = drawn.select(mark.alias("mark"), F.substring(html, 1, SAMPLE_BYTES).alias("html"))
    drawn = drawn.dropDuplicates(["mark"]).orderBy("mark").limit(SAMPLE_PAGES)
    samples = [r["html"].encode()[:SAMPLE_BYTES] for r in drawn.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s for s in samples if len(s) >= 8]).as_bytes()
    except zstandard.ZstdError:
        return None


def first_pages(pages: DataFrame, least: int, page_id: str, html: str) -> DataFrame:
    """``(sha, refers_to)``: the smallest id of every payload that several pages have."""
    payload = F.coalesce(F.col(html), F.lit(""))
    told = pages.select(F.sha1(payload).alias("sha"), F.col(page_id).cast("long").alias("id"), F.octet_length(payload).alias("size"))
    same = told.filter(F.col("size") >= least).groupBy("sha").agg(F.min("id").alias("refers_to"), F.count("*").alias("n"))
    return same.filter("n > 1").select("sha", "refers_to")


def write_archives(
    pages: DataFrame, least: int = LEAST_REVISIT, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write all pages; returns the archives: ``path, records, bytes``.

    A task that is run again writes another archive, and only those of this table count.
    """
    spark = pages.sparkSession
    content = train(pages, html)
    folder = new_folder(spark, "warc")
    first = stage(first_pages(pages, least, page_id, html), "payloads")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.coalesce("html", F.lit(""))))
    rows = rows.join(first, "sha", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("refers_to")), F.col("refers_to")).alias("refers_to")
    )

    def run(batches):
        held = zstandard.ZstdCompressionDict(content) if content else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=True, write_checksum=True).compress
        lead = dictionary_frame(content) if content else b""
        out, name, count, number = None, None, 0, 0

        def told():
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_pylist([{"path": name, "records": count, "bytes": size}])

        for batch in batches:
            for part in slices(batch, "html"):
                for page, address, text, refers in zip(*(c.to_pylist() for c in part.columns)):
                    if out is None:
                        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{number}-{uuid.uuid4().hex}.warc.zst"
                        fs, local = file_system(name)
                        out, count, number = fs.open_output_stream(local), 0, number + 1
                        out.write(lead)
                    out.write(pack(record(page, address, (text or "").encode(), refers)))
                    count += 1
                    if out.tell() >= ARCHIVE_BYTES:
                        yield told()
                        out = None
        if out is not None:
            yield told()

    return stage(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


def frames(source):
    """``(dictionary or None, record)`` of each frame; the source is read in bounded pieces."""
    held = source.read(8)
    dictionary = None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == DICTIONARY_FRAME:
        (size,) = struct.unpack("<I", held[4:])
        content = source.read(size)
        if len(content) != size:
            raise ValueError("the dictionary ends early")
        if content[:4] == FRAME_MAGIC:
            content = zstandard.ZstdDecompressor().decompress(content)
        if content[:4] != DICTIONARY_MAGIC:
            raise ValueError("the leading frame holds no dictionary")
        dictionary, held = zstandard.ZstdCompressionDict(content), b""
    unpack = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        if len(held) < 4:
            held += source.read(READ_BYTES)
        if not held:
            return
        if held[:4] != FRAME_MAGIC:
            raise ValueError("no frame begins where one should")
        frame, parts = unpack.decompressobj(), []
        while True:
            parts.append(frame.decompress(held))
            if frame.eof:
                held = frame.unused_data
                break
            held = source.read(READ_BYTES)
            if not held:
                raise ValueError("the archive ends within a frame")
        yield b"".join(parts)


def read_archive(path: str):
    """The pages of an archive's records, one after the other."""
    fs, local = file_system(path)
    with fs.open_input_stream(local) as source:
        for raw in frames(source):
            yield parse(raw)


COLUMNS = {
    "page_id": pa.int64(),
    "url": pa.string(),
    "payload": pa.binary(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
}


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record; without ``payloads`` the payload is checked and left out."""
    names = [c for c in COLUMNS if payloads or c != "payload"]
    kinds = pa.schema([(c, COLUMNS[c]) for c in names])

    def run(batches):
        for batch in batches:
            for path, wanted in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                rows, size, seen = [], 0, 0
                for page in read_archive(path):
                    seen += 1
                    size += len(page["payload"] or b"")
                    rows.append({c: page[c] for c in names})
                    if size >= READ_BYTES or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, size = [], 0
                if seen != wanted:
                    raise ValueError(f"{path} has {seen} records, not {wanted}")
                yield pa.RecordBatch.from_pylist(rows, kinds)

    schema = "page_id long, url string, " + ("payload binary, " if payloads else "")
    schema += "payload_bytes long, payload_digest string, record_type string, refers_to long"
    dealt = archives.select("path", "records").repartitionByRange(max(1, archives.count()), "path")
    return dealt.mapInArrow(run, schema)
