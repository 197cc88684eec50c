import base64
import hashlib
import io
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from sheetdoc.llm import warc
from sheetdoc.llm.queries import op12_warc_archives

SCHEMA = "page_id long, url string, html string, row long, first string, payload string, sha1 string"


def plain(rows):
    """(page_id, bytes, digest, type, refers_to) per row, by dictionary."""
    groups = {}
    for i, (p, _, html) in enumerate(rows):
        groups.setdefault((html or "").encode(), []).append((p is None, p or 0, i, p))
    out = []
    for data, members in groups.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = min(members)
        for m in members:
            out.append((m[3], len(data), digest, "response" if m is first else "revisit", None if m is first else first[3]))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def pages(n=400, seed=3):
    r = random.Random(seed)
    words = "<p> the page of a site with links and </p> <a href=x> more".split()
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(300))) + str(i) for i in range(n // 2)]
    rows = [(i, f"http://h{i % 7}.org/{i}", texts[r.randrange(len(texts))] if i % 3 else "the frequent page é") for i in range(n)]
    rows += [(n, None, None), (n + 1, "", ""), (n + 1, "", ""), (None, "u", "no id"), (None, "u", "no id"), (n + 2, "http://a b\r\nc", "x"),
             (n + 3, "long", "é" * 3_000_000), (2**60 + 1, "big", "no id")]
    r.shuffle(rows)
    return rows


def test_written_and_read_back(spark):
    rows = pages()
    frame = spark.createDataFrame([(*x, 1, "f", "p", "s") for x in rows], SCHEMA)
    files = warc.write_archives(frame)
    got = warc.read_archives(files, payload=True).collect()
    flat = [(None if r.page_id is None else int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, None if r.refers_to is None else int(r.refers_to)) for r in got]
    assert sorted(flat, key=key) == sorted(plain(rows), key=key)
    by_digest = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): (h or "").encode() for _, _, h in rows}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert all(bytes(r.payload) == by_digest[r.payload_digest] for r in got if r.payload is not None)
    urls = {r.page_id: r.url for r in got}
    assert urls["400"] is None and urls["402"] == "http://a%20b%0D%0Ac"
    total = files.agg(F.sum("records"), F.sum("raw_bytes"), F.sum("bytes")).first()
    assert total[0] == len(rows) and total[2] < total[1] / 4


def test_archive_layout():
    records = [warc.encode_record(str(i), f"http://x/{i}", f"<p>text {i} {'word ' * (i % 50)}</p>".encode() * 9, "D" * 32, 1, i, None) for i in range(900)]
    data = b"".join(warc.pack(records))
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and len(data) > 8 + size
    book = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    assert book.dict_id() and struct.unpack("<I", data[8 + size : 12 + size])[0] == 0xFD2FB528
    got = list(warc.unpack(io.BytesIO(data)))
    assert [r for _, r in got] == records
    plain_size = sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    assert len(data) - size < plain_size
    # any record can be read from its offset alone
    at, end = got[500][0], got[501][0]
    assert zstandard.ZstdDecompressor(dict_data=book).decompress(data[at:end]) == records[500]


def test_few_records_have_no_dictionary():
    data = b"".join(warc.pack([b"one", b"two"]))
    assert [r for _, r in warc.unpack(io.BytesIO(data))] == [b"one", b"two"]
    assert list(warc.unpack(io.BytesIO(b""))) == []


def test_damage_is_found():
    record = warc.encode_record("1", "u", b"payload", warc.base32_sha1(b"payload"), 7, 0, None)
    assert warc.decode_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.decode_record(record.replace(b"payload\r\n", b"payloae\r\n"))
    data = b"".join(warc.pack([record]))
    with pytest.raises(ValueError):
        list(warc.unpack(io.BytesIO(data[:-3])))


def test_archives_are_closed_by_size(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "u", "x" * 100 + str(i)) for i in range(50)], "page_id long, url string, html string")
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1 << 30)
    assert warc.write_archives(frame.limit(0)).count() == 0
    files = warc.write_archives(frame)
    assert warc.read_archives(files).count() == 50


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op12_warc_archives(spark, sf).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
