"""WARC archives with a Zstandard dictionary: writer and reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds a dictionary built from the
archive's own records; every record follows as a Zstandard frame of its own, so that a reader can
start at any record. Of pages with equal payloads the one with the smallest id is written as a
``response`` record, the others as ``revisit`` records without a payload that name it.

Payloads are not shuffled to be written: a task takes the pages of its part of the staged table in
their order there, and closes an archive once ``ARCHIVE_BYTES`` of records are buffered. It writes to
a name of its own and renames the file when it is complete, so a task that is repeated (a lost
executor, speculation) replaces a file by an equal one; only files that the writer reports are read. The folder must be one that all executors share; paths with a scheme go
through ``pyarrow.fs``.

Equal payloads are found by SHA-1 and length, as web archives do. The least id of a payload is
aggregated before the shuffle. Payloads that make up over a thousandth of all pages (so at most a
thousand of them, a proven bound) are looked up in a broadcast table, the others by a join, so that
no task gets all copies of a frequent payload.

Rows: a null payload is written as an empty one. A page without an id has no id field and comes
after all ids when a response is chosen. Of equal rows one is the response and the others revisit
it. A null URL leaves the field out; white space and control characters in one are written
percent-encoded. An empty table gives no archives. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetdoc.llm.common import bound_batches, stage
from sheetdoc.session import ensure_checkpoint_dir

#: Uncompressed bytes of records after which an archive is closed.
ARCHIVE_BYTES = 32 << 20
#: Size of a dictionary, and bytes of records (spread evenly over the archive) it is built from.
DICTIONARY_BYTES, DICTIONARY_SOURCE = 64 << 10, 6 << 20
#: Pages of which a payload must be one in this many to be looked up by broadcast.
FREQUENT = 1000
#: Rows of a batch handed to Python: pages differ widely in length.
BATCH_ROWS = 128
LEVEL = 3

SKIPPABLE, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
DATE = "1970-01-01T00:00:00Z"  # the tables have no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 20

FILES = "archive string, records long, raw_bytes long, bytes long"
RECORDS = ("archive string, offset long, record_id string, record_type string, page_id string, url string, payload_digest string, "
           "payload_bytes long, refers_to string")


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path)


# --- records -------------------------------------------------------------------------------------

def _record_id(page_id: str | None, digest: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{row}')}>"


def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url)


def encode_record(page_id: str | None, url: str | None, payload: bytes | None, digest: str, length: int, row: int,
                  first: tuple[str | None, int] | None) -> bytes:
    """A response record, or the revisit of ``first`` (page id and row of the response)."""
    revisit = first is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    if not revisit:
        block += payload or b""
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest, row)),
        ("WARC-Date", DATE), ("WARC-Target-URI", None if url is None else _clean(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Page-ID", page_id),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first[0], digest, first[1])), ("Refers-To-Page-ID", first[0])]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.decode().lower(): v.decode().strip() for k, _, v in (line.partition(b":") for line in lines)}


def decode_record(raw: bytes) -> dict:
    """Fields and payload (None in a revisit) of a record; raises ValueError if it is damaged."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    f = _fields(lines)
    if version != b"WARC/1.1" or len(rest) != int(f.get("content-length", -1)) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError(f"damaged record {f.get('warc-record-id')}")
    http, _, body = rest[:-4].partition(b"\r\n\r\n")
    length, digest = int(_fields(http.split(b"\r\n")[1:])["content-length"]), f["warc-payload-digest"].removeprefix("sha1:")
    payload = None
    if f["warc-type"] == "response":
        payload = body
        if len(body) != length or base32_sha1(body) != digest:
            raise ValueError(f"payload of {f.get('warc-record-id')} does not match its digest")
    return {
        "record_id": f["warc-record-id"], "record_type": f["warc-type"], "page_id": f.get("page-id"), "url": f.get("warc-target-uri"),
        "payload_digest": digest, "payload_bytes": length, "refers_to": f.get("refers-to-page-id"), "payload": payload,
    }


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- archives ------------------------------------------------------------------------------------

def build_dictionary(records: list[bytes]) -> bytes | None:
    """A dictionary for ``records``, from pieces spread evenly over all of them; None where they
    are too few to learn from."""
    piece = 64 << 10
    total = sum(map(len, records))
    step = max(1, -(-total // DICTIONARY_SOURCE))
    pieces = [r[i : i + piece] for r in records for i in range(0, len(r), piece)][::step]
    if len(pieces) < 8 or sum(map(len, pieces)) < 2 * DICTIONARY_BYTES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # records that have nothing in common
        return None


def pack(records: list[bytes]) -> Iterator[bytes]:
    """Parts of an archive: the dictionary in a skippable frame, then a frame for each record."""
    book = build_dictionary(records)
    if book is not None:
        yield struct.pack("<II", SKIPPABLE, len(book)) + book
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(book) if book else None, write_checksum=True)
    for r in records:
        yield press.compress(r)


def unpack(source) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of each record of an open archive, one record at a time."""
    buffer, at, book, first = b"", 0, None, True
    while True:
        if len(buffer) < 8:
            more = source.read(_READ)
            if not more and not buffer:
                return
            buffer += more
        if len(buffer) < 4:
            raise ValueError("archive ends within a frame")
        magic = struct.unpack("<I", buffer[:4])[0]
        if magic == SKIPPABLE and first:
            size = 8 + struct.unpack("<I", buffer[4:8])[0]
            while len(buffer) < size:
                more = source.read(_READ)
                if not more:
                    raise ValueError("archive ends within its dictionary")
                buffer += more
            raw = buffer[8:size]
            if raw[:4] == struct.pack("<I", ZSTD_FRAME):  # the dictionary may be compressed itself
                raw = zstandard.ZstdDecompressor().decompress(raw)
            book, buffer, at = zstandard.ZstdCompressionDict(raw), buffer[size:], at + size
        else:
            frame, parts, start = zstandard.ZstdDecompressor(dict_data=book).decompressobj(), [], at
            while not frame.eof:
                if not buffer:
                    buffer = source.read(_READ)
                    if not buffer:
                        raise ValueError("archive ends within a record")
                parts.append(frame.decompress(buffer))
                rest = frame.unused_data if frame.eof else b""
                at, buffer = at + len(buffer) - len(rest), rest
            yield start, b"".join(parts)
        first = False


# --- operators -----------------------------------------------------------------------------------

def _with_roles(rows: DataFrame) -> DataFrame:
    """``rows`` (page_id, row, sha1, length, ...) with ``first``: page id and row of the response
    of the same payload."""
    best = F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "row")).alias("first")
    groups = stage(rows.groupBy("sha1", "length").agg(best, F.count("*").alias("copies")).where("copies > 1"), "warc-payloads")
    total = rows.count()
    hot = groups.where(F.col("copies") * FREQUENT > total).select("sha1", "length", F.col("first").alias("hot"))
    rare = groups.where(F.col("copies") * FREQUENT <= total).select(F.concat_ws("/", "sha1", "length").alias("key"), F.col("first").alias("rare"))
    # rows that are looked up already get keys of their own, which match nothing and lie anywhere
    keyed = rows.join(F.broadcast(hot), ["sha1", "length"], "left").withColumn(
        "key", F.when(F.col("hot").isNull(), F.concat_ws("/", "sha1", "length")).otherwise(F.col("row").cast("string")))
    first = F.coalesce("hot", "rare")
    return keyed.join(rare, "key", "left").withColumn(
        "first", F.when(first["row"] != F.col("row"), first)).drop("key", "hot", "rare")


def write_archives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` to ``*.warc.zst`` files in ``folder`` (by default a new one in the session's
    checkpoint folder) and return the files: archive, records, raw_bytes, bytes."""
    spark = pages.sparkSession
    bound_batches(spark, BATCH_ROWS)
    folder = f"{folder or ensure_checkpoint_dir(spark)}".rstrip("/") + f"/warc-{uuid.uuid4().hex}"
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), body.alias("payload")).withColumns({
        "sha1": F.sha1("payload"), "length": F.octet_length("payload").cast("long"), "row": F.monotonically_increasing_id()})
    roles = _with_roles(stage(rows, "warc-pages"))
    ready = roles.select(
        F.col("page_id").cast("string").alias("page_id"), "url",
        F.when(F.col("first").isNull(), F.col("payload")).alias("payload"), "sha1", "length", "row",
        F.col("first.page_id").cast("string").alias("first_id"), F.col("first.row").alias("first_row"),
    ).sortWithinPartitions("row")  # a repeated task cuts its archives at the same records

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        held: list[bytes] = []
        size = done = 0

        def close() -> pd.DataFrame:
            nonlocal held, size, done
            name = f"part-{task.partitionId():06d}-{done:05d}.warc.zst"
            own = posixpath.join(root, f".{name}.{task.taskAttemptId()}")
            written = 0
            with files.open_output_stream(own, compression=None) as out:
                for part in pack(held):
                    out.write(part)
                    written += len(part)
            files.move(own, posixpath.join(root, name))
            row = pd.DataFrame([(f"{folder}/{name}", len(held), size, written)], columns=["archive", "records", "raw_bytes", "bytes"])
            held, size, done = [], 0, done + 1
            return row

        for batch in batches:
            for p, u, data, sha1, length, row, first_id, first_row in batch.itertuples(index=False):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                first = None if pd.isna(first_row) else (None if pd.isna(first_id) else first_id, int(first_row))
                record = encode_record(None if pd.isna(p) else p, None if pd.isna(u) else u, data, digest, int(length), int(row), first)
                held.append(record)
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    yield close()
        if held:
            yield close()

    return stage(ready.mapInPandas(write, FILES), "warc-files")


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """Records of the archives named in column ``archive``, each checked against its length and
    digest: archive, offset, record_id, record_type, page_id (text), url, payload_digest,
    payload_bytes, refers_to (page id as text) and, if asked for, ``payload``. A task holds one
    record at a time; a damaged archive raises."""
    names = [c.split()[0] for c in RECORDS.split(", ")] + (["payload"] if payload else [])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["archive"]:
                files, name = _open(path)
                rows, size = [], 0
                with files.open_input_stream(name, compression=None) as source:
                    for offset, raw in unpack(source):
                        r = decode_record(raw)
                        rows.append([path, offset, *(r[n] for n in names[2:])])
                        size += len(raw) if payload else 0
                        if len(rows) == BATCH_ROWS * 16 or size > ARCHIVE_BYTES:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    listed = archives.select("archive").distinct()
    tasks = max(1, min(listed.count(), 4 * archives.sparkSession.sparkContext.defaultParallelism))
    listed = listed.repartition(tasks, "archive")  # a given number is not coalesced
    return listed.mapInPandas(read, RECORDS + (", payload binary" if payload else ""))
