"""WARC 1.1 archives of pages: records compressed one by one with a dictionary that each file carries.

A file starts with a skippable Zstandard frame that holds the dictionary, as in the public
``.warc.zst`` convention, followed by one frame per record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import open_folder, shared_dictionary, small_sample, write_file
from tidewell.session import stage

DICTIONARY_MAGIC = 0x184D2A5D
#: Payloads shorter than this are archived in full even where others equal them.
REVISIT_BYTES = 1000
FILE_BYTES = 32 << 20
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 20_000, 64 << 10
#: Bytes of archives that one task reads back.
READ_BYTES = 64 << 20
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def decide(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of every page.

    A null payload counts as empty. Of equal payloads of at least ``REVISIT_BYTES`` bytes, the row
    with the largest page_id is the response and the others revisit it; rows that repeat that
    page_id are responses too. A null page_id is smaller than all others; where all are null, all
    are responses. Payloads of any length are hashed whole; an empty table gives no rows; columns other
    than these three are not read.
    """
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"),
        F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("url"),
        F.encode(F.coalesce(pages[html_col].cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))
    shared = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
    shared = shared.where("n > 1").drop("n")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return (
        rows.join(shared, "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("newest")))
        .drop("newest")
    )


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(PAGE_SPACE, f'page:{page_id}')}>"


def _one_line(text: str) -> str:
    return "".join(c if c.isprintable() else "%%%02X" % ord(c) for c in text)


def record(row: dict, date: str) -> bytes:
    """The bytes of one record; a revisit has the HTTP head and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = head + (row["payload"] if row["record_type"] == "response" else b"")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", _record_id(row["page_id"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["page_id"] is not None:
        fields.append(("Page-Id", str(row["page_id"])))
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", _record_id(row["refers_to"])), ("Refers-To-Page-Id", str(row["refers_to"]))]
    top = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return top.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; an error where lengths do not fit."""
    top, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = top.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    n = int(fields["Content-Length"])
    if not version.startswith("WARC/1.") or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return fields, rest[:n]


def train_dictionary(pages: DataFrame, date: str) -> bytes:
    """A dictionary from the records of a bounded sample of pages, those with the smallest hashes; empty only without pages.

    Pages of any size are eligible; of each payload the first ``SAMPLE_BYTES`` bytes are learned from.
    """
    rows = small_sample(pages, F.xxhash64("payload_digest", "page_id"), SAMPLE_PAGES).select(
        "page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "payload_bytes", "payload_digest",
        F.lit("response").alias("record_type"), F.lit(None).alias("refers_to"),
    )
    return shared_dictionary([record({**r.asDict(), "payload": bytes(r.payload)}, date) for r in rows.collect()], DICTIONARY_BYTES)


def write_archives(decided: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the rows of ``decide`` to ``.warc.zst`` files; a manifest (path, records, bytes).

    Each task writes files of about ``file_bytes``; the manifest names those of the committed
    attempts. An empty table gives no file.
    """
    dictionary = train_dictionary(decided, date)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt, part = f"{task.partitionId():07d}-{task.taskAttemptId()}", 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=shared) if shared else zstandard.ZstdCompressor(level=3)
        front = DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary
        frames, held = [], 0

        def flush() -> pa.RecordBatch:
            info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_record_id(None)}\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC/1.1\r\n\r\n\r\n"
            path, n = write_file(folder, f"{part:05d}.warc.zst", attempt, [front, pack.compress(info.encode()), *frames])
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(frames)], pa.int64()), pa.array([n], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            for row in batch.to_pylist():
                frames.append(pack.compress(record(row, date)))
                held += len(frames[-1])
                if held >= file_bytes:
                    yield flush()
                    part, held, frames = part + 1, 0, []
        if frames:
            yield flush()

    cells = decided.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return stage(cells.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a file, streamed."""
    fs, place = open_folder(path)
    with fs.open_input_stream(place, compression=None) as source:
        if int.from_bytes(source.read(4), "little") != DICTIONARY_MAGIC:
            raise ValueError(f"{path} has no dictionary frame")
        dictionary = source.read(int.from_bytes(source.read(4), "little"))
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
        rest = b""
        while True:
            one, whole = unpack.decompressobj(), bytearray()
            while not one.eof:
                if not rest and not (rest := source.read(1 << 18)):
                    if whole or getattr(one, "unused_data", b""):
                        raise ValueError(f"{path} ends within a record")
                    return
                whole += one.decompress(rest)
                rest = one.unused_data if one.eof else b""
            yield parse_record(bytes(whole))


def read_archives(manifest: DataFrame) -> DataFrame:
    """The page records of the files in the manifest, in the columns of ``decide``.

    Size and digest of each response are those of the payload read; a record that says otherwise is
    an error. A revisit has no payload: its size and digest are what its record states.
    """
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for fields, block in read_records(path):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = next(int(x[15:]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"{path} holds a payload that differs from its record's digest")
                    page, target = (int(fields[k]) if k in fields else None for k in ("Page-Id", "Refers-To-Page-Id"))
                    rows.append((page, size, digest, fields["WARC-Type"], target, fields["WARC-Target-URI"], payload))
                    held += len(payload)
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    size = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, size // READ_BYTES)
    return manifest.select("path").repartition(tasks).mapInArrow(read, RECORD)
