"""WARC archives: a writer with revisit records and a reader that splits gzip files.

Each record is a gzip member of its own. A reading task owns the records that start in its byte range:
it looks for the gzip magic from the range's start, takes a candidate only if its first bytes
unpack to a WARC header, then follows the chain of members, reading past the end of the range for the
last one. Members carry checksums; a broken one in the chain is an error, never a gap.

Defined results: a null payload is written as an empty one. Of rows with equal payloads of ``revisit_from`` bytes
or more, that with the smallest page id is the response, and so are repeated rows of that id;
null ids come last, and without any other id all are responses. Other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, open_store, shared_uri, write_once
from tidemark.session import PARTITION_BYTES

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
BATCH_BYTES = 8 << 20
PAGE = "urn:page:"

RECORDS = (
    "uri string, offset long, record_type string, record_id string, target string, refers_to string, "
    "digest string, payload_bytes long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to, level: int) -> bytes:
    """One gzip member. A revisit keeps the HTTP head and leaves the payload out."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>", f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{PAGE}{refers_to}>",
        ]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}")
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(
    pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html",
    revisit_from: int = 0, level: int = 5,
) -> DataFrame:
    """Write one archive per task and return the list of files with their sizes."""
    spark = pages.sparkSession
    folder = folder or shared_uri(spark, "warc")
    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    first = rows.groupBy("same").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    # only payloads that come more than once are joined; AQE splits a payload shared by many rows
    rows = rows.join(first.where("n > 1").select("same", "first_id"), "same", "left").select(
        "page_id", "url", "payload",
        F.when(
            (F.octet_length("payload") >= revisit_from)
            & F.coalesce(F.col("page_id") != F.col("first_id"), F.col("first_id").isNotNull()),
            F.col("first_id"),
        ).alias("refers_to"),
    )

    def write(batches):
        out = uri = None
        size = 0
        for batch in batches:
            if out is None:
                out, uri = write_once(folder, "part")
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url")]
            payloads = bytes_of(batch.column("payload"))
            for page, target, payload, refers in zip(
                *columns, payloads, batch.column("refers_to").to_pylist(), strict=True
            ):
                data = record(page, target, payload, refers, level)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"uri": [uri], "bytes": [size]})

    rows.mapInArrow(write, "uri string, bytes long").write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


class Members:
    """Gzip members of one file from ``start`` on, as far as they begin before ``end``."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def unpack(self, at: int, only_head: bool = False) -> tuple[bytes, int]:
        """Content of the member at ``at`` and where it ends; with ``only_head`` its first bytes."""
        machine, parts, place = zlib.decompressobj(31), [], at
        step = 512 if only_head else CHUNK // 16
        while not machine.eof:
            if place >= self.size:
                raise zlib.error("the file ends inside a member")
            data = self.file.read_at(min(step, self.size - place), place)
            place += len(data)
            parts.append(machine.decompress(data))
            if only_head and sum(map(len, parts)) >= 7:
                break
            step = CHUNK
        return b"".join(parts), place - len(machine.unused_data)

    def is_record(self, at: int) -> bool:
        try:
            return self.unpack(at, only_head=True)[0].startswith(b"WARC/1.")
        except zlib.error:
            return False

    def find(self, at: int, end: int) -> int | None:
        """The first record that starts in [at, end)."""
        while at < end:
            data = self.file.read_at(min(CHUNK, self.size - at, end - at + 2), at)
            place = data.find(MAGIC)
            while place >= 0:
                if at + place < end and self.is_record(at + place):
                    return at + place
                place = data.find(MAGIC, place + 1)
            at += max(1, len(data) - 2)
        return None

    def owned(self, start: int, end: int):
        at = self.find(start, end)
        while at is not None and at < end:
            data, after = self.unpack(at)
            if not data.startswith(b"WARC/1."):
                raise ValueError(f"no WARC record at {at}")
            yield at, data
            at = after
            if at < self.size and self.file.read_at(3, at) != MAGIC:
                raise ValueError(f"no gzip member at {at}")


def parse(data: bytes) -> dict:
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind, declared = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if kind == "response" and declared and digest(payload) != declared:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    refers = fields.get("WARC-Refers-To")
    return {
        "record_type": kind, "record_id": fields["WARC-Record-ID"].strip("<>"),
        "target": fields.get("WARC-Target-URI"), "refers_to": refers and refers.strip("<>"), "digest": declared,
        "payload_bytes": len(payload) if kind == "response" else int(lengths[0]),
        "payload": payload if kind == "response" else None,
    }


def read_warc(files: DataFrame, split_bytes: int = 32 << 20) -> DataFrame:
    """Records of all archives. ``files`` has uri and bytes; every byte range is a row, dealt out evenly."""
    ranges = files.where("bytes > 0").select(
        "uri", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start")
    )
    usual = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, (files.agg(F.sum("bytes")).first()[0] or 0) // PARTITION_BYTES)

    def read(batches):
        schema = pa.schema([
            ("uri", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()),
            ("record_id", pa.string()), ("target", pa.string()), ("refers_to", pa.string()),
            ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_store(row["uri"])
                found, held = [], 0
                with store.open_input_file(path) as file:
                    members = Members(file, row["bytes"])
                    for at, data in members.owned(row["start"], min(row["bytes"], row["start"] + split_bytes)):
                        found.append({"uri": row["uri"], "offset": at} | parse(data))
                        held += len(data)
                        if held > BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(found, schema)
                            found, held = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    return ranges.repartition(parts, "uri", "start").mapInArrow(read, RECORDS)


def page_of(record_id: Column) -> Column:
    """Page id of a record id."""
    return F.nullif(F.substring_index(record_id, ":", -1), F.lit("")).cast("long")
