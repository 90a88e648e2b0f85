"""Operator 3, WARC: Zstandard archives with their dictionary in a leading
skippable frame and one frame per record; a reader that validates every header
and length.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
largest page_id is a response, the others are revisits that refer to it.

Defined cases: a null payload is empty; null urls leave out the target header;
rows with a null page_id keep a null id and are responses; repeated rows whose
page_id is the largest of their payload are each a response; an empty table
gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import string
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm import files
from kerbflow.llm.common import text_bytes, written
from kerbflow.session import scratch_path

# The frame magics of the format and of dictionaries in WARC files.
ZSTD_MAGIC = 0xFD2FB528
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")


class BadArchive(ValueError):
    """An archive whose frames, headers, lengths or digests don't agree."""


def record_bytes(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    revisit = refers_to is not None
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=string.punctuation))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _header(raw: bytes, first: str) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    if not lines[0].startswith(first):
        raise BadArchive(f"expected {first!r}, found {lines[0][:40]!r}")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(": ")
        if not colon:
            raise BadArchive(f"not a header line: {line[:80]!r}")
        out[name.lower()] = value
    return out


def _page(urn: str):
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise BadArchive(f"not a record id: {urn!r}")
    body = urn[10:-1]
    return None if body == "null" else int(body)


def parse_record(raw: bytes) -> tuple:
    """The fields of one record; BadArchive where any length or digest is wrong."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        raise BadArchive("no end of headers")
    h = _header(raw[:end], "WARC/1.1")
    missing = {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "content-length"} - h.keys()
    if missing:
        raise BadArchive(f"missing headers {sorted(missing)}")
    block = raw[end + 4:-4]
    if not raw.endswith(b"\r\n\r\n") or len(block) != int(h["content-length"]):
        raise BadArchive(f"block of {len(block)} bytes, Content-Length {h['content-length']}")
    cut = block.find(b"\r\n\r\n")
    http = _header(block[:cut], "HTTP/1.")
    payload, size = block[cut + 4:], int(http["content-length"])
    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = h["warc-type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise BadArchive(f"payload of {len(payload)} bytes doesn't match its headers")
        return _page(h["warc-record-id"]), h.get("warc-target-uri"), size, digest, kind, None, payload
    if kind != "revisit" or payload or "warc-refers-to" not in h:
        raise BadArchive(f"not a valid {kind} record")
    return (_page(h["warc-record-id"]), h.get("warc-target-uri"), size, digest, kind,
            _page(h["warc-refers-to"]), None)


def archive_bytes(records: list[bytes], level: int, dict_bytes: int, sample_bytes: int) -> list[bytes]:
    """One archive: the dictionary's skippable frame, then a frame per record.

    The dictionary is trained on the archive's first records, up to
    ``sample_bytes``; an archive too small to train on has none.
    """
    import zstandard as zstd
    sample, size = [], 0
    for r in records:
        if size >= sample_bytes:
            break
        sample.append(r[:16_384])
        size += len(sample[-1])
    parts, dictionary = [], None
    if len(sample) >= 16:
        try:
            dictionary = zstd.train_dictionary(dict_bytes, sample, k=200, d=8, level=level)
        except zstd.ZstdError:
            dictionary = None
    if dictionary is not None:
        raw = dictionary.as_bytes()
        parts.append(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
    pack = zstd.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True)
    parts += [pack.compress(r) for r in records]
    return parts


def archive_records(data: bytes, step: int = 1 << 17) -> Iterator[bytes]:
    """The decoded frames of one archive, one record each."""
    import zstandard as zstd
    view, at, dictionary = memoryview(data), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICT_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise BadArchive("the dictionary frame is cut off")
        dictionary, at = zstd.ZstdCompressionDict(data[8:8 + size]), 8 + size
    unpack = zstd.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        if at + 4 > len(data) or struct.unpack_from("<I", data, at)[0] != ZSTD_MAGIC:
            raise BadArchive(f"no frame at byte {at}")
        frame, out = unpack.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise BadArchive("the last frame is cut off")
            part = view[at:at + step]
            try:
                out.append(frame.decompress(part))
            except zstd.ZstdError as e:
                raise BadArchive(f"frame before byte {at + len(part)}: {e}") from e
            at += len(part)
        at -= len(frame.unused_data)
        yield b"".join(out)


def with_revisits(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, refers_to (the response's page_id, null for responses)."""
    p = (pages.select("page_id", "url", text_bytes(F.col("html")).alias("payload"))
         .withColumn("digest", F.sha1("payload")))
    last = (p.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
            .agg(F.max("page_id").alias("last_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return (p.join(last, "digest", "left")
            .withColumn("refers_to", F.when(F.col("page_id") < F.col("last_id"), F.col("last_id")))
            .select("page_id", "url", "payload", "refers_to"))


def write_archives(spark: SparkSession, records: DataFrame, folder: str | None = None, archive_size: int = 32 << 20,
                   level: int = 3, dict_bytes: int = 32_768, sample_bytes: int = 2 << 20,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``records`` as archives of about ``archive_size`` decoded bytes; the manifest."""
    folder = folder or scratch_path(spark, "warc")

    def write(batches):
        held, size = [], 0

        def flush():
            parts = archive_bytes(held, level, dict_bytes, sample_bytes)
            path = files.new_file(folder, f"part-{files.partition_id():05d}", ".warc.zst", parts)
            return pa.RecordBatch.from_pydict(
                {"path": [path], "n_records": [len(held)], "n_bytes": [sum(map(len, parts))]})

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                held.append(record_bytes(*row, date))
                size += len(held[-1])
                if size >= archive_size:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return written(spark, records.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives that the manifest lists, validated one by one."""
    names = [f.split()[0] for f in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, types)))

    def read(batches):
        for b in batches:
            for path, n in zip(b.column("path").to_pylist(), b.column("n_records").to_pylist()):
                rows, size, seen = [], 0, 0
                try:
                    for raw in archive_records(files.read_file(path)):
                        row = parse_record(raw)
                        seen += 1
                        size += len(raw) if payloads else 200
                        rows.append(row if payloads else (*row[:6], None))
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)
                            rows, size = [], 0
                    if seen != n:
                        raise BadArchive(f"{seen} records, the manifest says {n}")
                except BadArchive as e:
                    raise BadArchive(f"{path}, record {seen}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)

    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, RECORDS)


def warc_query(spark: SparkSession, pages: DataFrame) -> DataFrame:
    manifest = write_archives(spark, with_revisits(pages))
    return read_archives(manifest, payloads=False).drop("payload", "url")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS last_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last_id THEN last_id END AS refers_to
FROM r
"""
