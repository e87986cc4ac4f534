"""Operator 3: WARC archives of single Zstandard frames with a shared dictionary.

A file starts with a skippable frame that holds the dictionary (itself a
Zstandard frame), followed by one frame per record. Records are ``response``
(HTTP header and payload) or ``revisit`` (an equal payload stored elsewhere).

Defined results: a null payload is empty; null ids are allowed (such a record
is never the one others refer to while another id exists); rows that repeat the
smallest id of a payload are all responses; an empty table makes no files.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landsales.llm.common import read_file, stored, write_file
from landsales.session import new_work_dir

# Fixed values of the formats: skippable-frame magic for dictionaries, magics
# of a compressed and of a trained dictionary, of a data frame.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
TRAINED = 0xEC30A437

MIN_SHARED = 100                  # payloads from this many bytes may be revisited
SHARD_BYTES = 16 << 20            # uncompressed payload bytes after which a file is closed
DICT_BYTES = 32 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 200, 8 << 10   # the dictionary is trained on these
DATE = "1970-01-01T00:00:00Z"
ID_PREFIX = "urn:page:"


class WarcError(ValueError):
    """A file or record that breaks the format."""


# ---------------------------------------------------------------- one record

def record_bytes(page_id, url, kind: str, payload: bytes, digest: str, refers_to) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"),
            ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: "%0" + "%X" % ord(m.group()), url)))
    if kind == "revisit":
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"))
        block = b""
    else:
        head.append(("Content-Type", "application/http;msgtype=response"))
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8", "strict").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"bad header line {line[:60]!r}")
        out[name.lower()] = value.strip()
    return out


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record, with lengths and digest checked."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    version, newline, lines = head.partition(b"\r\n")
    if not sep or not newline or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError("no WARC version line and header block")
    headers = parse_headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"header {name} is missing")
    if not headers["content-length"].isdigit():
        raise WarcError("Content-Length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("the block's length is not Content-Length")
    block, payload = rest[:length], b""
    if headers["warc-type"] == "response":
        http, sep, payload = block.partition(b"\r\n\r\n")
        if not sep:
            raise WarcError("no HTTP header block")
        told = parse_headers(http.partition(b"\r\n")[2]).get("content-length")
        if told is not None and int(told) != len(payload):
            raise WarcError("the payload's length is not the HTTP Content-Length")
        digest = headers.get("warc-payload-digest")
        if digest is not None and digest != "sha256:" + hashlib.sha256(payload).hexdigest():
            raise WarcError("the payload's digest differs")
    elif headers["warc-type"] == "revisit":
        if length or "warc-refers-to" not in headers or "warc-payload-digest" not in headers:
            raise WarcError("a revisit needs a target, a digest and no block")
    return headers, payload


# ------------------------------------------------------------------ one file

def archive(records: list[bytes]) -> Iterator[bytes]:
    """The parts of a file: the dictionary's frame if one could be trained, then the records."""
    samples = [r[:SAMPLE_BYTES] for r in records[::max(1, len(records) // SAMPLE_RECORDS)]]
    dictionary = None
    size = min(DICT_BYTES, sum(map(len, samples)) // 8)
    if size >= 1024 and len(samples) >= 16:
        try:
            dictionary = zstandard.train_dictionary(size, samples)
        except zstandard.ZstdError:
            dictionary = None           # too uniform to train on
    if dictionary is not None:
        packed = zstandard.ZstdCompressor(level=9).compress(dictionary.as_bytes())
        yield struct.pack("<II", SKIPPABLE, len(packed)) + packed
    options = {"dict_data": dictionary} if dictionary is not None else {}
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True, **options)
    for record in records:
        yield packer.compress(record)


def leading_dictionary(data: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary in the leading skippable frame, and where the records start."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        return None, 0
    size = struct.unpack_from("<I", data, 4)[0]
    raw = data[8:8 + size]
    if len(raw) != size or size < 4:
        raise WarcError("the dictionary's frame is cut short")
    if struct.unpack_from("<I", raw)[0] == FRAME:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    if len(raw) < 4 or struct.unpack_from("<I", raw)[0] != TRAINED:
        raise WarcError("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(raw), 8 + size


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its block headers."""
    try:
        header = zstandard.get_frame_parameters(data[at:at + 18])
        at += zstandard.frame_header_size(data[at:at + 18])
    except zstandard.ZstdError as error:
        raise WarcError(f"no frame at byte {at}: {error}") from None
    while True:
        if at + 3 > len(data):
            raise WarcError("a frame is cut short")
        block = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if (block >> 1) & 3 == 1 else block >> 3)
        if block & 1:
            break
    at += 4 * header.has_checksum
    if at > len(data):
        raise WarcError("a frame is cut short")
    return at


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record of a file: one frame each, decoded and validated in turn."""
    dictionary, at = leading_dictionary(data)
    reader = zstandard.ZstdDecompressor(**({"dict_data": dictionary} if dictionary else {}))
    while at < len(data):
        end = frame_end(data, at)
        frame = reader.decompressobj()
        try:
            raw = frame.decompress(data[at:end])
        except zstandard.ZstdError as error:
            raise WarcError(f"frame at byte {at}: {error}") from None
        if not frame.eof:
            raise WarcError("a frame is cut short")
        yield parse_record(raw)
        at = end


# ------------------------------------------------------------------ the jobs

def plan_records(pages: DataFrame, page_id: Column, url: Column, payload: Column,
                 min_shared: int = MIN_SHARED) -> DataFrame:
    """page_id, url, html, digest, record_type, refers_to. Only digests and ids are
    grouped (combined map-side); payloads move once, with the join to the few
    digests that occur more than once."""
    rows = pages.select(page_id.cast("long").alias("page_id"), url.cast("string").alias("url"),
                        F.coalesce(payload.cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    shared = rows.where(F.octet_length("html") >= min_shared).groupBy("digest") \
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select(F.col("digest").alias("d"), "first_id")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(stored(shared, "warc-shared"), F.col("digest") == F.col("d"), "left") \
        .select("page_id", "url", "html", "digest",
                F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One or more files per task; returns the manifest (path, records). A task that
    runs again writes files of new names, and only the manifest's files count."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close():
            path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            write_file(path, archive(held))
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(held)]})

        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6))):
                page_id, url, html, digest, kind, refers_to = (v.as_py() for v in row)
                held.append(record_bytes(page_id, url, kind, html.encode("utf-8"), digest, refers_to))
                size += len(held[-1])
                if size >= shard_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    rows = records.select("page_id", "url", "html", "digest", "record_type", "refers_to")
    return stored(rows.mapInArrow(write, "path string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the manifest's files: page_id, record_type, payload_digest,
    payload_bytes (null for a revisit), refers_to, and the payload if wanted."""
    schema = "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long"
    schema += ", payload binary" if with_payload else ""

    def number(uri: str | None):
        text = (uri or "").strip("<>").removeprefix(ID_PREFIX)
        return int(text) if text else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()][:len(names)]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, size, n = [], 0, 0
                for headers, payload in read_archive(read_file(path)):
                    kind = headers["warc-type"]
                    digest = headers["warc-payload-digest"].removeprefix("sha256:")
                    row = (number(headers["warc-record-id"]), kind, digest,
                           None if kind == "revisit" else len(payload), number(headers.get("warc-refers-to")))
                    rows.append(row + ((payload,) if with_payload else ()))
                    n, size = n + 1, size + len(payload) * with_payload + 100
                    if size > 4 << 20:
                        yield made(rows)
                        rows, size = [], 0
                if n != expected:
                    raise WarcError(f"{path}: {n} records, {expected} were written")
                if rows:
                    yield made(rows)

    files = manifest.select("path", "records")
    spread = files.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, schema)


def page_digests(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write every page to archives, read them back, and give a revisit the length
    of the payload it refers to."""
    records = plan_records(pages, F.col("page_id"), F.col("url"), F.col("html"))
    manifest = write_archives(records, new_work_dir(spark, "warc"))
    back = stored(read_archives(manifest), "warc-read")
    kept = back.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("d")) \
        .agg(F.max("payload_bytes").alias("full_bytes"))
    revisited = back.where("record_type = 'revisit'").select(F.col("payload_digest").alias("r")).distinct()
    lengths = stored(kept.join(revisited, F.col("d") == F.col("r"), "left_semi"), "warc-lengths")
    return back.join(lengths, (F.col("payload_digest") == F.col("d")) & (F.col("record_type") == "revisit"), "left") \
        .select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
                "payload_digest", "record_type", "refers_to")
