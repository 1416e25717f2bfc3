"""WARC archives in Zstandard with a dictionary, written and read back.

``write`` makes one record per row: the first (smallest id) of equal payloads is a
``response``, the others are ``revisit`` records that name it.  Each task writes
archives ``*.warc.zst`` into a shared folder: a leading skippable frame
(magic 0x184D2A5D) holds the dictionary, trained on the archive's first records
(at most ``SAMPLE_BYTES``); then follows one Zstandard frame per record.  Names
are unique per attempt and only the archives of finished tasks get into the
manifest, so a retried task does no harm.  ``read`` loads each archive's
dictionary from the skippable frame, decodes frame by frame and validates version
line, required headers, block and payload lengths and digests; a damaged archive
raises ``ValueError``.

A task holds one archive (``ARCHIVE_BYTES``) at most beside one batch of rows.
Archives are opened through ``pyarrow.fs``, so the folder may be on any file
system that it and Spark both know.

Edge cases: a null payload counts as empty; a null id is written as an empty
name and read back as null; rows with the same id and payload as the response are
responses too; line breaks in an address are percent-encoded; other columns are
ignored; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwkit.llm.common import small_batches, staged
from dwkit.sources.files import scratch_path

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16_000_000
SAMPLE_BYTES = 1_000_000
DICT_BYTES = 16_384
_ID = "urn:dwkit:record:"


def digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(rid: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool,
                date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record: HTTP head and payload, or the head alone for a revisit."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    heads = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{_ID}{'' if rid is None else rid}>", f"WARC-Date: {date}",
             "WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or ""),
             f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        heads += [f"WARC-Refers-To: <{_ID}{'' if first is None else first}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    heads += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(heads).encode() + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"no header: {line[:60]!r}")
        out[name.decode().lower()] = value.strip().decode()
    return out


def parse_record(raw: bytes) -> dict:
    """Headers and payload facts of one record; ``ValueError`` if anything is inconsistent."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version != VERSION.encode():
        raise ValueError("no WARC record")
    got = _fields(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in got:
            raise ValueError(f"{name} is missing")
    if len(rest) != int(got["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("Content-Length and block differ")
    if got["warc-type"] == "warcinfo":
        return {"record_type": "warcinfo"}
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    length = int(_fields(http.split(b"\r\n")[1:])["content-length"]) if gap else -1
    name, _, said = got["warc-payload-digest"].partition(":")
    if got["warc-type"] == "response" and (len(payload) != length or name != "sha1" or digest(payload) != said):
        raise ValueError("payload and its length or digest differ")
    if got["warc-type"] == "revisit" and (payload or "warc-refers-to" not in got):
        raise ValueError("a revisit has a payload or refers to nothing")

    def number(s: str | None) -> int | None:
        s = (s or "").strip("<>").removeprefix(_ID)
        return int(s) if s else None
    return {"id": number(got["warc-record-id"]), "payload_bytes": length, "payload_digest": said,
            "record_type": got["warc-type"], "refers_to": number(got.get("warc-refers-to"))}


class ArchiveWriter:
    """Bytes of one archive; records are kept back until the dictionary is trained."""

    def __init__(self) -> None:
        info = f"software: dwkit\r\nformat: {VERSION}\r\n".encode()
        self.first = [f"{VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <{_ID}info>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
                      f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"]
        self.held, self.out, self.zip, self.records = len(self.first[0]), bytearray(), None, 0

    def _start(self) -> None:
        import zstandard as zs
        try:
            words = zs.train_dictionary(DICT_BYTES, self.first)
        except zs.ZstdError:  # too few records to learn from
            words = zs.ZstdCompressionDict(b"".join(self.first)[:DICT_BYTES], dict_type=zs.DICT_TYPE_RAWCONTENT)
        body = words.as_bytes()
        self.out += struct.pack("<II", SKIPPABLE, len(body)) + body
        self.zip = zs.ZstdCompressor(level=3, dict_data=words, write_checksum=True, write_content_size=True)
        for r in self.first:
            self.out += self.zip.compress(r)
        self.first = []

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.zip is None:
            self.first.append(record)
            self.held += len(record)
            if self.held >= SAMPLE_BYTES:
                self._start()
        else:
            self.out += self.zip.compress(record)

    def close(self) -> bytes:
        if self.zip is None:
            self._start()
        return bytes(self.out)


def read_archive(data: bytes) -> Iterator[dict]:
    """Records of one archive, frame by frame."""
    import zstandard as zs
    magic, size = struct.unpack_from("<II", data) if len(data) >= 8 else (0, 0)
    if magic != SKIPPABLE or len(data) < 8 + size:
        raise ValueError("no dictionary in a leading skippable frame")
    body = data[8:8 + size]
    if body[:4] == FRAME:
        body = zs.ZstdDecompressor().decompress(body)
    unzip = zs.ZstdDecompressor(dict_data=zs.ZstdCompressionDict(body))
    at = 8 + size
    while at < len(data):
        frame, parts = unzip.decompressobj(), []
        while not frame.eof:
            piece = data[at:at + 8192]
            if not piece:
                raise ValueError("the last frame is cut off")
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield parse_record(b"".join(parts))


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _write_rows(it: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, base = _open(folder)
    done: list[tuple[str, int]] = []

    def save(w: ArchiveWriter) -> None:
        name = f"{uuid.uuid4().hex}.warc.zst"
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{name}") as f:
            f.write(w.close())
        done.append((f"{folder}/{name}", w.records))

    now = None
    for batch in it:
        for rid, url, payload, first, revisit in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "first", "revisit")),
                                                     strict=True):
            now = now or ArchiveWriter()
            now.add(make_record(rid, url, payload.encode(), first, revisit))
            if len(now.out) >= ARCHIVE_BYTES:
                save(now)
                now = None
    if now is not None:
        save(now)
    if done:
        yield pa.RecordBatch.from_pydict({"archive": [x[0] for x in done], "records": [x[1] for x in done]})


_READ = pa.schema([("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def _read_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for uri, count in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist(), strict=True):
            store, path = _open(uri)
            with store.open_input_stream(path) as f:
                data = f.read()
            got = [r for r in read_archive(data) if r["record_type"] != "warcinfo"]
            if len(got) != count:
                raise ValueError(f"{uri}: {len(got)} records, the manifest says {count}")
            yield pa.RecordBatch.from_pylist(got, schema=_READ)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives under ``folder``; the manifest ``(archive, records)``."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = small_batches(pages).select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    firsts = staged(rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha").agg(F.min("id").alias("first")), "firsts")
    again = F.col("sha2").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    marked = (rows.join(firsts.withColumnRenamed("sha", "sha2"), F.col("sha") == F.col("sha2"), "left")
              .select("id", "url", "payload", "first", again.alias("revisit")))
    return staged(marked.mapInArrow(lambda it: _write_rows(it, folder), "archive string, records long"), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Records of the archives in ``manifest``; archives are spread over tasks, one at a time in each."""
    n = manifest.count()
    return manifest.repartition(max(1, n)).mapInArrow(
        _read_rows, "id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, id_col: str = "page_id", min_bytes: int = 0) -> DataFrame:
    """Archive ``pages`` in the shared folder and return the records read back."""
    manifest = write(pages, scratch_path(pages.sparkSession, "warc"), id_col=id_col, min_bytes=min_bytes)
    return read(manifest).withColumnRenamed("id", id_col)
