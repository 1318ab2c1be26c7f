"""Operator 9: WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a bundle ends with
the seek table of the seekable format (a skippable frame that lists each frame's
sizes), and the index maps each record to bundle, frame and the offset within the
frame, so one record costs one frame. Records whose payload another record holds
become revisits: the largest page_id of equal payloads is the response.

Tasks write bundles straight to the shared folder under fresh names; only bundles
that the stored index names count, so a repeated or lost task leaves no trace.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import documents, stored

FRAME_BYTES = 1 << 19
BUNDLE_BYTES = 1 << 26
# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def roles(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, hex digest, refers_to) of the records that revisit another one.

    Of equal payloads of ``min_bytes`` or more, records below the largest page_id
    revisit it. NULL ids revisit a group's largest id; a group without any id, and
    rows that share the largest id, are responses.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    each = pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("hex"),
                        F.octet_length(payload).alias("bytes")).where(F.col("bytes") >= min_bytes)
    last = (each.groupBy("hex").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
            .where("n > 1 and refers_to is not null").select("hex", "refers_to"))
    return each.join(last, "hex").where("page_id is null or page_id < refers_to").select("page_id", "hex", "refers_to").distinct()


def record_id(page_id) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def warc_record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def file_system(uri: str):
    """(pyarrow file system, path) of a folder named by Spark."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frame_table(tail: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed, raw size) of each frame, from the end of a bundle."""
    n, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("not a seekable bundle")
    at, out = 0, []
    for c, d in struct.iter_unpack("<II", tail[-9 - 8 * n:-9]):
        out.append((at, c, d))
        at += c
    return out


class _Bundle:
    def __init__(self, folder, level, frame_bytes):
        import zstandard

        self.fs, path = file_system(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.fs.create_dir(path, recursive=True)
        self.out = self.fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.zip, self.frame_bytes = zstandard.ZstdCompressor(level=level), frame_bytes
        self.frames, self.held, self.size, self.raw, self.at = [], [], 0, 0, 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame number, the frame's offset in the bundle, the record's in the frame."""
        place = len(self.frames), self.at, self.size
        self.held.append(record)
        self.size += len(record)
        self.raw += len(record)
        if self.size >= self.frame_bytes:
            self._flush()
        return place

    def _flush(self):
        if self.held:
            frame = self.zip.compress(b"".join(self.held))
            self.out.write(frame)
            self.frames.append((len(frame), self.size))
            self.at += len(frame)
            self.held, self.size = [], 0

    def close(self):
        self._flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


INDEX = "page_id long, bundle string, frame int, frame_offset long, record_offset long, length long, record_type string"


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 3,
                   frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) to bundles under ``folder``; the stored index."""
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    each = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), digest.alias("hex"))
    back = roles(pages, min_bytes=min_bytes).select(F.col("page_id").alias("_id"), F.col("hex").alias("_hex"), "refers_to")
    ready = each.join(back, (F.col("hex") == F.col("_hex")) & F.col("page_id").eqNullSafe(F.col("_id")), "left")

    def run(batches):
        bundle = None
        names = INDEX.replace(",", "").split()[::2]
        for b in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(b.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                page_id, refers_to = page_id.as_py(), refers_to.as_py()
                record = warc_record(page_id, url.as_py(), (html.as_py() or "").encode(), refers_to, date)
                bundle = bundle or _Bundle(folder, level, frame_bytes)
                frame, at, offset = bundle.add(record)
                rows.append((page_id, bundle.name, frame, at, offset, len(record), "response" if refers_to is None else "revisit"))
                if bundle.raw >= bundle_bytes:
                    bundle.close()
                    bundle = None
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            cols = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
        if bundle:
            bundle.close()

    return stored(ready.select("page_id", "url", "html", "refers_to").mapInArrow(run, INDEX), "warc-index")


def parse_records(raw: bytes):
    """Yields (start, headers, block) of the records in a frame."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        yield at, head, raw[end + 4:end + 4 + n]
        at = end + 4 + n + 4


def read_record(folder: str, bundle: str, frame_offset: int, record_offset: int):
    """(headers, block) of one record: reads and decompresses its frame only."""
    import zstandard

    fs, path = file_system(folder)
    with fs.open_input_file(f"{path}/{bundle}") as f:
        f.seek(frame_offset)
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(f.read(_frame_size(f, frame_offset)))
    head, block = next((h, b) for at, h, b in parse_records(raw) if at == record_offset)
    return head, block


def _frame_size(f, offset: int) -> int:
    size = f.size()
    f.seek(size - 9)
    n = struct.unpack("<I", f.read(4))[0]
    f.seek(size - 9 - 8 * n)
    found = next(c for at, c, _ in frame_table(f.read(8 * n + 9)) if at == offset)
    f.seek(offset)
    return found


def _page(urn: str):
    value = urn[len("<urn:x-page:"):-1]
    return None if value == "none" else int(value)


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that ``index`` names, digests recomputed from the payloads read."""
    import zstandard

    spark = index.sparkSession
    schema = "bundle string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches):
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                raw, rows = content.as_py(), []
                name = path.as_py().rsplit("/", 1)[1]
                try:
                    table = frame_table(raw)
                except (ValueError, struct.error):
                    continue  # cut off by a lost task: the index does not name it
                for at, c, d in table:
                    for _, head, block in parse_records(zstandard.ZstdDecompressor().decompress(raw[at:at + c], max_output_size=d)):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        told = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if head["WARC-Type"] == "response":
                            if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != told:
                                raise ValueError(f"record {head['WARC-Record-ID']} of {name} is damaged")
                        ref = head.get("WARC-Refers-To")
                        rows.append((name, _page(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), size, told,
                                     head["WARC-Type"], None if ref is None else _page(ref)))
                cols = list(zip(*rows)) or [[]] * 7
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)],
                                                 names=schema.replace(",", "").split()[::2])

    if index.limit(1).count() == 0:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("path", "content")
    return files.mapInArrow(run, schema).join(index.select("bundle").distinct(), "bundle", "left_semi")


def op9_query(spark, sf_dir):
    folder = scratch_dir(spark, "warc")
    index = write_archives(documents(spark, sf_dir, "pages"), folder)
    return read_archives(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = None  # DuckDB has no base32 digest; tests compare with hashlib
