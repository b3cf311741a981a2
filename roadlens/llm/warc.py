"""WARC records in ZIP packages: written in parallel, indexed, and read back by range.

A package is one ZIP file with stored members: ``archive/data.warc.gz`` (one gzip member per
record), ``indexes/index.cdxj`` (a line per record with its offset and length in the archive
member) and ``datapackage.json``. Readers find the members through the central directory (plain
or ZIP64), read the index, and then read exactly the bytes of the records they need.

Equal payloads: the record with the largest page_id carries the payload (``response``), the
others are ``revisit`` records that name it and carry only the HTTP head; payloads below
``least`` bytes are always stored. Rows that tie at the largest page_id are responses all.

Tasks write packages of about ``PACKAGE_BYTES`` under names of their own and report them;
readers only open reported files, so what a lost or repeated task left behind is never read.
The folder must be shared (it defaults to one under ``spark.checkpoint.dir``) and is reached
through ``pyarrow.fs``, so it can be a local path or any store that names.

Edge cases: null html is an empty payload; null urls are left out of the record; a null page_id
counts as the smallest; repeated rows are records of their own; an empty table gives no packages.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import settle, sized
from roadlens.llm.zipped import STORED, BadArchive, members, pack
from roadlens.session import checkpoint_root

PACKAGE_BYTES = 32 << 20
BLOCK_RECORDS = 2_000  # index lines handed to readers at a time
TASK_BYTES = 32 << 20  # of packed records that a reading task gets, about
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORD = "page_id {0}, payload_bytes long, payload_digest string, record_type string, refers_to {0}, url string, payload binary"


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


def _head(fields: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode()


def _clean(url: str | None) -> str | None:
    return None if url is None else "".join("%%%02X" % ord(c) if c in "\r\n" else c for c in url)


def record(page_id, url: str | None, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record (not yet compressed)."""
    http = b"HTTP/1.1 200 OK\r\n" + _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n"
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _clean(url)),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + _head(fields) + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _writer(root: str, zip64: bool, package_bytes: int):
    """From ``page_id, url, html, _last`` to a manifest row per package written."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _filesystem(root)
        store.create_dir(folder, recursive=True)

        def close(body: io.BytesIO, lines: list[str]) -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.wacz"
            buffer = io.BytesIO()
            about = json.dumps({"profile": "data-package", "resources": [{"path": ARCHIVE}, {"path": INDEX}]}).encode()
            pack(buffer, [(ARCHIVE, body.getvalue()), (INDEX, "".join(lines).encode()), ("datapackage.json", about)], zip64)
            with store.open_output_stream(path, compression=None) as out:
                out.write(buffer.getbuffer())
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(lines)]), pa.array([buffer.tell()])], names=["path", "records", "bytes"])

        body, lines = io.BytesIO(), []
        for batch in batches:
            for page_id, url, html, last, several in zip(*(c.to_pylist() if i != 2 else c for i, c in enumerate(batch.columns))):
                payload = (html.as_py() or "").encode()
                raw = gzip.compress(record(page_id, url, payload, last, several and page_id != last), 4, mtime=0)
                lines.append(json.dumps({"offset": body.tell(), "length": len(raw), "filename": ARCHIVE}) + "\n")
                body.write(raw)
                if body.tell() >= package_bytes:
                    yield close(body, lines)
                    body, lines = io.BytesIO(), []
        if lines:
            yield close(body, lines)

    return write


def write_packages(pages: DataFrame, root: str, least: int = 0, zip64: bool = False, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes all ``pages`` as packages under ``root``; the settled manifest ``path, records, bytes``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("_key"))
    big = rows.where(F.octet_length("html") >= least)
    groups = big.groupBy("_key").agg(F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    groups = settle(groups.select("_key", "_last"))
    rows = rows.join(sized(groups.withColumn("_several", F.lit(True))), "_key", "left")
    rows = rows.select("page_id", "url", "html", "_last", F.coalesce("_several", F.lit(False)).alias("_several"))
    return settle(rows.mapInArrow(_writer(root, zip64, package_bytes), MANIFEST))


class _File:
    def __init__(self, root: str, path: str):
        self.file = _filesystem(root)[0].open_input_file(path)
        self.size = self.file.size()

    def read(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)


def _indexer(root: str):
    """From package paths to blocks of record ranges ``path, offsets, lengths`` in the package file."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                source = _File(root, path)
                found = {m.name: m for m in members(source)}
                for m in found.values():
                    if m.method != STORED:
                        raise BadArchive(f"{path}: {m.name} is compressed")
                lines = [json.loads(x) for x in source.read(found[INDEX].offset, found[INDEX].size).splitlines()]
                source.file.close()
                places = [(found[x["filename"]].offset + int(x["offset"]), int(x["length"])) for x in lines]
                for at in range(0, len(places), BLOCK_RECORDS):
                    part = places[at : at + BLOCK_RECORDS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([[o for o, _ in part]], pa.list_(pa.int64())), pa.array([[n for _, n in part]], pa.list_(pa.int64()))],
                        names=["path", "offsets", "lengths"],
                    )

    return index


def _reader(root: str, id_type: pa.DataType, with_payload: bool):
    def name(x: str | None):
        x = (x or "").removeprefix("<urn:page:").removesuffix(">")
        return x or None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                source = _File(root, path)
                out: list[list] = [[] for _ in range(7)]
                size = 0

                def rows() -> pa.RecordBatch:
                    ids = [pa.array(out[i], pa.string()).cast(id_type) for i in (0, 4)]
                    columns = [ids[0], pa.array(out[1], pa.int64()), pa.array(out[2]), pa.array(out[3]), ids[1], pa.array(out[5], pa.string())]
                    return pa.RecordBatch.from_arrays(columns + [pa.array(out[6], pa.binary())], names=[x.split()[0] for x in RECORD.split(", ")])

                for offset, length in zip(offsets, lengths):
                    fields, http, payload = parse(zlib.decompress(source.read(offset, length), 31))
                    kind = fields["warc-type"]
                    found = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and digest(payload) != found:
                        raise ValueError(f"{path}: the payload at {offset} has another digest")
                    full = len(payload) if kind == "response" else int(http["content-length"])
                    values = (name(fields["warc-record-id"]), full, found, kind, name(fields.get("warc-refers-to")), fields.get("warc-target-uri"))
                    for store, v in zip(out, (*values, payload if with_payload and kind == "response" else None)):
                        store.append(v)
                    size += len(payload)
                    if size > PACKAGE_BYTES:
                        yield rows()
                        out, size = [[] for _ in range(7)], 0
                source.file.close()
                if out[0]:
                    yield rows()

    return read


def read_packages(manifest: DataFrame, root: str, id_type: str = "bigint", with_payload: bool = True) -> DataFrame:
    """All records of the packages in ``manifest`` (columns ``path, records, bytes``), read by range, in parallel within packages too."""
    blocks = manifest.select("path").mapInArrow(_indexer(root), "path string, offsets array<long>, lengths array<long>")
    # index blocks are small and their records are not: the manifest says how many tasks the archives need
    total = manifest.agg(F.sum("bytes"), F.sum("records")).first()
    tasks = max(-(-(total[0] or 0) // TASK_BYTES), -(-(total[1] or 0) // BLOCK_RECORDS), 1)
    blocks = blocks.repartition(tasks, F.col("path"), F.element_at("offsets", 1))
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    return blocks.mapInArrow(_reader(root, arrow, with_payload), RECORD.format(id_type))


def new_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/roadlens-warc/{uuid.uuid4().hex}"


def op4_warc_packages(pages: DataFrame) -> DataFrame:
    root = new_folder(pages.sparkSession)
    manifest = write_packages(pages, root)
    out = read_packages(manifest, root, pages.schema["page_id"].dataType.simpleString(), with_payload=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# base32 by hand: five hexadecimal digits are four letters
SQL = r"""
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages
), hashed AS (
    SELECT *, sha1(payload) AS hex FROM rows
)
SELECT page_id, strlen(payload) AS payload_bytes,
    array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (j // 4), 5))::BIGINT >> (15 - 5 * (j % 4))::INT) & 31), 1)
        for j in range(32)
    ], '') AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to
FROM hashed
"""
