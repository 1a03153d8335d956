"""Web archive files with a two-level capture index.

Captures are sorted by reversed-host URL key and page id over all tasks. Each task writes its
range as WARC files of one gzip member per record, and an index file of compressed blocks of
``BLOCK`` lines in key order. The first key of each block goes to a sparse directory file beside the index
file; the first key of each directory, one per task that had rows, to the catalog, which is all that is held in
memory. A look-up is a binary search in the catalog, one in the directory, one in a block,
and a range read of the record. Sorted look-ups read files front to back.

Captures with equal payloads of ``least_bytes`` or more are stored once: the one with the
greatest page id is the response, the others are revisit records that refer to it. Equal page
ids have equal types; a null page id comes before all others. A null payload is empty, a null URL
empty. Every capture is written, also repeated rows. An empty table makes no files. Other columns
are ignored. A record whose payload does not have its digest is an error.

Files are written below the folder of ``spark.checkpoint.dir`` under names that no other
attempt of a task uses; what a lost attempt wrote is named in no catalog.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.session import freeze, scratch_path

BLOCK = 512
MAX_FILE_BYTES = 1 << 30
READ_AHEAD = 1 << 20
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NO_ID = -(1 << 63)


class Archive(NamedTuple):
    root: str
    catalog: list[tuple[str, int, str]]  # first key, first page id, name of the index file


def url_key(url: Column) -> Column:
    """``com,example)/path?query`` of a URL in lower case; one without ``://`` is its own key."""
    lower = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(lower, r"(?s)^.*?://([^/?#]*)", 1)
    rest = F.regexp_extract(lower, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(lower.contains("://"), F.concat(reversed_host, F.lit(")"), rest)).otherwise(lower)


def _filesystem(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record(page_id: int | None, url: str, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    name = "" if page_id is None else str(page_id)
    revisit = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if refers_to is not None else []
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"X-Page-ID: {name}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *revisit,
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(payload)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def _writer(root: str, block: int, max_file_bytes: int):
    """Arrow map over (key, page_id, url, payload, digest, bytes, refers_to), sorted: writes files, returns catalog rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _filesystem(root)
        name = uuid.uuid4().hex
        files: list = []
        lines: list[str] = []
        directory: list[list] = []
        index = None
        index_at = at = 0

        def close_block():
            nonlocal index_at
            if lines:
                packed = _member("\n".join(lines).encode())
                first = json.loads(lines[0])
                directory.append([first[0], first[1], index_at, len(packed)])
                index.write(packed)
                index_at += len(packed)
                lines.clear()

        for batch in batches:
            for key, page, url, payload, digest, size, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if index is None:
                    index = filesystem.open_output_stream(f"{base}/{name}.index")
                if not files or at >= max_file_bytes:
                    if files:
                        files[-1][1].close()
                    file = f"{name}-{len(files)}.warc.gz"
                    # members are compressed here; the name must not have it done again
                    files.append((file, filesystem.open_output_stream(f"{base}/{file}", compression=None)))
                    at = 0
                digest32 = base64.b32encode(bytes.fromhex(digest)).decode()
                packed = _member(_record(page, url, payload or b"", digest32, size, refers))
                files[-1][1].write(packed)
                lines.append(json.dumps([key, _NO_ID if page is None else page, files[-1][0], at, len(packed)]))
                at += len(packed)
                if len(lines) >= block:
                    close_block()
        if index is None:
            return
        close_block()
        index.close()
        files[-1][1].close()
        with filesystem.open_output_stream(f"{base}/{name}.directory") as out:
            out.write(zlib.compress(json.dumps(directory).encode()))
        row = [[directory[0][0]], [directory[0][1]], [name]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], names=["key", "page_id", "name"])

    return run


def write_archive(
    pages: DataFrame, page: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
    block: int = BLOCK, max_file_bytes: int = MAX_FILE_BYTES,
) -> Archive:
    spark = pages.sparkSession
    root = scratch_path(spark, "archive")
    filesystem, base = _filesystem(root)
    filesystem.create_dir(base, recursive=True)
    captures = pages.select(
        F.col(page).alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("bigint")})
    many = captures.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    many = freeze(many.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"), "equal-payloads")
    typed = captures.join(many, "digest", "left")
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("first"))
    typed = typed.withColumn("refers_to", F.when((F.col("bytes") >= least_bytes) & older, F.col("first")))
    rows = typed.select(
        url_key(F.col("url")).alias("key"),
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "digest",
        "bytes",
        "refers_to",
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["key", "page_id", "_row"]  # the last splits even rows that are equal in the others
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    catalog = freeze(sorted_rows.mapInArrow(_writer(root, block, max_file_bytes), "key string, page_id bigint, name string"), "catalog")
    found = sorted((r["key"], r["page_id"], r["name"]) for r in catalog.collect())
    return Archive(root, found)


class _Files:
    """Range reads with the bytes that follow kept for the next one."""

    def __init__(self, root: str):
        self.filesystem, self.base = _filesystem(root)
        self.name, self.file, self.size, self.start, self.held = "", None, 0, 0, b""

    def read(self, name: str, at: int, length: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            self.file = self.filesystem.open_input_file(f"{self.base}/{name}")
            self.name, self.size, self.held = name, self.file.size(), b""
        if not self.start <= at <= at + length <= self.start + len(self.held):
            self.held = self.file.read_at(min(max(length, READ_AHEAD), self.size - at), at)
            self.start = at
        return self.held[at - self.start : at - self.start + length]


class Index:
    """Look-ups in an archive; holds one directory and one block at a time."""

    def __init__(self, archive: Archive):
        self.archive = archive
        self.starts = [(k, p) for k, p, _ in archive.catalog]
        self.indexes, self.records = _Files(archive.root), _Files(archive.root)
        self.filesystem, self.base = _filesystem(archive.root)
        self.directory: tuple[str, list, list] = ("", [], [])
        self.block: tuple[str, int, list, list] = ("", -1, [], [])

    def _directory(self, name: str):
        if self.directory[0] != name:
            with self.filesystem.open_input_stream(f"{self.base}/{name}.directory") as file:
                entries = json.loads(zlib.decompress(file.read()))
            self.directory = (name, [(e[0], e[1]) for e in entries], entries)
        return self.directory[1:]

    def _block(self, name: str, at: int, length: int):
        if self.block[:2] != (name, at):
            lines = [json.loads(x) for x in zlib.decompress(self.indexes.read(f"{name}.index", at, length), 31).split(b"\n")]
            self.block = (name, at, [(x[0], x[1]) for x in lines], lines)
        return self.block[2:]

    def captures(self, key: str, page_id: int | None) -> Iterator[bytes]:
        """Records with this key and page id. They may begin in the block before the first one that starts with them."""
        wanted = (key, _NO_ID if page_id is None else page_id)
        part = max(0, bisect_left(self.starts, wanted) - 1)
        while part < len(self.starts) and self.starts[part] <= wanted:
            name = self.archive.catalog[part][2]
            firsts, entries = self._directory(name)
            for b in range(max(0, bisect_left(firsts, wanted) - 1), bisect_right(firsts, wanted)):
                keys, lines = self._block(name, *entries[b][2:])
                for i in range(bisect_left(keys, wanted), bisect_right(keys, wanted)):
                    _, _, file, at, length = lines[i]
                    yield zlib.decompress(self.records.read(file, at, length), 31)
            part += 1


def parse(record: bytes) -> dict:
    """Header fields by name, and the payload of a response."""
    head, _, body = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = body[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http"] = http.decode()
    fields["payload"] = payload if fields["WARC-Type"] == "response" else None
    return fields


_FOUND = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _reader(archive: tuple, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(Archive(*archive))
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        if with_payload:
            names, types = [*names, "payload"], [*types, pa.binary()]
        for batch in batches:
            rows = []
            for key, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for record in index.captures(key, page):
                    f = parse(record)
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(re.search(r"Content-Length: (\d+)", f["http"])[1])
                    payload = f["payload"]
                    if payload is not None and (base32_sha1(payload) != digest or len(payload) != size):
                        raise ValueError(f"page {page}: the payload does not have its digest")
                    refers = re.fullmatch(r"<urn:page:(-?\d+)>", f.get("WARC-Refers-To", ""))
                    row = [
                        int(f["X-Page-ID"]) if f["X-Page-ID"] else None, f["WARC-Target-URI"], size, digest, f["WARC-Type"],
                        int(refers[1]) if refers else None,
                    ]
                    rows.append(row + [payload] if with_payload else row)
                    if len(rows) >= 4096:
                        yield _batch(rows, types, names)
                        rows = []
            if rows:
                yield _batch(rows, types, names)

    return run


def _batch(rows: list, types: list, names: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def look_up(spark: SparkSession, archive: Archive, wanted: DataFrame, url: str = "url", page: str = "page_id", with_payload: bool = False) -> DataFrame:
    """Every record of the wanted captures (url, page id), each capture once however often it is asked for."""
    keys = wanted.select(url_key(F.col(url)).alias("key"), F.col(page).cast("bigint").alias("page_id")).distinct()
    # keys are short but each is a range read: as many tasks as wrote the archive, however small the keys are
    tasks = max(1, len(archive.catalog))
    ranged = keys.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
    return ranged.mapInArrow(_reader(tuple(archive), with_payload), _FOUND + (", payload binary" if with_payload else ""))
