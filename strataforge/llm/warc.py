"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Every record is a gzip member of its own. Tasks write files of at most ``ROLL`` payload bytes below the shared folder,
each under a name of its own, and return a manifest; only files of the manifest count, so a lost or repeated task
leaves at most an unread file.

The reader walks members, or bare records where a file isn't compressed. A member that fails a check (gzip, version
line, length, digest) is quarantined: the reader searches for the next gzip magic or version line that starts a valid
record, goes on from there, and reports the skipped bytes as a gap.

Records with equal payloads of at least ``REVISIT_FROM`` bytes are one response, of the smallest id, and revisits of
it. Defined results: a null payload is empty; a null id sorts after all others; null addresses become about:blank;
repeated rows are records of their own, and those of the smallest id are all responses, as a revisit would refer to
itself; an empty table gives no records; extra columns are ignored.

The round trip holds what it reads against the manifest: a gap or a file with other records than were written raises.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, fresh_path, trimmed

REVISIT_FROM = 100
ROLL = 64 << 20
CHUNK = 1 << 16
#: Bytes of a record at most; a longer declared length is taken for damage.
MAX_RECORD = 1 << 30
VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_MANIFEST = "path string, records bigint, bytes bigint"
_RECORDS = "path string, start bigint, kind string, reason string, id string, type string, refers_to string, uri string, digest string, length bigint, payload binary"


def record(kind: str, record_id: str, uri: str, payload: bytes, digest: str, refers_to: str | None = None) -> bytes:
    """One uncompressed record. A revisit has the response's headers but not its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = [
        VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Full-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _filesystem(path: str):
    return pafs.FileSystem.from_uri(path)


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        out, done = None, []

        def close() -> None:
            if out is not None:
                stream, name, n, size = out
                stream.close()
                done.append((f"{folder}/{name}", n, size))

        for batch in batches:
            for key, url, html, kind, refers in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html", "kind", "refers")), strict=True):
                if out is None or out[3] >= ROLL:
                    close()
                    fs.create_dir(root, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = [fs.open_output_stream(f"{root}/{name}", compression=None), name, 0, 0]
                payload = (html or "").encode()
                uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "about:blank"
                data = record(kind, f"urn:page:{key}", uri, payload, hashlib.sha256(payload).hexdigest(), None if refers is None else f"urn:page:{refers}")
                out[0].write(_member(data))
                out[2] += 1
                out[3] += len(data)
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["path", "records", "bytes"])

    return write


def write_warc(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None) -> DataFrame:
    """Write one record per row; returns the manifest, read from a table in the shared folder.

    Only ids and digests are grouped by payload; payloads move once, by id, so copies of one page stay spread out.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    text = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), text.alias("html"))
    rows = rows.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "size": F.octet_length("html")})
    narrow = rows.where(F.col("size") >= REVISIT_FROM).select("id", "digest")
    groups = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    known = narrow.distinct().join(groups, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).select(F.col("id").alias("id2"), F.col("digest").alias("digest2"), "first")
    marked = rows.join(known, (rows["id"].eqNullSafe(known["id2"])) & (rows["digest"] == known["digest2"]), "left")
    kind = F.when(F.col("first").isNotNull(), "revisit").otherwise("response")
    ready = marked.select("id", "url", "html", kind.alias("kind"), F.col("first").alias("refers"))
    table = fresh_path(spark, "warc-manifest")
    ready.mapInArrow(trimmed(_writer(folder)), _MANIFEST).write.parquet(table)
    return spark.read.schema(_MANIFEST).parquet(table)


class _Source:
    """A file as a window of bytes that moves forward; reads CHUNK bytes at a time."""

    def __init__(self, stream):
        self.stream, self.base, self.data, self.ended = stream, 0, b"", False

    def fill(self) -> bool:
        more = b"" if self.ended else self.stream.read(CHUNK)
        self.ended = not more
        self.data += more
        return bool(more)

    def drop(self, n: int) -> None:
        self.data = self.data[n:]
        self.base += n


class Damage(Exception):
    pass


def _inflate(src: _Source) -> tuple[bytes, int]:
    """The member at the window's start and its compressed length."""
    unpacker, parts, at, size = zlib.decompressobj(31), [], 0, 0
    while not unpacker.eof:
        if at >= len(src.data) and not src.fill():
            raise Damage("truncated member")
        step = src.data[at : at + CHUNK]
        try:
            piece = unpacker.decompress(step)
        except zlib.error as e:
            raise Damage(f"gzip: {e}") from None
        at += len(step) - len(unpacker.unused_data)
        size += len(piece)
        if size > MAX_RECORD:
            raise Damage("member too long")
        parts.append(piece)
    return b"".join(parts), at


def parse(data: bytes, whole: bool) -> tuple[dict, int]:
    """The record at the start of ``data`` and its length. ``whole``: nothing may follow it."""
    if not re.match(rb"WARC/1\.[01]\r?\n", data):
        raise Damage("no version line")
    end = re.search(rb"\r?\n\r?\n", data)
    if not end:
        raise Damage("unended header")
    fields: dict[str, str] = {}
    for line in data[: end.start()].splitlines()[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line without a colon")
        fields[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        raise Damage("no content length")
    n = int(fields["content-length"])
    block = data[end.end() : end.end() + n]
    if len(block) < n:
        raise Damage("truncated block")
    closing = re.match(rb"(?:\r\n|\n){2}", data[end.end() + n : end.end() + n + 4])
    if not closing:
        raise Damage("wrong content length")
    size = end.end() + n + closing.end()
    if whole and size != len(data):
        raise Damage("bytes after the record")
    check = fields.get("warc-block-digest", "")
    if check.startswith("sha256:") and hashlib.sha256(block).hexdigest() != check[7:]:
        raise Damage("block digest")
    kind = fields.get("warc-type", "")
    payload = None
    if kind == "response":
        _, _, payload = block.partition(b"\r\n\r\n")
    check = fields.get("warc-payload-digest", "")
    if payload is not None and check.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != check[7:]:
        raise Damage("payload digest")
    bare = lambda x: x.strip("<>") if x else None
    length = len(payload) if payload is not None else int(fields.get("x-full-payload-length") or n)
    return {
        "id": bare(fields.get("warc-record-id")), "type": kind, "refers_to": bare(fields.get("warc-refers-to")), "uri": fields.get("warc-target-uri"),
        "digest": hashlib.sha256(payload).hexdigest() if payload is not None else check.removeprefix("sha256:") or None, "length": length, "payload": payload,
    }, size


_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
_MARK = 10


def salvage(stream) -> Iterator[dict]:
    """Records and gaps of one file in order: dicts with start, kind ('record' or 'gap') and reason."""
    src = _Source(stream)
    gap, reason = None, ""
    while src.data or src.fill():
        while len(src.data) < _MARK and src.fill():
            pass
        try:
            if src.data.startswith(b"\x1f\x8b"):
                data, size = _inflate(src)
                found, _ = parse(data, whole=True)
            else:
                if not re.match(rb"WARC/1\.", src.data):
                    raise Damage("neither member nor version line")
                while True:
                    try:
                        found, size = parse(src.data, whole=False)
                        break
                    except Damage as e:
                        more = str(e) in ("unended header", "truncated block", "wrong content length") and len(src.data) < MAX_RECORD
                        if not (more and src.fill()):
                            raise
        except Damage as e:
            if gap is None:
                gap, reason = src.base, str(e)
            # the next place that may start a member or a record
            while True:
                hit = _STARTS.search(src.data, 1)
                if hit:
                    src.drop(hit.start())
                    break
                src.drop(max(1, len(src.data) - _MARK) if not src.ended else len(src.data))
                if not src.fill():
                    src.drop(len(src.data))
                    break
            continue
        if gap is not None:
            yield {"start": gap, "kind": "gap", "reason": reason, "length": src.base - gap}
            gap = None
        yield {"start": src.base, "kind": "record", "reason": None} | found
        src.drop(size)
    if gap is not None:
        yield {"start": gap, "kind": "gap", "reason": reason, "length": src.base - gap}


def _reader(with_payload: bool):
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("reason", pa.string()), ("id", pa.string()), ("type", pa.string()), ("refers_to", pa.string()), ("uri", pa.string()), ("digest", pa.string()), ("length", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, at = _filesystem(path)
                rows, size = [], 0
                with fs.open_input_stream(at, compression=None) as stream:
                    for x in salvage(stream):
                        if not with_payload:
                            x["payload"] = None
                        rows.append({"path": path} | x)
                        size += len(x.get("payload") or b"") + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


def read_warc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the files in column ``path``, which all executors can open."""
    spread = files.select("path").repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(trimmed(_reader(with_payload)), _RECORDS)


def warc_round_trip(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Write the archives of ``pages`` and digest what the reader finds in them."""
    written = write_warc(pages, key)
    found = cut(read_warc(written, with_payload=False).drop("payload"), "warc-read")
    back = found.groupBy("path").agg(F.count_if(F.col("kind") == "record").alias("found"), F.count_if(F.col("kind") == "gap").alias("gaps"))
    wrong = written.join(back, "path", "left").where("coalesce(found, 0) <> records or gaps > 0")
    if not wrong.isEmpty():
        raise RuntimeError(f"archives don't hold what was written: {wrong.first()}")
    records = found.where("kind = 'record'")
    number = lambda c: F.regexp_extract(F.col(c), r"^urn:page:(-?[0-9]+)$", 1).try_cast("bigint")
    return records.select(
        number("id").alias(key), F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )
