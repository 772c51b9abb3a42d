"""Operator 10: WARC archives and the monolithic-gzip normaliser.

1. ``write_archives`` writes each input partition's pages as WARC records
   into one gzip stream a file (a new file every ``ROLL_BYTES``), and gives a
   manifest row a record: archive, ordinal, page_id, size, digest.
2. ``duplicates`` groups the manifest by payload digest: the record with the
   largest page_id answers, the others revisit it. Only narrow rows move.
3. ``normalise`` inflates each whole-file stream once, rewrites every record
   as a gzip member of its own (revisits without their payload), and writes a
   sidecar index (JSON lines) of offsets beside the archive.
4. ``read_records`` reads members back by the index.

Payloads never pass a shuffle or the driver. Files go to a shared folder;
a task writes under a name of its own attempt, and only names in a committed
manifest count, so a task that is lost or repeated leaves no wrong record.
Files are opened through ``pyarrow.fs`` (local paths, and the stores it
knows).

Defined cases: null html is an empty payload; null urls have no target
header; a null page_id is always a response; rows that repeat the largest
page_id of a group are all responses; an empty table writes no archive.
Only the named columns are read. One record has to fit in memory.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.shared import pick, written
from tidepool.session import delete_path, scratch_path

ROLL_BYTES = 256 << 20  # of uncompressed records in one archive
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def record(kind: str, page_id: int | None, uri: str | None, digest: str, size: int, payload: bytes,
           refers_to: int | None = None) -> bytes:
    """One WARC/1.1 record with its closing blank lines."""
    name = "null" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{name}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + _END + payload + _END


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:] if x)


def split_records(stream, chunk: int = 1 << 20):
    """(header bytes, payload) of each record of a gzip stream of one or
    more members, inflated once from start to end."""
    inflate, buf, raw = zlib.decompressobj(31), bytearray(), b""
    done = seen = False
    need = None
    while True:
        while True:
            if need is None:
                at = buf.find(_END)
                if at < 0:
                    break
                head = bytes(buf[:at])
                need = int(headers(head)["Content-Length"])
                del buf[:at + 4]
            if len(buf) < need + 4:
                break
            yield head, bytes(buf[:need])
            del buf[:need + 4]
            need = None
        if done:
            if buf or need is not None or (seen and not inflate.eof):
                raise ValueError("the archive ends inside a record")
            return
        if not raw:
            raw = stream.read(chunk)
        if inflate.eof and raw:
            inflate = zlib.decompressobj(31)
        buf += inflate.decompress(raw)
        done, seen = not raw, seen or bool(raw)
        raw = inflate.unused_data if inflate.eof else b""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Lazy manifest (archive, ordinal, page_id, payload_bytes, digest); the
    archives are written when it is computed, so compute it once."""
    def run(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        fs, base = _file_system(folder)
        out, squeeze, used, n_files, ordinal, name = None, None, 0, 0, 0, ""

        def close():
            nonlocal out
            if out is not None:
                out.write(squeeze.flush())
                out.close()
                out = None

        for batch in batches:
            rows = []
            for page, uri, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                if out is None or used >= ROLL_BYTES:
                    close()
                    name = f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{n_files:04d}.warc.gz"
                    out, squeeze = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                    used, ordinal, n_files = 0, 0, n_files + 1
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                digest, page = payload_digest(payload), page.as_py()
                raw = record("response", page, uri.as_py(), digest, len(payload), payload)
                out.write(squeeze.compress(raw))
                used += len(raw)
                rows.append((name, ordinal, page, len(payload), digest))
                ordinal += 1
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(_MANIFEST.names, r, strict=True)) for r in rows], schema=_MANIFEST)
        close()

    return pages.mapInArrow(run, "archive string, ordinal long, page_id long, payload_bytes long, digest string")


_MANIFEST = pa.schema([("archive", pa.string()), ("ordinal", pa.int64()), ("page_id", pa.int64()),
                       ("payload_bytes", pa.int64()), ("digest", pa.string())])
_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                    ("record_type", pa.string())])


def duplicates(manifest: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(archive, ordinal, refers_to) of the records that repeat the payload
    of a record with a larger page_id."""
    big = manifest.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    best = (big.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("_low"))
            .where("refers_to <> _low").drop("_low"))
    return (big.join(best, "digest").where("page_id <> refers_to").select("archive", "ordinal", "refers_to"))


def normalise(todo: DataFrame, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Lazy index (archive, offset, length, page_id, record_type) of the
    rewritten archives; ``todo`` has a row for each archive of ``source`` with
    ``revisits``, an array of (ordinal, refers_to)."""
    def run(batches):
        from pyspark import TaskContext
        fs, old = _file_system(source)
        _, new = _file_system(target)
        for batch in batches:
            for row in batch.to_pylist():
                again = {r["ordinal"]: r["refers_to"] for r in row["revisits"] or []}
                name = row["archive"].removesuffix(".warc.gz") + f"-{TaskContext.get().taskAttemptId()}.warc.gz"
                rows, at = [], 0
                with fs.open_input_stream(f"{old}/{row['archive']}", compression=None) as src, \
                        fs.open_output_stream(f"{new}/{name}", compression=None) as out:
                    for k, (head, payload) in enumerate(split_records(src)):
                        h = headers(head)
                        page = h["WARC-Record-ID"][len("<urn:x-page:"):-1]
                        page = None if page == "null" else int(page)
                        kind = "revisit" if k in again else "response"
                        raw = record(kind, page, h.get("WARC-Target-URI"), h["WARC-Payload-Digest"].split(":")[1],
                                     int(h["X-Payload-Length"]), b"" if k in again else payload, again.get(k))
                        squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = squeeze.compress(raw) + squeeze.flush()
                        out.write(member)
                        rows.append((name, at, len(member), page, kind))
                        at += len(member)
                with fs.open_output_stream(f"{new}/{name}.idx", compression=None) as out:
                    for r in rows:
                        out.write((json.dumps(dict(zip(_INDEX.names, r, strict=True))) + "\n").encode())
                for lo in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_pylist([dict(zip(_INDEX.names, r, strict=True)) for r in rows[lo:lo + 10_000]],
                                                     schema=_INDEX)

    return todo.mapInArrow(run, "archive string, offset long, length long, page_id long, record_type string")


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of the index rows, read from the archives: page_id, url,
    payload_bytes, payload_digest, record_type, refers_to, and the payload if
    asked for. A response whose digest is wrong fails the job."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
                       + ([("payload", pa.binary())] if with_payload else []))

    def number(name):
        text = name[len("<urn:x-page:"):-1]
        return None if text == "null" else int(text)

    def run(batches):
        fs, base = _file_system(folder)
        name, src = None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["archive"] != name:
                    if src is not None:
                        src.close()
                    name, src = r["archive"], fs.open_input_file(f"{base}/{r['archive']}")
                src.seek(r["offset"])
                head, payload = next(split_records(pa.BufferReader(src.read(r["length"])), 1 << 24))
                h = headers(head)
                kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].split(":")[1]
                if kind == "response" and payload_digest(payload) != digest:
                    raise ValueError(f"{name} at {r['offset']}: the payload does not have its digest")
                rows.append([number(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), int(h["X-Payload-Length"]), digest, kind,
                             number(h["WARC-Refers-To"]) if kind == "revisit" else None] + [payload] * with_payload)
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
        if src is not None:
            src.close()

    return index.select("archive", "offset", "length").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
        + (", payload binary" if with_payload else ""))


def make_folder(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = 0, level: int = LEVEL) -> tuple[DataFrame, str]:
    """Write all pages as normalised archives with sidecar indexes; gives the
    index and the folder (by default below the shared checkpoint folder)."""
    spark = pages.sparkSession
    mono = scratch_path(spark, "llm/warc-streams")
    if folder is None:
        folder = scratch_path(spark, "llm/warc")
    make_folder(spark, mono)
    make_folder(spark, folder)
    base = pick(pages, {"page_id": id_col, "url": url_col, "html": html_col}).withColumn("page_id", F.col("page_id").cast("long"))
    manifest = written(write_archives(base, mono, level), "warc-manifest")
    again = duplicates(manifest, min_bytes).groupBy("archive").agg(
        F.collect_list(F.struct("ordinal", "refers_to")).alias("revisits"))  # at most one archive's records
    every = manifest.groupBy("archive").agg(F.count("*").alias("records"))
    n = max(1, every.count())
    todo = every.join(again, "archive", "left").select("archive", "revisits").repartition(n)
    index = written(normalise(todo, mono, folder, level), "warc-index")
    delete_path(spark, mono)  # the committed index no longer needs the streams
    return index, folder
