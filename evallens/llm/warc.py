"""WARC archives: a writer that stores repeated payloads once, and a splittable reader.

Archives are gzip files with one member per record.  The reader's tasks get
byte ranges; each looks for the gzip magic in its range, takes a candidate as a
member only if it decodes to a WARC header, and owns the records that start
inside.  Folders are named through the session's file system; files are opened
through `pyarrow.fs`, so any store it knows will do.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import stored
from evallens.session import scratch_path
from evallens.sources.paths import open_fs, qualified

MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
READ = 1 << 18
MAX_TASKS = 100_000  # beyond it, tasks read several ranges


def _member(lines: list[str], block: bytes, level: int) -> bytes:
    head = "WARC/1.1\r\n" + "".join(x + "\r\n" for x in lines) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head.encode("utf-8")) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def with_revisits(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Adds payload, payload_bytes, payload_digest (hex SHA-1) and refers_to.

    Of pages with equal payloads of at least `min_bytes`, that with the largest
    page_id is the response and the others refer to it.  Pages without an id
    refer to nothing; rows that repeat the largest id with its payload are all
    responses.  NULL html is an empty payload.  Only ids and digests are
    shuffled to find the copies (one row per payload after map-side
    combination); Spark broadcasts the revisit table only if its stored size is
    under the broadcast threshold.
    """
    p = pages.withColumn("payload", F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary"))
    p = p.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    keys = p.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest", "payload_bytes")
    kept = keys.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    kept = kept.where(F.col("_n") > 1).drop("_n")
    revisits = keys.join(kept, ["payload_digest", "payload_bytes"]).where(F.col("page_id") < F.col("refers_to"))
    revisits = stored(revisits.select("page_id", "payload_digest", "refers_to").distinct(), "warc-revisits")
    return p.join(revisits, ["page_id", "payload_digest"], "left")


def write_warc(pages: DataFrame, out: str | None = None, date: str = "2020-01-01T00:00:00Z", min_bytes: int = 1000,
               level: int = 6, file_bytes: int = 1 << 30) -> DataFrame:
    """Writes one record per row of `pages` (page_id, url, html); returns the archives (path, bytes, records).

    Each task streams its rows to files of its own under `out` (default: a new
    folder in the shared one) and reports them; only reported files count, so a
    retried task leaves nothing half-written behind in the result.  A revisit
    holds the HTTP header with the payload's length and no payload.  Other columns
    are not read; empty input gives no archive.
    """
    spark = pages.sparkSession
    out = qualified(spark, out or scratch_path(spark, "warc"))
    rows = with_revisits(pages.select("page_id", F.col("url").cast("string").alias("url"), "html"), min_bytes)
    rows = rows.select("page_id", "url", "payload", "payload_digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(out)
        fs.create_dir(folder, recursive=True)
        done, sink, name, n = [], None, "", 0

        def close():
            done.append((f"{out}/{name}", sink.tell(), n))
            sink.close()

        for b in batches:
            c = {k: b.column(k) for k in ("page_id", "url", "payload", "payload_digest", "refers_to")}
            for i in range(b.num_rows):
                if sink is not None and sink.tell() >= file_bytes:
                    close()
                    sink = None
                if sink is None:
                    name, n = f"{uuid.uuid4().hex}.warc.gz", 0
                    sink = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    sink.write(_member(["WARC-Type: warcinfo", f"WARC-Date: {date}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
                                        "Content-Type: application/warc-fields"], b"format: WARC File Format 1.1\r\n", level))
                pid, url, body = c["page_id"][i].as_py(), c["url"][i].as_py(), c["payload"][i].as_buffer()
                digest, refers = c["payload_digest"][i].as_py(), c["refers_to"][i].as_py()
                ident = f"{ID}{'' if pid is None else pid}"
                head = [f"WARC-Type: {'response' if refers is None else 'revisit'}",
                        f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#%!*()[]~') if url else ident}",
                        f"WARC-Date: {date}", f"WARC-Record-ID: <{ident}>", f"WARC-Payload-Digest: sha1:{digest}",
                        "Content-Type: application/http; msgtype=response"]
                if refers is not None:
                    head += [f"WARC-Refers-To: <{ID}{refers}>", f"WARC-Profile: {REVISIT_PROFILE}"]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {body.size}\r\n\r\n".encode()
                sink.write(_member(head, http if refers is not None else http + body.to_pybytes(), level))
                n += 1
        if sink is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["path", "bytes", "records"])

    return stored(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-files")


class _Source:
    """A file read forward in pieces from any offset."""

    def __init__(self, f):
        self.f, self.size = f, f.size()

    def at(self, offset: int, n: int = READ) -> bytes:
        n = min(n, self.size - offset)
        return self.f.read_at(n, offset) if n > 0 else b""


def _find_magic(src: _Source, at: int, end: int) -> int:
    """First offset in [at, end) of the magic bytes, or -1."""
    while at < end:
        piece = src.at(at, min(READ, end - at) + len(MAGIC) - 1)
        k = piece.find(MAGIC)
        if 0 <= k and at + k < end:
            return at + k
        at += READ
    return -1


def _decode(src: _Source, at: int) -> tuple[bytes, int] | None:
    """(content, end offset) of the gzip member at `at` if it is a WARC record, else None."""
    z, out, head_ok, pos = zlib.decompressobj(31), [], False, at
    got = b""
    while not z.eof:
        piece = src.at(pos)
        if not piece:
            if head_ok:
                raise ValueError(f"the record at byte {at} is cut short")
            return None
        try:
            data = z.decompress(piece)
        except zlib.error:
            if head_ok:
                raise
            return None
        pos += len(piece)
        if not head_ok:
            got += data
            if got[:5] != b"WARC/"[:len(got)]:
                return None
            if b"\r\n\r\n" in got:
                head_ok = True
                out, data = [got], b""
            else:
                data = b""
        out.append(data)
    return (b"".join(out), pos - len(z.unused_data)) if head_ok else None


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


def records(src: _Source, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records that start in [start, end)."""
    at = start
    while 0 <= (at := _find_magic(src, at, end)):
        got = _decode(src, at)
        if got is None:
            at += 1
            continue
        content, stop = got
        head, _, rest = content.partition(b"\r\n\r\n")
        fields = _fields(head)
        yield at, fields, rest[:int(fields.get("content-length", 0))]
        at = stop


READ_SCHEMA = ("path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
               "payload_bytes long, payload_digest string, payload binary")


def read_warc(archives: DataFrame, split_bytes: int = 32 << 20, payloads: bool = True) -> DataFrame:
    """Response and revisit records of `archives` (path, bytes): one row each.

    A path without a file system is taken in the session's.

    Ranges of `split_bytes` are dealt to tasks.  A response's length and digest
    are computed from the payload read and held against the header's digest (a
    difference is an error); a revisit's are those its header gives.
    `payloads=False` leaves the payload column NULL.
    """
    step = F.lit(int(split_bytes))
    home = qualified(archives.sparkSession, "/").rstrip("/")
    path = F.when(F.col("path").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("path")).otherwise(F.concat(F.lit(home), "path"))
    archives = stored(archives.select(path.alias("path"), "bytes"), "warc-archives")
    many = archives.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / step)), F.lit(0))).first()[0]
    ranges = archives.where(F.col("bytes") > 0).select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step.cast("long"))).alias("start"))
    # the rows are tiny: a given number of tasks keeps Spark from putting them together
    ranges = ranges.repartitionByRange(max(1, min(int(many), MAX_TASKS)), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                fs, name = open_fs(path)
                with fs.open_input_file(name) as f:
                    src = _Source(f)
                    for at, h, block in records(src, start, min(start + split_bytes, src.size)):
                        kind = h.get("warc-type")
                        if kind not in ("response", "revisit"):
                            continue
                        http, _, body = block.partition(b"\r\n\r\n")
                        said = h.get("warc-payload-digest", "").removeprefix("sha1:")
                        if kind == "response":
                            size, digest = len(body), hashlib.sha1(body).hexdigest()
                            if said and said != digest:
                                raise ValueError(f"{path} at byte {at}: the payload does not match its digest")
                        else:
                            size, digest, body = int(_fields(http).get("content-length", 0)), said, b""
                        rows.append((path, at, kind, h.get("warc-record-id", "").strip("<>"), h.get("warc-target-uri"),
                                     h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None, size, digest,
                                     body if payloads else None))
                        held += 500 + (len(body) if payloads else 0)
                        if held > 8 << 20:
                            yield batch()
                            rows, held = [], 0
        if rows:
            yield batch()

    return ranges.mapInArrow(run, READ_SCHEMA)


def page_records(recs: DataFrame) -> DataFrame:
    """The records as pages: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    number = lambda c: F.nullif(F.regexp_replace(c, f"^{ID}", ""), F.lit("")).cast("long")
    return recs.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       number("refers_to").alias("refers_to"))
