"""WARC archives: a distributed writer and a splittable reader.

The writer gives each record a gzip member of its own. The reader's tasks get byte ranges: a task looks for the gzip
magic from its range's start, takes a candidate only if its first bytes inflate to a WARC header, and owns the records
that start inside its range; the last one is read beyond the range's end. After a record the next begins where its
member ended, so the search is needed once per range.
"""

import hashlib
import posixpath
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import functions as F

from tapework.session import fresh_path, stage_table

SPLIT_BYTES = 16 << 20
#: Payloads below this are never stored as revisits.
REVISIT_BYTES = 100
CHUNK = 1 << 20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "path string, bytes long, records long"
_RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def with_revisits(pages):
    """``pages`` as ``page_id``, ``url``, ``payload`` (UTF-8, null: empty), its digest and ``refers_to``.

    Of equal payloads of at least 100 bytes the rows with the smallest ``page_id`` are responses; the others refer to
    it. Rows equal in page and payload are alike: all responses or all revisits. A null ``page_id`` never is the
    smallest unless there is no other. Only digests are grouped, so a payload that a third of all pages share costs a
    few bytes a page; pages meet their record by ``page_id`` and digest.
    """
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    marked = rows.select("page_id", "digest", F.octet_length("payload").alias("n")).where(F.col("n") >= REVISIT_BYTES).distinct()
    first = marked.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages")).where("pages > 1")
    later = marked.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), F.col("first").alias("refers_to"))
    return rows.join(later, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left").drop("_page", "_digest")


def _urn(page_id):
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _record(page_id, url, payload, digest, refers_to, date):
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if revisit:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data, level):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records, folder, *, date="1970-01-01T00:00:00Z", level=6):
    """Write rows of ``with_revisits`` under ``folder`` (any URI that pyarrow's filesystems open); one file a task.

    Returns ``path, bytes, records`` of the files. A file gets its name only when it is complete, so a task that runs
    twice replaces it as a whole.
    """
    def write(batches):
        context = TaskContext.get()
        store, base = pafs.FileSystem.from_uri(folder)
        name = f"part-{context.partitionId():06d}.warc.gz"
        draft, final = posixpath.join(base, f"_{name}.{context.taskAttemptId()}"), posixpath.join(base, name)
        store.create_dir(base, recursive=True)
        size = records = 0
        with store.open_output_stream(draft) as out:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = _member(_record(*row, date), level)
                    out.write(data)
                    size, records = size + len(data), records + 1
        if records:
            if store.get_file_info(final).type != pafs.FileType.NotFound:
                store.delete_file(final)
            store.move(draft, final)
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "bytes": size, "records": records}])
        else:
            store.delete_file(draft)

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(write, _MANIFEST)


class _Window:
    """Bytes of a file from any offset on, read by chunks."""

    def __init__(self, file, size):
        self.file, self.size = file, size

    def at(self, offset, n=CHUNK):
        self.file.seek(offset)
        return self.file.read(min(n, max(0, self.size - offset)))


def starts_record(head):
    """Whether bytes that begin with the magic inflate to the start of a WARC record."""
    try:
        return zlib.decompressobj(31).decompress(head, len(VERSION)).startswith(b"WARC/1.")
    except zlib.error:
        return False


def find_record(window, start, end):
    """Offset of the first record in [start, end), or None. A magic that straddles two reads is seen."""
    at = start
    while at < end:
        data = window.at(at, min(CHUNK, end - at) + len(MAGIC) - 1)
        k = data.find(MAGIC)
        while k >= 0 and at + k < end:
            if starts_record(window.at(at + k, 4096)):
                return at + k
            k = data.find(MAGIC, k + 1)
        at += CHUNK
    return None


def read_member(window, offset):
    """(inflated bytes, offset behind the member); raises if the member is cut or damaged."""
    unpack, out, at = zlib.decompressobj(31), [], offset
    while not unpack.eof:
        data = window.at(at)
        if not data:
            raise ValueError(f"gzip member at {offset} has no end")
        out.append(unpack.decompress(data))
        at += len(data)
    return b"".join(out), at - len(unpack.unused_data)


def parse_record(data):
    """Headers (lower-case names) and content block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[:int(headers["content-length"])]


def records_in(window, start, end):
    """Records that start in [start, end)."""
    at = find_record(window, start, end)
    while at is not None and at < end:
        data, after = read_member(window, at)
        yield parse_record(data)
        at = after if starts_record(window.at(after, 4096)) else find_record(window, after, end)


def _page(urn):
    digits = urn.rpartition(":")[2].rstrip(">") if urn else ""
    return int(digits) if digits else None


def _row(headers, block, with_payload):
    revisit = headers["warc-type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    return {
        "page_id": _page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"), "record_type": headers["warc-type"],
        "payload_bytes": int(headers["x-payload-length"]) if revisit else len(payload),
        "payload_digest": headers["warc-payload-digest"].partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest(),
        "refers_to": _page(headers.get("warc-refers-to")), "payload": payload if with_payload else None,
    }


def read_archives(files, *, split_bytes=SPLIT_BYTES, with_payload=True):
    """Records of the archives in ``files(path, bytes)``, one task per byte range of ``split_bytes``.

    Payload length and digest of a response come from its bytes, those of a revisit from its header. URLs come back
    percent-encoded where the table had white space or a percent sign.
    """
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches):
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for headers, block in records_in(_Window(file, size), start, min(size, start + split_bytes)):
                        rows.append(_row(headers, block, with_payload))
                        held += len(block)
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # the rows are tiny and the work behind each is not: an explicit number keeps one range a task
    return ranges.repartition(max(1, ranges.count())).mapInArrow(read, _RECORDS)


def round_trip(pages, folder=None, *, split_bytes=SPLIT_BYTES, with_payload=True):
    """Write ``pages`` as archives and read them back. Without a folder a new one in the shared folder is used."""
    folder = folder or fresh_path(pages.sparkSession, "warc")
    files = stage_table(write_archives(with_revisits(pages), folder), "warc-files")
    return read_archives(files, split_bytes=split_bytes, with_payload=with_payload)
