"""WARC archives: a distributed writer and a salvage reader.

Records are gzip members of their own, written through Spark's text sink, so archives can lie in
any store Spark writes to. The sink ends each row with one byte; that byte is the last of the
member, the high byte of its length field, which is zero below 16 MB. A longer record is followed
by an empty member, which ends so too.

The reader takes archives as bytes and checks each record: member checksum, version line, length, closing
line breaks and payload digest. After a failed check it searches for the next member or
version line that starts a valid record, goes on there, and logs the gap it leaves.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .common import whole_text

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
# Fixed value: the profile of a revisit by equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
# Payloads below so many bytes are never revisits.
LEAST_BYTES = 1000
# Archives hold so many payloads of fewer than LARGE_BYTES bytes, or one larger payload: a gigabyte and the headers at most.
RECORDS_PER_FILE = 1000
LARGE_BYTES = 1 << 20
# Bytes of an archive unpacked at once.
STEP = 1 << 14
# Rows handed on at once.
BATCH = 512

READ_SCHEMA = (
    "file string, offset long, kind string, page_id long, url string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to long, gap_bytes long, reason string"
)
READ_ARROW = pa.schema(
    [
        ("file", pa.string()), ("offset", pa.int64()), ("kind", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
        ("gap_bytes", pa.int64()), ("reason", pa.string()),
    ]
)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit (refers_to set) has the digest and length of its payload, not the payload."""
    revisit = refers_to is not None
    block = HTTP_HEAD + (b"" if revisit else payload)
    heads = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url or "")),
        ("WARC-Payload-Digest", f"sha1:{base32(digest)}"),
        ("WARC-Payload-Length", len(payload)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    if revisit:
        heads += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in heads).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """Gzip member, ending in a zero byte."""
    out = _gzip(data)
    return out if out[-1] == 0 else out + _gzip(b"")


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def marked_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to: of equal payloads of LEAST_BYTES or more the largest page_id is the response.

    A null page_id counts as smaller than any. A group whose page_ids are all null has nothing to refer to: all its rows are
    responses, as are smaller payloads. Other columns are not read, whatever their names.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), whole_text("html").alias("html"))
    keyed = base.withColumns({"digest": F.sha1("html"), "strong": F.sha2("html", 256)})
    sizable = F.octet_length("html") >= LEAST_BYTES
    groups = keyed.filter(sizable).groupBy("strong").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Written before it is joined: then AQE can split a payload that very many pages share.
    return keyed.join(cut_lineage(groups.drop("n")), "strong", "left").select(
        "page_id", "url", "html", "digest", F.when(sizable & ~F.col("last").eqNullSafe(F.col("page_id")), F.col("last")).alias("refers_to")
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives of all pages below ``path``/small and ``path``/large. A null html is an empty payload.

    An archive holds at most RECORDS_PER_FILE records of payloads below LARGE_BYTES, or one larger record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                rows = zip(*(c.to_pylist() for c in batch.slice(at, BATCH).columns))
                data = [member(record_bytes(i, url, html.encode(), digest, ref))[:-1] for i, url, html, digest, ref in rows]
                yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], names=["value"])

    marked = marked_pages(pages)
    large = F.octet_length("html") >= LARGE_BYTES
    for folder, rows, most in (("small", marked.filter(~large), RECORDS_PER_FILE), ("large", marked.filter(large), 1)):
        members = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
        members.write.option("lineSep", "\x00").option("maxRecordsPerFile", most).text(f"{path}/{folder}")


def headers(data: bytes, at: int, end: int) -> tuple[dict[str, str], int] | None:
    """Header fields of the record at ``at`` and where its block starts."""
    stop = data.find(b"\r\n\r\n", at, end)
    if not re.match(rb"WARC/1\.[01]\r\n", data[at : at + 10]) or stop < 0:
        return None
    fields = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields, stop + 4


def parse(data: bytes, at: int) -> tuple[dict, int] | str:
    """The record at ``at`` and where it ends, or why there is none."""
    found = headers(data, at, len(data))
    if not found:
        return "no record header"
    fields, start = found
    if not fields.get("content-length", "").isdigit():
        return "no length"
    end = start + int(fields["content-length"])
    if end + 4 > len(data):
        return "truncated"
    if data[end : end + 4] != b"\r\n\r\n":
        return "wrong length"
    block = data[start:end]
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    kind, digest = fields.get("warc-type", ""), fields.get("warc-payload-digest", "").removeprefix("sha1:").upper()
    sha1 = None if kind == "revisit" else hashlib.sha1(payload).hexdigest()
    if digest:
        try:
            said = base64.b32decode(digest).hex()
        except ValueError:
            return "unreadable digest"
        if sha1 and said != sha1:
            return "wrong digest"
        sha1 = said
    page = lambda name: int(m[1]) if (m := re.search(r"urn:page:(-?\d+)", fields.get(name, ""))) else None
    size = fields.get("warc-payload-length", "") if kind == "revisit" else ""
    return {
        "kind": kind, "page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "payload": None if kind == "revisit" else payload,
        "payload_bytes": int(size) if size.isdigit() else len(payload), "payload_digest": sha1, "refers_to": page("warc-refers-to"),
    }, end + 4


def salvage_plain(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, record or reason of a gap) over uncompressed records."""
    at = 0
    while at < len(data):
        found = parse(data, at)
        if not isinstance(found, str):
            yield at, found[1], found[0]
            at = found[1]
            continue
        nxt = at + 1
        while (m := re.compile(rb"WARC/1\.[01]\r\n").search(data, nxt)) and isinstance(parse(data, m.start()), str):
            nxt = m.start() + 1
        end = m.start() if m else len(data)
        yield at, end, found
        at = end


def inflate(data: bytes, at: int) -> tuple[bytes, int] | None:
    """Content of the gzip member at ``at`` and where it ends, if its checksum holds."""
    unpacker = zlib.decompressobj(31)
    out = []
    # Piece by piece: what follows the member is copied once per piece, not once per archive.
    while at < len(data) and not unpacker.eof:
        piece = data[at : at + STEP]
        at += len(piece)
        try:
            out.append(unpacker.decompress(piece))
        except zlib.error:
            return None
    return (b"".join(out), at - len(unpacker.unused_data)) if unpacker.eof else None


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, record or reason of a gap) over an archive of gzip members or plain records; starts are places in the file."""
    if MAGIC not in data:
        yield from salvage_plain(data)
        return
    at = 0
    while at < len(data):
        found = inflate(data, at) if data.startswith(MAGIC, at) else None
        if found:
            content, end = found
            for _, _, record in salvage_plain(content):
                yield at, end, record
            at = end
            continue
        plain = parse(data, at)
        if not isinstance(plain, str):
            yield at, plain[1], plain[0]
            at = plain[1]
            continue
        nxt = at + 1
        while True:
            places = [p for p in (data.find(MAGIC, nxt), data.find(b"WARC/1.", nxt)) if p >= 0]
            if not places:
                nxt = len(data)
                break
            nxt = min(places)
            if inflate(data, nxt) or not isinstance(parse(data, nxt), str):
                break
            nxt += 1
        yield at, nxt, "bad member" if data.startswith(MAGIC, at) else plain
        at = nxt


def read_archives(spark, path: str) -> DataFrame:
    """Records and gaps of the archives below ``path``: file, offset, kind (gap for a gap), the record's fields, gap_bytes, reason.

    An archive is one task's work and is held in memory: keep archives as small as
    ``write_archives`` does. No archive is rejected as a whole; an empty file has no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                name, data = batch.column("path")[k].as_py(), batch.column("content")[k].as_py()
                for start, end, record in salvage(data):
                    gap = {"kind": "gap", "gap_bytes": end - start, "reason": record} if isinstance(record, str) else record
                    waiting.append({"file": name, "offset": start} | gap)
                    if len(waiting) == BATCH:
                        yield pa.RecordBatch.from_pylist(waiting, schema=READ_ARROW)
                        waiting = []
        if waiting:
            yield pa.RecordBatch.from_pylist(waiting, schema=READ_ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(run, READ_SCHEMA)


def gaps(records: DataFrame) -> DataFrame:
    """The quarantine log: file, offset, gap_bytes, reason."""
    return records.filter("kind = 'gap'").select("file", "offset", "gap_bytes", "reason")


def op10_warc_salvage(spark, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    path = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    records = read_archives(spark, path).filter("kind <> 'gap'")
    return records.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, octet_length(encode(html))::BIGINT AS n, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND last IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM q
"""
