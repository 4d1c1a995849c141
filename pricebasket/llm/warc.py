"""WARC archives: one gzip member per record, written and read by Spark tasks.

``write_archives`` turns rows into WARC records.  Records of equal payload (of
at least ``MIN_REVISIT`` bytes) are written once, as the response of the
smallest page_id; the others become revisit records that carry only the HTTP
headers.  The records of a task are packed into archives of about
``ARCHIVE_BYTES``, which Spark's text writer puts into the folder, whatever
store it is in: an archive is one value, its bytes unchanged, and the line
separator after it is a zero byte, the padding that gzip readers skip.

``read_archives`` reads them back: members are inflated incrementally, a record
ends where its Content-Length says, and block and payload digests are verified.

Defined results: NULL html is the empty payload; a NULL url leaves out the
target URI; rows repeated with the smallest page_id of a payload all are
responses; a NULL page_id is never the smallest unless all are NULL, and then
all are responses.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm.common import table, utf8
from pricebasket.session import cuts_folder

MIN_REVISIT = 100
ARCHIVE_BYTES = 8 << 20
CHUNK = 1 << 16
DATE = "2024-01-01T00:00:00Z"
#: Revisit profile of the WARC 1.1 standard: a payload identical by digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORD_KIND = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
               "payload_digest string, payload binary, digest_ok boolean")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str | None) -> int | None:
    number = (record or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def header_value(text: str) -> str:
    """A header's value on one line: line ends, other controls and '%' percent-coded."""
    return "".join(c if c >= " " and c not in "%\x7f" else f"%{ord(c):02X}" for c in text)


def plain_value(text: str) -> str:
    parts = text.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                revisit: bool) -> bytes:
    """One gzip member with one record; ``payload`` is its full payload, which a revisit leaves out."""
    block = HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {header_value(url)}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(utf8("\r\n".join(head)) + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


class MemberReader:
    """Bytes of successive gzip members, inflated as they are asked for."""

    def __init__(self, data: bytes):
        self.data, self.at, self.left = memoryview(data), 0, b""
        self.inflate = None

    def next_member(self) -> bool:
        """Go to the next member; False at the end.  Zero bytes between members are padding."""
        while self.at < len(self.data) and self.data[self.at] == 0:
            self.at += 1
        if self.at >= len(self.data):
            return False
        self.inflate, self.left = zlib.decompressobj(31), b""
        return True

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        if self.inflate.unconsumed_tail:
            source = self.inflate.unconsumed_tail
        else:
            source = self.data[self.at:self.at + CHUNK]
            self.at += len(source)
            if not len(source):
                raise ValueError("WARC: a gzip member is cut short")
        self.left += self.inflate.decompress(source, CHUNK)
        if self.inflate.eof:
            self.at -= len(self.inflate.unused_data)
        return True

    def until(self, mark: bytes) -> bytes:
        """The bytes before ``mark``, which is passed over."""
        while mark not in self.left:
            if not self._more():
                raise ValueError("WARC: a record's header does not end")
        found, _, self.left = self.left.partition(mark)
        return found

    def exactly(self, n: int) -> bytes:
        parts, have = [self.left], len(self.left)
        self.left = b""
        while have < n:
            if not self._more():
                raise ValueError("WARC: a record is shorter than its Content-Length")
            parts.append(self.left)
            have += len(self.left)
            self.left = b""
        whole = b"".join(parts)
        self.left = whole[n:]
        return whole[:n]

    def end(self) -> None:
        """The blank lines after a block, and the member's end."""
        if self.exactly(4) != b"\r\n\r\n":
            raise ValueError("WARC: a record does not end after its Content-Length")
        while self._more():
            pass
        if self.left:
            raise ValueError("WARC: more than one record in a gzip member")


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "surrogatepass").split("\r\n")
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}


def read_records(data: bytes) -> Iterator[dict]:
    """The records of one archive, in order.  ``payload`` is None for a revisit."""
    reader = MemberReader(data)
    while reader.next_member():
        head = _headers(reader.until(b"\r\n\r\n"))
        block = reader.exactly(int(head["content-length"]))
        reader.end()
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = head["warc-payload-digest"].removeprefix("sha256:")
        revisit = head["warc-type"] == "revisit"
        size = int(_headers(http)["content-length"])
        ok = head["warc-block-digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
        if not revisit:
            ok = ok and digest == hashlib.sha256(payload).hexdigest() and len(payload) == size
        url = head.get("warc-target-uri")
        yield {"page_id": page_of(head["warc-record-id"]), "url": None if url is None else plain_value(url),
               "record_type": head["warc-type"], "refers_to": page_of(head.get("warc-refers-to")), "payload_bytes": size,
               "payload_digest": digest, "payload": None if revisit else payload, "digest_ok": ok}


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit: int = MIN_REVISIT) -> None:
    """Write a record per row of ``pages`` to archives in ``folder`` (new)."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.encode(html_col, "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # the smallest page of each payload that occurs again: narrow rows, summed per task first
    shared = (rows.where(F.length("payload") >= min_revisit).groupBy("digest")
              .agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null")
              .select(F.col("digest").alias("shared_digest"), "first_id"))
    marked = rows.join(shared, F.col("digest") == F.col("shared_digest"), "left").select(
        "id", "url", "payload", "digest", "first_id")

    def pack(batches):
        parts, size = [], 0
        for b in batches:
            for i, url, payload, digest, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                revisit = first is not None and first != i
                member = make_record(i, url, payload, digest, first if revisit else None, revisit)
                parts.append(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["archive"])
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["archive"])

    archives = marked.mapInArrow(pack, "archive binary").select(F.col("archive").cast("string"))
    archives.write.option("maxRecordsPerFile", 1).option("lineSep", "\0").option("compression", "none").text(folder)


def read_archives(spark, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives in ``folder``."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "digest_ok"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]
    kind = RECORD_KIND
    if not payloads:
        names.remove("payload"), types.remove(pa.binary())
        kind = kind.replace("payload binary, ", "")
    schema = pa.schema(list(zip(names, types, strict=True)))

    def run(batches):
        for b in batches:
            for data in b.column(0).to_pylist():
                rows, size = [], 0
                for r in read_records(data):
                    rows.append([r[n] for n in names])
                    size += len(r["payload"] or b"") if payloads else 0
                    if len(rows) >= 2000 or size >= ARCHIVE_BYTES:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, schema)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, kind)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def round_trip(pages: DataFrame, payloads: bool = False, **cols) -> DataFrame:
    """``pages`` written to new archives in the shared folder and read back.
    A record whose digest does not hold is an error."""
    spark = pages.sparkSession
    folder = f"{cuts_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, **cols)
    records = read_archives(spark, folder, payloads)
    return records.withColumn("digest_ok", F.when(F.col("digest_ok"), True).otherwise(
        F.raise_error(F.concat(F.lit("WARC digest does not hold: page "), F.col("page_id").cast("string")))))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


ORACLE_OP5 = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
         sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (SELECT digest, min(page_id) AS first_id FROM p WHERE n >= {MIN_REVISIT} GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first_id IS NOT NULL AND first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to, true AS digest_ok
FROM p LEFT JOIN firsts USING (digest)
"""
