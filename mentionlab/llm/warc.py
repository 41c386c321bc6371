"""WARC archives of pages: written as segmented records, read back and put together.

Writing: of the records with equal payloads (by SHA-256) of at least ``min_revisit`` bytes,
the one with the smallest page id is a response and the others are revisits that refer to its
record id.  Record ids hold the page id and a number of the row, taken from the file and place that
the row is read from where Spark knows them, so every task gives a row the same one.  A
response holds an HTTP message with a chunked body; a block longer than ``segment`` bytes is
cut into a first record and continuation records.  Spark's text writer stores one record per
row with the record end as line separator and zips each file, so archives can be anywhere
Spark writes, and no file holds more than ``per_file`` records of bounded size.

Reading: each file is parsed by its content lengths; continuation records are grouped by the
identifier of their origin, ordered by segment number, and the total length is verified
before the chunked framing is decoded and the payload digest checked.

Defined cases: a null html is an empty payload; a null url is left out of the record and
read back as null; of rows with the smallest page id of a payload all are responses, so
repeated rows are kept; null page ids come after all others and never become the response
of a payload that has a row with an id; an empty table gives an empty archive.  A page whose
segments are incomplete or whose length, framing or digest is wrong is returned with
``valid`` false.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.llm.common import emit
from mentionlab.session import scratch_path

SEGMENT = 32 << 10
CHUNK = 4096
PER_FILE = 1000
MIN_REVISIT = 100

# Fixed values of the format.
VERSION = b"WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http;msgtype=response"
DATE = "2024-01-01T00:00:00Z"


def record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, serial, url, payload, digest, first, first_serial): ``first`` is the page a revisit
    refers to, and ``first_serial`` the number of its record."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), _serial(pages).alias("serial"),
                        F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "serial"))
    again = (rows.filter(F.octet_length("payload") >= min_revisit).groupBy("digest")
             .agg(F.min(named).alias("least"), F.count(F.lit(1)).alias("n"))
             .filter((F.col("n") > 1) & F.col("least").isNotNull()).drop("n"))
    revisit = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least.page_id"))
    return rows.join(again, "digest", "left").select(
        "page_id", "serial", "url", "payload", "digest", F.when(revisit, F.col("least.page_id")).alias("first"),
        F.when(revisit, F.col("least.serial")).alias("first_serial"))


def _serial(pages: DataFrame) -> Column:
    """A number that tells rows of one page id apart."""
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        pages.select(place).schema  # noqa: B018 - analysed here: only tables read from files know it
    except AnalysisException:
        return F.monotonically_increasing_id()
    return place


def pieces(data: bytes, size: int) -> list[bytes]:
    """``data`` in parts of at most about ``size`` bytes, cut between characters."""
    out, start = [], 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        end = end if end > start else min(start + size, len(data))
        out.append(data[start:end])
        start = end
    return out


def chunked(data: bytes, size: int = CHUNK) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in pieces(data, size)) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The body of chunked transfer framing; extensions are skipped, bad framing raises."""
    out, at = [], 0
    while True:
        line = data.index(b"\r\n", at)
        size = int(data[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if data[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk without end")
        out.append(data[at:at + size])
        at += size + 2


def _header(fields: list[tuple[str, object]]) -> str:
    return f"{VERSION.decode()}\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"


def _uri(url: str | None) -> str | None:
    """Control characters and spaces would end the header line: they are percent-encoded."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)


def _unuri(uri: str | None) -> str | None:
    return None if uri is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), uri)


def _record_id(page_id: int | None, serial: int) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{serial & (1 << 64) - 1:016x}>"


def records_of(page_id: int | None, serial: int, url: str | None, payload: bytes, digest: str,
               first: int | None, first_serial: int | None = None, segment: int = SEGMENT) -> Iterator[str]:
    """The records of one page, each without its final two line ends."""
    name = _record_id(page_id, serial)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if first is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
        yield _header([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common,
                       ("WARC-Refers-To", _record_id(first, first_serial)), ("WARC-Profile", REVISIT_PROFILE),
                       ("Content-Type", RESPONSE_TYPE), ("Content-Length", len(block))]) + block
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = pieces(block, segment)
    for n, part in enumerate(parts, 1):
        if n == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, ("Content-Type", RESPONSE_TYPE),
                      ("WARC-Segment-Number", 1 if len(parts) > 1 else None)]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{n}>"), ("WARC-Date", DATE),
                      ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n),
                      ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)]
        yield _header([*fields, ("Content-Length", len(part))]) + part.decode()


def _records(segment: int):
    schema = pa.schema([("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield emit(schema, [list(records_of(*page, segment=segment))])

    return run


def write_archives(typed: DataFrame, path: str, segment: int = SEGMENT, per_file: int = PER_FILE) -> None:
    """Stores the pages of ``record_types`` as archives under ``path``."""
    read = typed.select("page_id", "serial", "url", F.col("payload").cast("binary").alias("payload"), "digest", "first",
                        "first_serial")
    (read.mapInArrow(_records(segment), "value string").write.option("lineSep", END)
     .option("maxRecordsPerFile", per_file).option("compression", "gzip").mode("errorifexists").text(path))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record; lengths lead, not separators."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at)
        lines = data[at:head].split(b"\r\n")
        if lines[0] != VERSION:
            raise ValueError("no record at byte %d" % at)
        fields = {k.strip().lower(): v.strip(" \t") for k, _, v in (x.decode().partition(":") for x in lines[1:])}
        start = head + 4
        end = start + int(fields["content-length"])
        if data[end:end + 4] != END.encode():
            raise ValueError("record without end")
        yield fields, data[start:end]
        at = end + 4


_SEGMENTS = pa.schema([("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("kind", pa.string()),
                       ("url", pa.string()), ("digest", pa.string()), ("refers", pa.string()), ("block", pa.binary())])
_SEGMENTS_DDL = ("origin string, segment int, total bigint, kind string, url string, digest string, refers string, "
                 "block binary")


def _parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows = []
            data = content.as_py()
            for f, block in parse(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                number, total = f.get("warc-segment-number"), f.get("warc-segment-total-length")
                rows.append((f.get("warc-segment-origin-id", f["warc-record-id"]), number and int(number),
                             total and int(total), f["warc-type"], _unuri(f.get("warc-target-uri")),
                             f.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                             f.get("warc-refers-to"), block))
            yield emit(_SEGMENTS, list(zip(*rows, strict=True)) if rows else [[]] * len(_SEGMENTS))


_PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                    ("segments", pa.int32()), ("valid", pa.bool_())])
_PAGES_DDL = ("page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
              "payload_digest string, refers_to bigint, segments int, valid boolean")


def _page_number(urn: str | None) -> int | None:
    found = re.match(r"<urn:page:(-?\d+)", urn or "")
    return int(found[1]) if found else None


def page_of(origin: str, parts: list[dict]) -> tuple:
    """Puts the segments of one record together and decodes it."""
    parts = sorted(parts, key=lambda p: p["segment"] or 1)
    head, block = parts[0], b"".join(p["block"] for p in parts)
    whole = [p["segment"] or 1 for p in parts] == list(range(1, len(parts) + 1))
    whole &= head["segment"] is None or parts[-1]["total"] == len(block)
    payload, size, digest = None, None, head["digest"]
    try:
        fields, _, body = block.partition(b"\r\n\r\n")
        if head["kind"] == "revisit":
            size = int(re.search(rb"(?im)^content-length:\s*(\d+)", fields)[1])
        else:
            payload = unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked", fields) else body
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            whole &= digest == head["digest"]
    except (ValueError, TypeError):
        whole = False
    return (_page_number(origin), head["url"], head["kind"], payload, size, digest, _page_number(head["refers"]),
            len(parts), bool(whole))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            rows = [page_of(o, p) for o, p in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
            yield emit(_PAGES, list(zip(*rows, strict=True)))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives under ``path``."""
    # the writer's own files only; an archive of an empty table has none
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    segments = files.mapInArrow(_parse_files, _SEGMENTS_DDL)
    fields = F.struct("segment", "total", "kind", "url", "digest", "refers", "block")
    # records in one piece need no shuffle
    single = segments.filter(F.col("segment").isNull()).select("origin", F.array(fields).alias("parts"))
    several = segments.filter(F.col("segment").isNotNull()).groupBy("origin").agg(F.collect_list(fields).alias("parts"))
    return single.unionByName(several).mapInArrow(_decode, _PAGES_DDL)


def round_trip(pages: DataFrame, path: str | None = None, segment: int = SEGMENT, per_file: int = PER_FILE,
               **columns) -> DataFrame:
    """Writes ``pages`` as archives and returns what reading them gives."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(record_types(pages, **columns), path, segment, per_file)
    return read_archives(spark, path)
