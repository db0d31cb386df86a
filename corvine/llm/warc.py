"""WARC archives: pages to request, response (or revisit) and metadata records, and back by transaction assembly.

Writing is DataFrame expressions only: each capture becomes three records whose header names the response as
WARC-Concurrent-To, and Spark's text writer lays them out as WARC 1.1 (gzip per file). Of captures with equal
payloads of at least `LEAST_BYTES` bytes, that with the largest page_id is the response, the others are revisits
that refer to it (captures that share the largest page_id are all responses).

Reading splits archives by content length, joins the records of a transaction through their concurrent-to
identifiers, and emits one nested row per capture. Payloads are told apart by length and SHA-256.

A null html is an empty payload; a null url an empty one. A capture with a null page_id is stored without one:
it is a response unless a capture with an id has the same payload. Repeated rows are captures of their own. An
empty table makes archives without records; other columns of the pages do not matter. Archives of others: a response's
payload is its block behind the HTTP head, however long that is, as stored (chunked or compressed bodies too); a block
without the end of a head is payload as a whole.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import Spool, table

LEAST_BYTES = 1000
#: Captures in an archive file at most, and bytes of payload in one on average; a reader holds a file at once.
PER_FILE, FILE_BYTES = 2000, 64 << 20
#: Payloads that are laid out apart, so that no file holds more than `PER_FILE` of this size or a few larger ones.
LARGE = 512 << 10
CRLF = "\r\n"


def _header(kind: str, record: Column, *more: tuple[str, Column | None]) -> Column:
    """Header lines of a record; a field whose value is null is left out."""
    lines = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}"), F.lit("WARC-Record-ID: <"), record, F.lit(f">{CRLF}WARC-Date: 2020-01-01T00:00:00Z{CRLF}")]
    for name, value in more:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*lines)


def _record(header: Column, block: Column) -> Column:
    """A record without its last line end, which the writer adds."""
    size = F.octet_length(block).cast("string")
    return F.concat(header, F.lit("Content-Length: "), size, F.lit(CRLF + CRLF), block, F.lit(CRLF))


def captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Each page's payload with its digests, and the page it revisits, if any."""
    payload = F.coalesce(F.col(html), F.lit(""))
    base = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"[\r\n]", " ").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload.cast("binary")).alias("sha1"),
        F.unhex(F.sha2(payload.cast("binary"), 256)).alias("sha256"),
    )
    large = base.where(F.col("bytes") >= LEAST_BYTES)
    # copies fold into one small row per payload before they meet; single payloads need no join at all
    newest = large.groupBy("sha256", "bytes").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = base.join(newest, ["sha256", "bytes"], "left")
    other = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return out.withColumn("refers_to", F.when(other, F.col("newest"))).drop("newest", "sha256")


def records(caps: DataFrame) -> DataFrame:
    """The text of all records, three rows per capture."""
    own = F.concat(F.lit("urn:capture:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(":"), F.col("_uuid"))
    caps = caps.withColumn("_uuid", F.uuid()).withColumn("_id", own)
    main = F.concat("_id", F.lit(":response"))
    host = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    asked = F.concat(F.lit("GET "), F.when(path == "", F.lit("/")).otherwise(path), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    about = F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF))
    uri, concurrent = ("WARC-Target-URI", F.when(F.col("url") != "", F.col("url"))), ("WARC-Concurrent-To", F.concat(F.lit("<"), main, F.lit(">")))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")))
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    back = ("WARC-Refers-To", F.concat(F.lit("<urn:capture:"), F.col("refers_to").cast("string"), F.lit(">")))
    profile = ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    rows = F.array(
        _record(_header("request", F.concat("_id", F.lit(":request")), uri, concurrent, ("Content-Type", F.lit("application/http; msgtype=request"))), asked),
        F.when(F.col("refers_to").isNull(), _record(_header("response", main, uri, digest, http), F.concat(head, F.col("payload")))).otherwise(_record(_header("revisit", main, uri, digest, back, profile, http), head)),
        _record(_header("metadata", F.concat("_id", F.lit(":metadata")), uri, concurrent, ("Content-Type", F.lit("application/warc-fields"))), about),
    )
    return caps.select(F.explode(rows).alias("value"))


def write_archives(pages: DataFrame, path: str, per_file: int | None = None, html: str = "html", **names: str) -> None:
    """Writes gzipped WARC files below `path`, of `per_file` captures each, else of about `FILE_BYTES` of payload:
    small payloads by their mean, those of `LARGE` bytes and more apart by their largest, so that no file outgrows
    what a reader takes at once."""
    size = F.coalesce(F.octet_length(html), F.lit(0))
    large = F.coalesce(F.octet_length("payload"), F.lit(0)) >= LARGE
    stats = pages.agg(F.avg(F.when(size < LARGE, size)), F.max(size)).first()
    caps = captures(pages, html=html, **names)
    sets = [(caps, per_file)]
    if per_file is None:
        sets = [(caps.where(~large), max(1, min(PER_FILE, int(FILE_BYTES / max(1.0, stats[0] or 0.0)))))]
        if (stats[1] or 0) >= LARGE:
            sets.append((caps.where(large), max(1, FILE_BYTES // stats[1])))
    for some, n in sets:
        records(some).write.mode("append").option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", 3 * n).text(path)


FIELDS = ("type", "id", "concurrent", "uri", "digest", "refers", "length", "head", "block")
#: `head`: bytes of the block up to the end of its HTTP head, 0 where the block is not HTTP or has no such end.
RECORD = "type string, id string, concurrent string, uri string, digest string, refers string, length long, head long, block binary"
_NAMES = {b"warc-type": 0, b"warc-record-id": 1, b"warc-concurrent-to": 2, b"warc-target-uri": 3, b"warc-payload-digest": 4, b"warc-refers-to": 5}


def head_end(block: bytes) -> int:
    """Where an HTTP head of any length ends, its blank line included; 0 if it does not."""
    crlf = block.find(b"\r\n\r\n")
    lf = block.find(b"\n\n", 0, crlf if crlf >= 0 else len(block))
    return lf + 2 if lf >= 0 else crlf + 4 if crlf >= 0 else 0


def parse_archive(stream: io.BufferedIOBase) -> Iterator[tuple]:
    """Records of one archive, in its order; blocks are taken by their length, whatever they contain."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        row: list = [None] * 6
        size, http = 0, False
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.partition(b":")
            name, value = name.strip().lower(), value.strip()
            if name == b"content-length":
                size = int(value)
            elif name == b"content-type":
                http = value.lower().startswith(b"application/http")
            elif name in _NAMES:
                row[_NAMES[name]] = value.decode("utf-8", "replace")
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends inside a record")
        yield (*row, size, head_end(block) if http else 0, block)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (*[pa.string()] * 6, pa.int64(), pa.int64(), pa.binary())
    for batch in batches:
        for content in batch.column(0):
            raw = pa.py_buffer(content.as_buffer())
            stream = pa.input_stream(raw)
            stream = io.BufferedReader(gzip.GzipFile(fileobj=stream) if bytes(raw[:2]) == b"\x1f\x8b" else stream, 1 << 16)
            rows, size = [], 0
            for r in parse_archive(stream):
                rows.append(r)
                size += r[6]
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], list(FIELDS))
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], list(FIELDS))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below `path`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_parse, RECORD)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: its id and structs request, response and metadata, null where missing.

    A transaction's key is the id that its records are concurrent to; that of a response or revisit is its own.
    Of several records of one kind in a transaction the one with the smallest record id is taken.
    """
    key = F.coalesce("concurrent", "id")
    parts = {"request": F.col("type") == "request", "response": F.col("type").isin("response", "revisit"), "metadata": F.col("type") == "metadata"}
    record = F.struct("type", "id", "uri", "digest", "refers", "length", "head", "block")
    return recs.groupBy(key.alias("capture")).agg(*[F.min_by(record, F.when(cond, F.col("id"))).alias(k) for k, cond in parts.items()])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    at = Spool(spark, "warc").path("archives")
    write_archives(pages, at)
    # digest payloads before records meet, so that no payload is shuffled
    recs = read_records(spark, at)
    head = F.decode(F.expr("substring(block, 1, cast(head as int))"), "ISO-8859-1")
    body = F.expr("substring(block, cast(head as int) + 1)")
    recs = recs.withColumn("length", F.when(F.col("type") == "response", F.col("length") - F.col("head")).when(F.col("type") == "revisit", F.regexp_extract(head, r"Content-Length: (\d+)", 1).cast("long")).otherwise(F.col("length")))
    told = F.regexp_replace("digest", "^sha1:", "")
    checked = F.when(F.sha1(body) == told, told).otherwise(F.raise_error(F.concat(F.lit("payload and digest differ in "), F.col("id"))))
    recs = recs.withColumn("digest", F.when(F.col("type") == "response", checked).otherwise(told))
    small = F.when(F.col("type") == "metadata", F.col("block")).alias("block")
    rows = assemble(recs.select("type", "id", "concurrent", "uri", "digest", "refers", "length", "head", small))
    page = F.regexp_extract(F.decode("metadata.block", "UTF-8"), r"page_id: (\d+|-\d+)", 1)
    return rows.select(
        F.when(page != "", page).cast("long").alias("page_id"),
        F.col("response.length").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.regexp_extract("response.refers", r"(-?\d+)>$", 1).cast("long").alias("refers_to"),
    )


ORACLE = {
    "op5_warc": """
with p as (select page_id, coalesce(html, '') as body, octet_length(encode(coalesce(html, ''))) as n from pages),
m as (select body, max(page_id) as newest from p where n >= 1000 group by body)
select p.page_id, cast(p.n as bigint) as payload_bytes, sha1(p.body) as payload_digest,
       case when m.newest is not null and m.newest <> p.page_id then 'revisit' else 'response' end as record_type,
       case when m.newest is not null and m.newest <> p.page_id then m.newest end as refers_to
from p left join m on p.body = m.body and p.n >= 1000
"""
}
QUERIES = {"op5_warc": op5_warc}
