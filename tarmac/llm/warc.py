"""op5: WARC archives with revisit records for payloads already stored.

Pages are reduced to headers (page id, url, payload digest and size); the headers, and
nothing else, are shuffled by digest to find the original of each payload: the record
with the largest page id. Other records of the payload become ``revisit`` records with
fresh headers and no payload, built from headers alone; only originals meet their payload
again, by page id. Archives are gzip files of WARC/1.1 records in the shared folder,
written and read back by Spark's own file writers and readers: a record ends with two line
breaks, which is the separator given to the text writer, and the reader's pieces are put
together again by Content-Length, one record in memory at a time.

Defined results for odd input: a null payload is empty; a payload smaller than
``min_bytes`` is always a response; of several rows with one page id and payload, one is
the response and the others revisit it; a null page id sorts below every other and stays
null; ids may be of any type, text sorting by code point; payloads may hold line breaks, separators or whole WARC records; control characters
in a url are percent-encoded in the record; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_batches, once, staged, table
from tarmac.session import scratch_path

LINE, END = "\r\n", "\r\n\r\n"
MIN_BYTES = 0                  # payloads from this size on are stored once
RECORDS_PER_FILE = 200_000
DATE = "1970-01-01T00:00:00Z"  # the pages carry no capture time


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _base32(sha1: Column) -> Column:
    """Base32 of a SHA-1 in hex: five hex digits are four of base 32."""
    fours = [F.lpad(F.conv(F.substring(sha1, k, 5), 16, 32), 4, "0") for k in range(1, 41, 5)]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest and byte length of the payload's UTF-8 form)."""
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    hashed = once(named, sha1=F.sha1(F.col("payload").cast("binary")))
    return hashed.select("page_id", "url", "payload", _base32(F.col("sha1")).alias("payload_digest"),
                         F.octet_length("payload").cast("long").alias("payload_bytes"))


def resolve(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Decisions per page id and payload: the rows (``copies``) that have both, the id of
    the ``original`` of the payload, whether this page ``is_original``, and whether the
    payload is too small to be shared (``alone``)."""
    each = headers.groupBy("page_id", "payload_digest").agg(
        F.max("payload_bytes").alias("payload_bytes"), F.min("url").alias("url"),
        F.count(F.lit(1)).alias("copies"))
    # A digest may hold any share of the pages: its maximum is combined before the shuffle,
    # and the join back is one whose hot keys the adaptive planner splits.
    first = headers.groupBy("payload_digest").agg(F.max("page_id").alias("original"))
    return (each.join(first, "payload_digest")
            .withColumn("alone", F.col("payload_bytes") < min_bytes)
            .withColumn("is_original", F.col("alone") | F.col("page_id").eqNullSafe(F.col("original"))))


def _text(page: Column) -> Column:
    """An id for a field: what is no plain word in it is percent-encoded; ``*`` is a null."""
    text = F.replace(F.url_encode(page.cast("string")), F.lit("*"), F.lit("%2A"))
    return F.coalesce(text, F.lit("*"))


def _record_id(page: Column, digest: Column, nth: Column) -> Column:
    name = F.md5(F.concat_ws(":", _text(page), digest, nth.cast("string")))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _head(kind: str, nth: Column, length: Column, *more: Column) -> Column:
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), F.lit("about:blank"))
    return F.concat(F.concat_ws(
        LINE, F.lit("WARC/1.1"), _field("WARC-Type", F.lit(kind)),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"), nth)),
        _field("WARC-Date", F.lit(DATE)), _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("Page-ID", _text(F.col("page_id"))), *more,
        _field("Content-Length", length.cast("string"))), F.lit(END))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = MIN_BYTES) -> None:
    """Writes one record per page row under ``path`` (gzip files of WARC records)."""
    full = payloads(pages, id_col, url_col, payload_col)
    headers = staged(full.drop("payload"), "warc-headers")
    decided = staged(resolve(headers, min_bytes), "warc-decisions")

    # Originals meet their payload by page id; the small side is hashed, payloads are not
    # sorted. Equal rows of one page give one response.
    keys = ["page_id", "payload_digest"]
    wanted = decided.filter("is_original").select(
        *[F.col(k).alias(f"_{k}") for k in keys], "copies", "alone").hint("shuffle_hash")
    met = full.join(wanted, full.page_id.eqNullSafe(F.col("_page_id"))
                    & (full.payload_digest == F.col("_payload_digest")))
    repeated = (F.col("copies") > 1) & ~F.col("alone")
    if not decided.filter("is_original and not alone and copies > 1").isEmpty():
        met = met.filter(~repeated).unionByName(met.filter(repeated).dropDuplicates(keys))
    http = F.concat(F.lit(LINE.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8",
                                     "Content-Length: "])), F.col("payload_bytes").cast("string"), F.lit(END))
    nth = F.when(F.col("alone"), F.monotonically_increasing_id() + 1).otherwise(0)
    responses = met.select(F.concat(
        _head("response", nth, F.octet_length(http) + F.col("payload_bytes"),
              F.lit("Content-Type: application/http;msgtype=response")), http, "payload").alias("value"))

    # All other copies refer to the original and need no payload.
    others = (decided.filter("not alone")
              .withColumn("n", F.col("copies") - F.col("is_original").cast("int")).filter("n > 0")
              .withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))))
    revisits = others.select(_head(
        "revisit", F.col("nth"), F.lit(0),
        _field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _field("WARC-Refers-To", _record_id(F.col("original"), F.col("payload_digest"), F.lit(0)))).alias("value"))
    (responses.unionByName(revisits).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of a stream given as the bytes between ``END``
    marks. Blocks are cut by Content-Length, whatever they contain."""
    end = END.encode()
    fields: dict[str, str] | None = None
    need, size, body = 0, 0, []
    for piece in pieces:
        if fields is not None:
            size += len(piece) + (len(end) if body else 0)
            body.append(piece)
            if size < need:
                continue
            block = end.join(body)
            yield fields, block[:need]
            # A block that ends in line breaks shifts the marks: the rest is the next head.
            fields, piece = None, block[need:]
        head = piece.lstrip(b"\r\n")
        if head:
            fields = dict(line.split(": ", 1) for line in head.decode().split(LINE)[1:])
            need, size, body = int(fields["Content-Length"]), 0, []
            if not need:
                yield fields, b""
                fields = None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def packed() -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
        out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                         names=[f.split()[0] for f in READ.split(", ")])
        rows.clear()
        return out

    pieces = (p.as_py() for batch in batches for p in batch.column(0))
    for fields, block in records(pieces):
        page = None if fields["Page-ID"] == "*" else unquote_plus(fields["Page-ID"])
        if fields["WARC-Type"] == "response":
            payload = block.partition(END.encode())[2]
            found = (payload_digest(payload), len(payload), None)
        else:
            found = (fields["WARC-Payload-Digest"].removeprefix("sha1:"), None, fields["WARC-Refers-To"])
        rows.append((page, fields["WARC-Record-ID"], fields["WARC-Type"], *found))
        if len(rows) >= 10_000:
            yield packed()
    yield packed()


READ = ("page_id string, record_id string, record_type string, payload_digest string, "
        "payload_bytes long, refers_to_record string")


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Records of the archives under ``path``, page ids being of type ``id_type``; digest and size are those of the stored
    payload, for revisits those of the response they refer to."""
    pieces = bounded_batches(spark.read.option("lineSep", END).text(path))
    found = staged(pieces.select(F.col("value").cast("binary").alias("value")).mapInArrow(_read, READ)
                   .withColumn("page_id", F.col("page_id").cast(id_type)), "warc-read")
    responses = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("_record"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    # A response may be revisited from any share of the records: a skewed join AQE splits.
    return found.join(responses, F.col("refers_to_record") == F.col("_record"), "left").select(
        "page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("_digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


ORACLE = r"""
with hashed as (
  select page_id, coalesce(html, '') payload, sha1(coalesce(html, '')) hex from pages),
digits as (
  select page_id, strlen(payload)::bigint payload_bytes, array_to_string(list_transform(range(0, 32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (5 * (k // 4) + 1)::int, 5))::bigint
                >> (5 * (3 - k % 4))::bigint) & 31)::int + 1, 1)), '') payload_digest
  from hashed),
ranked as (
  select *, max(page_id) over (partition by payload_digest) original,
         row_number() over (partition by payload_digest order by page_id desc nulls last) place
  from digits)
select page_id, payload_bytes, payload_digest, case when place = 1 then 'response' else 'revisit' end record_type,
       case when place > 1 then original end refers_to
from ranked
"""
