"""WARC as a content-addressed archive: payload bytes once, exact record headers apart, records rebuilt by joins.

An archive is a folder of two Parquet tables:

- payloads: address (SHA-256, the strong digest), payload_digest (base32 SHA-1, as WARC headers have it),
  payload_bytes, first_id (smallest id among the records that have it), payload. Each payload is there once.
- headers: record_id, header (the exact bytes up to and with the empty line, then the HTTP head), address,
  stored (whether the record's block ends with the payload; a revisit's doesn't).

A record is header + payload (if stored) + CRLF CRLF. Reading verifies the address and the digest of every
payload and fails on any that differs.

Only DataFrame functions are used; payloads cross one shuffle, in which equal ones are first merged on the map side.
The join of headers with digests carries small rows only, and Spark splits it where one payload has many records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

CRLF = "\r\n"
_BASE32HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _BASE32HEX, _BASE32)


def _http_head(length: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length.cast("string"), F.lit(CRLF + CRLF))


def _urn(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, *, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write a record for each row into a new archive.

    Of records with equal payloads of at least min_bytes, that with the smallest id is a response and the others
    revisit it; smaller ones are all responses. A null payload counts as empty and a null url as about:blank;
    line ends within a url are dropped. Rows that repeat the smallest id are responses as well. A null id gets
    the record id <urn:page:none>; it revisits the smallest id there is, else it is a response. Other columns are
    ignored, whatever their names. A payload is held whole by the task that works on it.
    """
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.regexp_replace(F.col(url_col).cast("string"), "[\r\n]+", ""), F.lit("about:blank")).alias("url"), payload.alias("payload")).withColumn("address", F.sha2("payload", 256))

    once = rows.groupBy("address").agg(F.min("id").alias("first_id"), F.first("payload").alias("payload"))
    once = once.select("address", sha1_base32(F.col("payload")).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"), "first_id", "payload")
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")

    index = pages.sparkSession.read.schema(once.schema).parquet(f"{path}/payloads").select("address", "payload_digest", "payload_bytes", "first_id")
    r = rows.select("id", "url", "address").join(index, "address")
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))
    head = _http_head(F.col("payload_bytes"))
    block_bytes = F.octet_length(head) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("payload_bytes"))
    field = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", _urn(F.col("id"))),
        field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(field("WARC-Refers-To", _urn(F.col("first_id"))), field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), field("WARC-Truncated", F.lit("length")))).otherwise(F.lit("")),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", block_bytes.cast("string")),
        F.lit(CRLF),
        head,
    )
    r.select(_urn(F.col("id")).alias("record_id"), header.cast("binary").alias("header"), "address", (~revisit).alias("stored")).write.option("compression", "zstd").parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The original records: record_id, record (binary). Fails on a payload that its address doesn't fit."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload damaged: "), F.col("address"))).cast("binary"))
    end = F.lit((CRLF + CRLF).encode()).cast("binary")
    full = headers.filter("stored").join(payloads.select("address", sound.alias("payload")), "address", "left")
    full = full.select("record_id", F.concat("header", F.coalesce("payload", F.raise_error(F.concat(F.lit("payload missing: "), F.col("address"))).cast("binary")), end).alias("record"))
    return full.unionByName(headers.filter(~F.col("stored")).select("record_id", F.concat("header", end).alias("record")))


def parse_records(records: DataFrame) -> DataFrame:
    """Fields of records as read: page_id, payload_bytes, payload_digest, record_type, refers_to, url, record_bytes.

    payload_bytes and payload_digest are those of the full payload; for a response both are taken anew from the
    payload within the record, and a digest that differs from the header's fails.
    """
    text = F.col("record").cast("string")  # bytes stay as they are
    r = records.select("record", F.substring_index(text, CRLF + CRLF, 1).alias("warc"), F.substring_index(F.substring_index(text, CRLF + CRLF, 2), CRLF + CRLF, -1).alias("http"))
    # Only CRLF ends a line: other line ends (U+0085, U+2028, U+2029) may stand in a url.
    got = lambda name, of="warc": F.regexp_extract(F.col(of), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    number = lambda s: F.regexp_extract(s, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    start = F.octet_length("warc") + F.octet_length("http") + 8
    r = r.select(
        number(got("WARC-Record-ID")).alias("page_id"), got("WARC-Type").alias("record_type"), number(got("WARC-Refers-To")).alias("refers_to"), got("WARC-Target-URI").alias("url"),
        F.regexp_replace(got("WARC-Payload-Digest"), "^sha1:", "").alias("said"), got("Content-Length", "http").cast("long").alias("said_bytes"), F.octet_length("record").cast("long").alias("record_bytes"),
        F.col("record").substr(start + 1, F.octet_length("record") - start - 4).alias("payload"),
    )
    response = F.col("record_type") == "response"
    digest = F.when(~response, F.col("said")).otherwise(sha1_base32(F.col("payload")))
    return r.select(
        "page_id", F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("said_bytes")).alias("payload_bytes"),
        F.when(digest == F.col("said"), F.col("said")).otherwise(F.raise_error(F.concat(F.lit("digest differs: "), F.col("said"))).cast("string")).alias("payload_digest"),
        "record_type", "refers_to", "url", "record_bytes",
    )


def export_warc(spark: SparkSession, path: str, to: str) -> None:
    """The archive's records as WARC files, by Spark's own writer: each record ends with CRLF CRLF, the line separator here."""
    records = read_records(spark, path).select(F.col("record").substr(F.lit(1), F.octet_length("record") - 4).cast("string").alias("value"))
    records.write.option("lineSep", CRLF + CRLF).text(to)


def archive_round_trip(pages: DataFrame, **kw) -> DataFrame:
    """Write pages into a new archive in the shared folder, then read its records back."""
    spark, path = pages.sparkSession, shared_dir(pages.sparkSession, "warc")
    write_archive(pages, path, **kw)
    return parse_records(read_records(spark, path))
