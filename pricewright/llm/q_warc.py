from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .warc import archive_round_trip


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"), min_bytes=0)


QUERIES = {"op1_warc": op1_warc}

_CHAR = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {at}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
_BASE32 = " || ".join(_CHAR.format(at=1 + 5 * i, shift=s) for i in range(8) for s in (15, 10, 5, 0))

SQL = {
    "op1_warc": f"""
WITH p AS (SELECT page_id, coalesce(regexp_replace(url, '[\\r\\n]+', '', 'g'), 'about:blank') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first_id FROM p),
t AS (SELECT *, page_id IS DISTINCT FROM first_id AS again, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || payload_bytes || repeat(chr(13) || chr(10), 2) AS http FROM q),
u AS (SELECT *, strlen(http) + CASE WHEN again THEN 0 ELSE payload_bytes END AS block FROM t)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_id END AS refers_to, url,
  (strlen('WARC/1.1') + 2 + strlen('WARC-Type: ') + CASE WHEN again THEN 7 ELSE 8 END + 2
   + strlen('WARC-Record-ID: <urn:page:>') + strlen(page_id::VARCHAR) + 2 + strlen('WARC-Date: 1970-01-01T00:00:00Z') + 2
   + strlen('WARC-Target-URI: ') + strlen(url) + 2 + strlen('WARC-Payload-Digest: sha1:') + 32 + 2
   + CASE WHEN again THEN strlen('WARC-Refers-To: <urn:page:>') + strlen(first_id::VARCHAR) + 2
       + strlen('WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest') + 2 + strlen('WARC-Truncated: length') + 2 ELSE 0 END
   + strlen('Content-Type: application/http;msgtype=response') + 2 + strlen('Content-Length: ') + strlen(block::VARCHAR) + 2 + 2 + block + 4)::BIGINT AS record_bytes
FROM u""",
}
