"""Content-addressed WARC archive: payload bytes once by SHA-256, exact record headers apart, joined again to read.

`payloads` has one row per distinct payload: (digest, n_bytes, first_page, payload). `headers` has one row per
record: (digest, header), where header holds the exact bytes of the WARC header and the HTTP head. A response
record is header + payload + two line ends; a revisit record is its header + two line ends, and its full payload
is found under the same digest. Reading verifies each payload against its digest and length.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "1970-01-01T00:00:00Z"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 (RFC 4648) of 40 hex digits, 20 bits at a time."""
    groups = [F.translate(F.lpad(F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 32), 4, "0"),
                          "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for i in range(8)]
    return F.concat(*groups)


def _records(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(f"`{html_col}`"), F.lit("")), "UTF-8")
    return pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
                        F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")).select(
        "page_id", "url", "payload", F.unhex(F.sha2("payload", 256)).alias("digest"),
        F.octet_length("payload").cast("bigint").alias("n_bytes"), base32(F.sha1("payload")).alias("sha1"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = 0, date: str = DATE) -> None:
    """Write `payloads` and `headers` below path.

    Of records with equal payloads of at least min_bytes, that with the smallest page_id is the response and the
    others revisit it; smaller ones are all responses. Rows repeating that smallest page_id are that response
    again. Null html is the empty payload; a null page_id comes after all others; a null url leaves its header
    line out; line ends in a url are percent-encoded. An empty table writes empty tables.
    """
    records = _records(pages, id_col, url_col, html_col)
    (records.groupBy("digest", "n_bytes").agg(F.min("page_id").alias("first_page"), F.any_value("payload").alias("payload"))
     .write.parquet(f"{path}/payloads"))
    firsts = records.sparkSession.read.parquet(f"{path}/payloads").select("digest", "first_page")
    plain = records.drop("payload").join(firsts, "digest")
    revisit = (F.col("n_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    page = F.col("page_id").cast("string")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    length = F.length(head) + F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def record_id(p: Column) -> Column:
        # a name-based identifier: one per page
        h = F.sha1(F.concat(F.lit("page:"), F.coalesce(p, F.lit(""))))
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                        F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)),
                        F.substring(h, 21, 12)), F.lit(">"))

    first = F.col("first_page").cast("string")
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(page)), line("WARC-Target-URI", url), line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", record_id(first)), line("X-Refers-To-Page", first), F.lit(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise(""),
        line("X-Page", page), F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        length.cast("string"), F.lit("\r\n\r\n"), head)
    plain.select("digest", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{path}/headers")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(header, digest, n_bytes, payload, record): every record's exact bytes, rebuilt by a join on the digest."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "n_bytes", "payload")
    end = F.expr(r"encode('\r\n\r\n', 'UTF-8')")
    return headers.join(payloads, "digest").withColumn(
        "record", F.when(_is_revisit(), F.concat("header", end)).otherwise(F.concat("header", "payload", end)))


def _is_revisit() -> Column:
    return F.expr(r"substring(header, 1, 30) = encode('WARC/1.1\r\nWARC-Type: revisit\r\n', 'UTF-8')")


def parse_header(header: bytes) -> dict[str, str]:
    """Fields of a record's WARC header by lower-case name."""
    lines = header.split(b"\r\n\r\n", 1)[0].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _read(batches):
    for batch in batches:
        rows = []
        for header, digest, payload in zip(*(batch.column(i) for i in range(3))):
            head, payload = header.as_py(), payload.as_py()
            fields = parse_header(head)
            revisit = fields["warc-type"] == "revisit"
            block = len(head) - head.index(b"\r\n\r\n") - 4 + (0 if revisit else len(payload))
            sound = hashlib.sha256(payload).digest() == digest.as_py() and int(fields["content-length"]) == block
            page, refers = fields.get("x-page"), fields.get("x-refers-to-page")
            rows.append((page and int(page), fields.get("warc-target-uri"), len(payload),
                         fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"],
                         refers and int(refers), sound))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"]
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, from its header: page_id, url, payload_bytes and payload_digest of the full payload,
    record_type, refers_to, and whether the stored payload agrees with its digest and the record's length."""
    return read_records(spark, path).select("header", "digest", "payload").mapInArrow(
        _read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
               "refers_to bigint, verified boolean")
