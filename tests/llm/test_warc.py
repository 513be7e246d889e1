import base64
import hashlib

import pytest
from pyspark.sql.utils import AnalysisException  # noqa: F401

from ruleweave.llm import warc
from ruleweave.llm.stage import scratch


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, b"z", "d") for i, u, h in rows],
                                 "page_id bigint, url string, html string, payload binary, digest string")


ROWS = [(5, "http://a/\r\nX: y", "<p>é</p>"), (3, "http://b/", "<p>é</p>"), (9, None, None), (8, "u", ""), (7, "u", "x"),
        (3, "http://b/", "<p>é</p>"), (None, "n", "x"), (None, "n", "only"), (11, "v", "y" * 300_000), (12, "w", "y" * 300_000)]


def brute(rows, min_bytes):
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        low = min(same, default=None)
        revisit = len(b) >= min_bytes and i != low
        out.append((str(i), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if revisit else "response", low if revisit else None, True))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_archive_round_trip(spark, min_bytes):
    path = scratch(spark, "test")
    warc.write_archive(pages(spark, ROWS), path, min_bytes=min_bytes)
    got = warc.read_archive(spark, path).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.verified)
                   for r in got), key=str) == brute(ROWS, min_bytes)
    assert {r.url for r in got} >= {"http://a/%0D%0AX: y", None, "http://b/"}
    # each payload is kept once
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in ROWS})


def test_records_are_well_formed(spark):
    path = scratch(spark, "test")
    warc.write_archive(pages(spark, ROWS), path)
    for r in warc.read_records(spark, path).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = warc.parse_header(bytes(r.header))
        assert len(block) == int(fields["content-length"]) + 4 and block.endswith(b"\r\n\r\n")
        if fields["warc-type"] == "response":
            assert block[:-4].split(b"\r\n\r\n", 1)[1] == bytes(r.payload)


def test_damaged_payload_is_noticed(spark):
    from pyspark.sql import functions as F
    path, other = scratch(spark, "test"), scratch(spark, "test")
    warc.write_archive(pages(spark, ROWS[:2]), path)
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.expr("encode('<p>!</p>!', 'UTF-8')")).write.parquet(f"{other}/payloads")
    assert not any(r.verified for r in warc.read_archive(spark, other).collect())


def test_empty_table(spark):
    path = scratch(spark, "test")
    warc.write_archive(pages(spark, []), path)
    assert warc.read_archive(spark, path).collect() == []
