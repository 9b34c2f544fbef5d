import base64
import hashlib

import pytest

from tidescore.llm import warc_archive as W
from tidescore.session import scratch_path

ROWS = [(1, "http://a/", "same"), (5, "http://b/", "same"), (3, "http://c/\r\nX-Evil: 1", "same"), (4, None, None),
        (6, "http://d/", ""), (7, "http://e/", "é\r\n\r\nWARC/1.1\r\n" * 50), (None, "http://f/", "alone"),
        (None, "http://g/", "same"), (5, "http://b/", "same"), (8, "http://h/", "long " * 50_000),
        *[(20 + i, f"http://a.b/{end}X-Record-Key: 999{end}WARC-Type: revisit", "hostile") for i, end in
          enumerate(["\u2028", "\u2029", "\x85", "\x0b", "\x0c", "\r", "\n"])]]


def archive(spark, rows, **options):
    path = scratch_path(spark, "warc-test")
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    W.write_archive(frame, path, **options)
    return path


def expected(rows, least=0):
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        holder = max((k for k, _, h in rows if (h or "").encode() == body and k is not None), default=None)
        again = len(body) >= least and key != holder
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((key, len(body), digest, "revisit" if again else "response", holder if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_records_read_back(spark, least):
    path = archive(spark, ROWS, min_bytes=least)
    number = lambda x: None if x is None else int(x)
    got = [(number(r.record_key), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to))
           for r in W.read_records(spark, path).collect()]
    assert sorted(got, key=str) == expected(ROWS, least)


def test_bytes_are_stored_once_and_come_back(spark):
    path = archive(spark, ROWS)
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in ROWS})
    for r in W.restore(spark, path).collect():
        header, body = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])
        assert len(body) == int(fields["Content-Length"]) + 4 and "X-Evil" not in fields
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
    assert sorted(bytes(r.payload) for r in W.restore(spark, path).collect()) == sorted((r[2] or "").encode() for r in ROWS)


def test_damaged_payload_stops_the_read(spark):
    path = archive(spark, [(1, "u", "text")])
    stored = spark.read.parquet(f"{path}/payloads").collect()[0].asDict() | {"payload": bytearray(b"other")}
    damaged = spark.createDataFrame([stored], spark.read.parquet(f"{path}/payloads").schema)
    damaged.write.mode("append").parquet(f"{path}/damaged")
    spark.read.parquet(f"{path}/damaged").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        W.read_records(spark, path).collect()


def test_empty_table(spark):
    assert W.read_records(spark, archive(spark, [])).count() == 0


def test_warc_files(spark):
    path = archive(spark, ROWS[:2])
    W.export_warc(spark, path, f"{path}/files")
    import gzip
    import re

    data = b"".join(gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(f"{path}/files").collect())
    assert len(re.findall(rb"WARC/1\.1\r\n", data)) == 2 and data.endswith(b"\r\n\r\n")
