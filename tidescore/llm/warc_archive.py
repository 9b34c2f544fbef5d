"""A content-addressed WARC archive: payload bytes once per strong digest, exact record headers apart.

An archive is a folder with two Parquet tables. `payloads` holds each distinct payload once under its
SHA-256; `headers` holds one exact WARC/1.1 header block per record and the digest of its payload.
Original records come back by joining the two; every payload is hashed again when it is read.

Of records with equal payloads of at least `min_bytes` bytes, the one with the largest id is the
response and the others are revisits that refer to it; smaller payloads are always responses (their
bytes are still stored once).

Defined cases: a null payload is empty; a null id sorts below every other; rows that repeat id and
payload are the same record, so all of them are responses if one is. An empty table gives an empty
archive. A payload whose bytes do not match their digest stops the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def base32_of_hex(hex40: Column) -> Column:
    """Base32 of a 160-bit digest given as hex: every five hex digits are four symbols."""
    symbols = []
    for group in range(8):
        bits = F.conv(F.substring(hex40, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            symbols.append(F.substr(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*symbols)


def payload_of(column: Column) -> Column:
    return F.coalesce(column.cast("binary"), F.lit("").cast("binary"))


def record_urn(record_id: Column, strong: Column) -> Column:
    """A name-based UUID from the id and the payload digest: equal on every run."""
    h = F.md5(F.concat_ws("|", F.coalesce(record_id.cast("string"), F.lit("null")), strong))
    return F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3),
        F.lit("-8"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12), F.lit(">"),
    )


def field(name: str, value: Column) -> Column:
    """One header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL)), F.lit(""))


def one_line(text: Column) -> Column:
    """A value that cannot end its header line early."""
    return F.regexp_replace(text, r"[\r\n\x0B\f\x85\u2028\u2029]+", " ")


def write_archive(
    records: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
    min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
) -> None:
    spark = records.sparkSession
    source = records.select(
        F.col(id_col).alias("record_id"), F.col(uri_col).alias("uri"), payload_of(F.col(payload_col)).alias("payload")
    ).withColumn("strong", F.sha2("payload", 256))
    (
        source.groupBy("strong")
        .agg(F.max("record_id").alias("holder"), F.first("payload").alias("payload"))
        .withColumn("payload_bytes", F.length("payload").cast("long"))
        .withColumn("payload_digest", base32_of_hex(F.sha1("payload")))
        .write.parquet(f"{path}/payloads")
    )
    stored = spark.read.parquet(f"{path}/payloads").select(
        F.col("strong").alias("stored"), "holder", "payload_bytes", "payload_digest"
    )
    # Inner is enough: every record's payload is in the store. Both sides are plain scans, so a hot
    # payload is split by adaptive skew handling.
    joined = source.drop("payload").join(stored, F.col("strong") == F.col("stored"))
    revisit = (F.col("payload_bytes") >= min_bytes) & ~F.col("record_id").eqNullSafe(F.col("holder"))
    block = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", record_urn(F.col("record_id"), F.col("strong"))),
        field("WARC-Date", F.lit(date)),
        field("X-Record-Key", F.col("record_id")),
        field("X-Refers-To-Key", F.when(revisit, F.col("holder"))),
        field("WARC-Target-URI", one_line(F.col("uri"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        field("WARC-Refers-To", F.when(revisit, record_urn(F.col("holder"), F.col("strong")))),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))),
        F.lit(EOL),
    )
    joined.select("strong", block.alias("header")).write.parquet(f"{path}/headers")


def checked_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The payload store, hashed again: bytes that do not match their digest raise."""
    store = spark.read.parquet(f"{path}/payloads").select(F.col("strong").alias("stored"), "payload")
    right = F.sha2("payload", 256) == F.col("stored")
    return store.withColumn(
        "payload", F.when(right, F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("stored"))).cast("binary"))
    )


def header_value(name: str) -> Column:
    # Only the line feed of the header's own line ends separates lines (d).
    found = F.regexp_extract("header", rf"(?md)^{name}: ([^\r\n]*)\r$", 1)
    return F.when(found != "", found)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: parsed header fields beside length and digest taken from the stored bytes."""
    sums = checked_payloads(spark, path).select(
        "stored", F.length("payload").cast("long").alias("payload_bytes"),
        base32_of_hex(F.sha1("payload")).alias("payload_digest"),
    )
    headers = spark.read.parquet(f"{path}/headers")
    return headers.join(sums, F.col("strong") == F.col("stored")).select(
        header_value("X-Record-Key").alias("record_key"),
        header_value("WARC-Target-URI").alias("uri"),
        header_value("WARC-Type").alias("record_type"),
        header_value("X-Refers-To-Key").alias("refers_to"),
        header_value("WARC-Payload-Digest").alias("header_digest"),
        "header", "strong", "payload_bytes", "payload_digest",
    )


def restore(spark: SparkSession, path: str) -> DataFrame:
    """Original records: header, the payload (also that of a revisit) and the record's bytes as in a WARC file."""
    headers = spark.read.parquet(f"{path}/headers")
    joined = headers.join(checked_payloads(spark, path), F.col("strong") == F.col("stored"))
    body = F.when(header_value("WARC-Type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return joined.select(
        header_value("X-Record-Key").alias("record_key"), "header", "payload",
        F.concat(F.col("header").cast("binary"), body, F.lit(EOL * 2).cast("binary")).alias("record"),
    )


def export_warc(spark: SparkSession, path: str, out: str) -> None:
    """The archive as gzip WARC files, one per task: records in UTF-8, each closed by two line ends."""
    lines = restore(spark, path).select(
        F.expr("substring(record, 1, length(record) - 4)").cast("string").alias("value"))
    lines.write.option("lineSep", EOL * 2).option("compression", "gzip").text(out)
