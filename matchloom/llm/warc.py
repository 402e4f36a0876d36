"""WARC records in a content-addressed archive.

An archive is two Parquet tables in a folder. `payloads` holds each distinct payload once, under its
SHA-256, with its SHA-1 and length; `headers` holds the exact header bytes of every record and the
digest of its payload. Joining them gives the original records back, byte for byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEADERS = "record_no long, page_id long, copy long, digest string, header binary"
PAYLOADS = "digest string, sha1 string, size long, payload binary"
EPOCH = "2000-01-01T00:00:00Z"
#: Control characters in a url would end or forge header lines, so such urls are written form-encoded, which a header says.
CONTROL, ENCODED = r"[\x00-\x1F\x7F]", "X-Encoded-"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of bytes in upper-case base32: each 5 hexadecimal digits are 4 base-32 digits."""
    hexed = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.encode(F.col(payload_col), "UTF-8") if dict(pages.dtypes)[payload_col] == "string" else F.col(payload_col), F.lit(b""))
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0) -> None:
    """Writes one record for each row and each distinct payload once.

    Of the records with equal payloads of at least min_revisit_bytes, that with the largest page id is
    the response and the others are revisits of it; among equal ids the largest url wins, and of rows
    equal throughout the first copy. Smaller payloads give responses only. A null id counts as the
    smallest, a null payload as empty, a null url as no target. Other columns are left out.

    Only digests and keys are joined: payloads are shuffled once, after each task has kept one of its
    copies. A url with control characters is written form-encoded, so it can't forge headers, and parse_records decodes it.
    Content-Length is the payload's, also for revisits, as reading joins their payload back. Copies of a payload must agree in SHA-1 and length too, or the write fails.
    """
    rows = _records(pages, id_col, url_col, payload_col)
    kept = rows.withColumn("sha1", base32_sha1(F.col("payload"))).withColumn("size", F.octet_length("payload").cast("long"))
    same = (F.min("sha1") == F.max("sha1")) & (F.min("size") == F.max("size"))
    stored = kept.groupBy("digest").agg(F.when(same, F.min("sha1")).otherwise(F.raise_error(F.lit("payloads of one SHA-256 differ"))).alias("sha1"), F.min("size").alias("size"), F.first("payload").alias("payload"))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")

    keys = kept.groupBy("page_id", "url", "digest", "sha1", "size").agg(F.count(F.lit(1)).alias("copies"))
    first = keys.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("first")).select(F.col("digest").alias("first_digest"), "first")
    record = keys.join(first, keys.digest == first.first_digest).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    response = (F.col("size") < min_revisit_bytes) | ((F.col("copy") == 1) & F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url")))
    name = lambda page, url, copy: F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws("\n", F.coalesce(page.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), F.col("digest"), copy.cast("string")), 256), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    target = lambda key, url: F.coalesce(F.when(url.rlike(CONTROL), F.concat(line(key, F.url_encode(url)), line(f"{ENCODED}{key}", F.lit("form")))).otherwise(line(key, url)), F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(response, "response").otherwise("revisit")), line("WARC-Record-ID", name(F.col("page_id"), F.col("url"), F.col("copy"))), line("WARC-Date", F.lit(EPOCH)),
        target("WARC-Target-URI", F.col("url")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(response, "").otherwise(F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"), line("WARC-Refers-To", name(F.col("first.page_id"), F.col("first.url"), F.lit(1))),
            target("WARC-Refers-To-Target-URI", F.col("first.url")), F.coalesce(line("X-Refers-To-Page", F.col("first.page_id").cast("string")), F.lit("")))),
        F.coalesce(line("X-Page", F.col("page_id").cast("string")), F.lit("")), F.lit("Content-Type: text/html; charset=UTF-8\r\n"), line("Content-Length", F.col("size").cast("string")), F.lit("\r\n"),
    )
    record.select(F.xxhash64("page_id", "url", "copy").alias("record_no"), "page_id", "copy", "digest", F.encode(header, "UTF-8").alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records, by joining headers to payloads: header, payload (each stored payload checked against its digest)."""
    payloads = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    checked = payloads.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload doesn't match its digest"))))
    return spark.read.schema(HEADERS).parquet(f"{path}/headers").join(checked.select("digest", "payload"), "digest").select("header", "payload")


def record_bytes(records: DataFrame) -> DataFrame:
    """Each record as it stands in a WARC file."""
    return records.select(F.concat("header", "payload", F.lit(b"\r\n\r\n")).alias("record"))


def parse_records(records: DataFrame) -> DataFrame:
    """What headers and payloads say: page_id, payload_bytes, payload_digest (computed from the payload), record_type, refers_to, url."""
    field = lambda key: F.nullif(F.regexp_extract("head", rf"\n{key}: ([^\r\n]*)", 1), F.lit(""))
    url = lambda key: F.when(field(ENCODED + key).isNotNull(), F.url_decode(field(key))).otherwise(field(key))
    read = records.withColumn("head", F.decode("header", "UTF-8"))
    return read.select(
        field("X-Page").cast("long").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), field("WARC-Type").alias("record_type"),
        field("X-Refers-To-Page").cast("long").alias("refers_to"), url("WARC-Target-URI").alias("url"),
    )
