"""Content-addressed WARC archive.

Payload bytes are stored once, keyed by SHA-256; exact record headers are stored
separately with the key of their payload; the original records come back through a
join.  Reading recomputes digest and length of every stored payload and fails on a
mismatch.

Rules: null html is an empty payload; a null url leaves the target line out; blanks and
control characters of a url are percent-encoded in the header; a null page id is larger
than any id; records that repeat a page id and payload share their type; an empty table
gives empty archives; payloads of any length are kept whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_ID = "urn:rollbook:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: After each record.
END = b"\r\n\r\n"
#: Digits of base 32 as conv() writes them, and as RFC 4648 does.
BASE32_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_RFC = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: str | Column) -> Column:
    """Bare upper-case base-32 SHA-1: 160 bits as 12 + 12 + 8 digits of 5 bits."""
    h = F.sha1(payload)
    part = lambda start, digits: F.lpad(F.conv(F.substring(h, start, digits), 16, 32), digits * 4 // 5, "0")
    return F.translate(F.concat(part(1, 15), part(16, 15), part(31, 10)), BASE32_CONV, BASE32_RFC)


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def _record_id(page: str) -> Column:
    return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col(page).cast("string"), F.lit("null")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0, id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> None:
    """Write ``path``/payloads and ``path``/records.

    The payload shuffle folds copies in the map task (one payload per digest and task),
    so a payload that a third of all pages share moves a few times only.  Headers are
    narrow; their join to the payload's first page reads two stored tables, so that AQE
    can split a hot digest.
    """
    spark = pages.sparkSession
    p = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                      F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
         .withColumn("sha256", F.unhex(F.sha2("payload", 256))))
    (p.groupBy("sha256").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_page"))
     .withColumn("bytes", F.octet_length("payload").cast("long"))
     .write.parquet(f"{path}/payloads"))
    stored = spark.read.parquet(f"{path}/payloads").select("sha256", "first_page", "bytes")
    records = p.select("page_id", "url", "sha256", sha1_base32("payload").alias("sha1")).join(stored, "sha256")
    revisit = ~F.col("page_id").eqNullSafe(F.col("first_page")) & (F.col("bytes") >= min_revisit_bytes)
    url = F.regexp_replace("url", r"\x20", "%20")
    for code in (9, 10, 13):
        url = F.regexp_replace(url, rf"\x{code:02X}", f"%{code:02X}")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _line("Content-Type", "text/html; charset=utf-8"),
                    _line("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))
    block = F.octet_length("http") + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id("page_id")),
        F.coalesce(_line("WARC-Target-URI", url), F.lit("")),
        _line("WARC-Date", DATE),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("revisit"), F.concat(_line("WARC-Refers-To", _record_id("first_page")),
                                          _line("WARC-Profile", REVISIT_PROFILE))).otherwise(F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", block.cast("string")),
        F.lit("\r\n"), F.col("http"))
    (records.withColumn("revisit", revisit).withColumn("http", http)
     .select(F.encode(header, "UTF-8").alias("header"), "sha256")
     .write.parquet(f"{path}/records"))


def _checked(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads; one that does not match its key fails the job."""
    s = spark.read.parquet(f"{path}/payloads")
    right = F.unhex(F.sha2("payload", 256)) == F.col("sha256")
    return s.select("sha256", F.when(right, F.col("payload"))
                    .otherwise(F.raise_error(F.lit("a stored payload does not match its digest"))).alias("payload"))


def _fields(header: str) -> dict[str, Column]:
    text = F.decode(F.col(header), "UTF-8")
    got = lambda pattern: F.regexp_extract(text, pattern, 1)
    number = lambda c: F.when(~c.isin("", "null"), c.cast("long"))
    return {
        "record_type": got(r"(?m)^WARC-Type: (\S+)"),
        "page_id": number(got(rf"(?m)^WARC-Record-ID: <{RECORD_ID}([^>]*)>")),
        "refers_to": number(got(rf"(?m)^WARC-Refers-To: <{RECORD_ID}([^>]*)>")),
        "named_digest": got(r"(?m)^WARC-Payload-Digest: sha1:(\S+)"),
        # the first length is the record's own: that of all that follows the WARC header
        "block_bytes": got(r"(?m)^Content-Length: (\d+)").cast("long"),
        "warc_bytes": F.octet_length(F.substring_index(text, "\r\n\r\n", 1)).cast("long") + 4,
    }


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records, rebuilt by joining headers and payloads: ``page_id``, ``record_type``,
    ``refers_to``, ``record`` (the bytes of the record as a WARC file holds them), ``payload`` (a
    revisit's is that of the record it refers to), ``payload_bytes`` and ``payload_digest``.

    Length and digest are those of the rebuilt payload bytes.  A record whose digest or length is not
    the one that its header states fails the job, as does a stored payload that is not what its key says.
    """
    r = spark.read.parquet(f"{path}/records")
    r = r.select("sha256", "header", *[c.alias(k) for k, c in _fields("header").items()])
    j = r.join(_checked(spark, path).select("sha256", F.col("payload").alias("stored")), "sha256")
    own = F.col("record_type") == "response"
    j = j.withColumn("record", F.concat("header", F.when(own, F.col("stored")).otherwise(F.lit(b"")), F.lit(END)))
    # the payload as it stands in the rebuilt record
    start = F.octet_length("header") + 1
    inside = F.substring(F.col("record"), start, F.octet_length("record") - F.octet_length("header") - len(END))
    j = j.withColumn("payload", F.when(own, inside).otherwise(F.col("stored")))
    j = j.withColumn("digest", sha1_base32("payload"))
    block = F.octet_length("record") - len(END) - F.col("warc_bytes")
    right = (F.col("digest") == F.col("named_digest")) & (block == F.col("block_bytes"))
    digest = F.when(right, F.col("digest")).otherwise(F.raise_error(F.lit("a record is not what its header says")))
    return j.select("page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
                    digest.alias("payload_digest"), "header", "payload", "record")
