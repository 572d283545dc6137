"""WARC archives that hold each payload once.

``write_warc`` turns records into gzip-compressed WARC files through Spark's
text sink. Of the records with one payload, the one with the largest id is a
``response`` and carries it; the others are ``revisit`` records that name it.
``read_warc`` splits the files back into exact record headers and payloads, the
payloads keyed by their digest, which is computed anew from the bytes and must
agree with the header. ``reconstruct`` joins the two to the original records.

Every record starts with the version line and a boundary field with a number
drawn when the archive is written. No payload can hold it, as payloads are
older, so Spark's text source can cut the files at it on many tasks; to other
readers it is an ordinary extension field.

Defined results: a null payload is empty; line breaks in a URL are
percent-encoded, a null URL leaves the field out; records whose id is null
revisit a record with an id, and are responses where there is none; repeated
rows of the largest id are all responses; payloads below ``least_bytes`` are
all responses.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.llm.common import stored
from tradeweave.workspace import new_path

CRLF = "\r\n"
ID = "urn:page:"
#: Records of a file at most; gzip files are read by one task each.
FILE_RECORDS = 20_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1."""
    digest = F.sha1(payload)
    # 5 hex digits are 20 bits, which are 4 base32 digits
    parts = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _field(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def assign(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload``, digests, ``refers_to`` (null: a response)."""
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("key")
    )
    shared = (
        pages.select(F.col(id_column).alias("page_id"), payload.alias("payload"))
        .where(F.octet_length("payload") >= least_bytes)
        .groupBy(F.sha2("payload", 256).alias("shared"))
        .agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
        .where("n > 1")
        .select("shared", "target")
    )
    # stored, so that both sides of the join are plain shuffles and a hot payload can be split
    joined = rows.join(stored(shared, "warc-shared"), F.col("key") == F.col("shared"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("target")), F.col("target"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_warc(assigned: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> str:
    """Write the files; gives the boundary that ``read_warc`` needs."""
    boundary = uuid.uuid4().hex
    payload, revisit = F.col("payload"), F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(CRLF * 2),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(payload))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    digest = base32_sha1(payload)
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}X-Boundary: {boundary}{CRLF}WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(CRLF),
        _field("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), F.col("page_id").cast("string"), F.lit(">"))),
        _field("WARC-Target-URI", url),
        _field("WARC-Date", F.lit(date)),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _field("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("WARC-Refers-To", F.concat(F.lit(f"<{ID}"), F.col("refers_to").cast("string"), F.lit(">"))),
        _field("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
        block,
        # the sink's line end completes the two line breaks after a record
        F.lit("\r\n\r"),
    )
    writer = assigned.select(record.alias("value")).write
    writer.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    return boundary


def read_warc(spark: SparkSession, path: str, boundary: str) -> DataFrame:
    """``headers`` exact text of a record's header and ``block`` as written."""
    start = f"WARC/1.1{CRLF}X-Boundary: {boundary}{CRLF}"
    pieces = spark.read.option("lineSep", start).text(path).where("value <> ''")
    ends = "instr(value, concat(chr(13), chr(10), chr(13), chr(10)))"
    rows = pieces.select(
        F.concat(F.lit(start), F.expr(f"left(value, {ends} + 3)")).alias("headers"),
        F.expr(f"substring(value, {ends} + 4)").alias("rest"),
    )
    block = F.expr("left(rest, char_length(rest) - 4)")
    whole = (F.octet_length(block) == header("Content-Length").cast("long")) & F.endswith("rest", F.lit(CRLF * 2))
    checked = F.when(whole, block).otherwise(F.raise_error(F.concat(F.lit("broken WARC record: "), F.col("headers"))))
    return rows.select("headers", checked.alias("block"))


def header(name: str, of: str = "headers") -> Column:
    """Value of a header field, null if it is missing."""
    found = F.regexp_extract(of, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def store(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Headers with their payload digest, and payloads once by verified digest."""
    digest = F.regexp_replace(header("WARC-Payload-Digest"), "^sha1:", "")
    headers = records.select(
        F.regexp_extract(header("WARC-Record-ID"), r"<urn:page:(-?\d+)>", 1).try_cast("long").alias("page_id"),
        header("WARC-Type").alias("record_type"),
        F.regexp_extract(header("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).try_cast("long").alias("refers_to"),
        digest.alias("payload_digest"),
        "headers",
    )
    payload = F.expr("substring(block, instr(block, concat(chr(13), chr(10), chr(13), chr(10))) + 4)")
    carried = records.where(header("WARC-Type") == "response").select(digest.alias("said"), payload.alias("payload"))
    verified = F.when(base32_sha1(F.col("payload")) == F.col("said"), F.col("said")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("said")))
    )
    return headers, carried.select(verified.alias("digest"), "payload")


def reconstruct(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Every record with its whole payload again.

    ``payloads`` may hold a payload more than once (repeated rows, or payloads
    below the size from which they are shared); copies are dropped by digest.
    """
    once = payloads.groupBy("digest").agg(F.max("payload").alias("payload"))
    return headers.join(once, headers.payload_digest == once.digest, "left").drop("digest")


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write an archive of ``pages``, read it back and describe every record."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    boundary = write_warc(assign(pages, least_bytes), path)
    headers, payloads = store(read_warc(spark, path, boundary))
    # only what the answer needs of a payload travels: its size, after its digest was verified
    sizes = payloads.select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    sizes = stored(sizes.groupBy("digest").agg(F.max("payload_bytes").alias("payload_bytes")), "warc-payloads")
    return (
        headers.drop("headers")
        .join(sizes, F.col("payload_digest") == F.col("digest"), "left")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )
