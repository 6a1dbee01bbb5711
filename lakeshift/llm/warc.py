"""WARC archives: writing captures with payload de-duplication, reading records back, and putting
each HTTP transaction together again.

Writing: a page becomes three records, the response (or a revisit that refers to an equal payload),
the request and metadata; the latter two name the first one in ``WARC-Concurrent-To``. Records are
text, and the blank lines that end a record are the line separator of Spark's text writer, so the
archives are written by the ordinary file committer: gzip files of a bounded number of records and
of bytes, as large payloads go to archives of fewer captures.

Reading: each archive is one binary row, unpacked as a stream and parsed record by record by the
lengths in the records' headers; a task holds the packed archive and a batch of records.

Assembly: request and metadata records are joined to their response or revisit through the
concurrent-to identifiers (stated on either side), and one nested row per capture comes out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import join_splittable, table
from lakeshift.session import scratch_path

#: Archives by the payloads that they hold: (most bytes of a payload, most captures of an archive).
#: Before packing, an archive of the first two kinds holds less than 1 GB of payloads; a larger
#: payload has an archive of its own.
ARCHIVES = ((128 << 10, 5_000), (4 << 20, 200), (None, 1))
RECORDS_PER_CAPTURE = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits are four base32 ones."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those whose value is null are left out."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value) for name, value in pairs])


def _record(head: Column, block: Column) -> Column:
    """A record without the blank lines that end it."""
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block))
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), size, F.lit(END), block)


def duplicates(pages: DataFrame, page_id: str = "page_id", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another one: of equal payloads of at
    least ``min_bytes`` bytes the page with the largest id is the response. Only digests and ids
    are shuffled, and pre-aggregated per digest."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    narrow = pages.select(F.col(f"`{page_id}`").alias("dup_id"), payload_digest(body.cast("binary")).alias("dup_digest"),
                          F.octet_length(body).alias("size")).where(F.col("size") >= min_bytes).drop("size")
    largest = narrow.groupBy("dup_digest").agg(F.max("dup_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    largest = largest.where((F.col("n") > 1) & F.col("refers_to").isNotNull()).drop("n")
    found = join_splittable(narrow, largest, ["dup_digest"]).where(~F.col("dup_id").eqNullSafe(F.col("refers_to")))
    return found.distinct()


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_bytes: int = 0, date: str = DATE, archives: Sequence[tuple[int | None, int]] = ARCHIVES) -> None:
    """Write three records per row of ``pages`` as gzip archives under ``path``.

    - null html: the empty payload; null url: no target header; line breaks in urls are escaped
    - null page_id: no id header; such a page can revisit another one but is not referred to
    - repeated rows: each is a capture; rows with the largest id of their payload are all responses
    - other columns are not written; an empty table leaves an empty folder
    - ``archives``: the kinds of archives by size of payload; each kind that has any rows is written
      by itself, and only its own rows are shuffled
    """
    size = F.octet_length(F.coalesce(F.col(f"`{html}`"), F.lit("")))
    bounds = list(zip([-1, *[most for most, _ in archives]], [most for most, _ in archives]))
    fits = [(size > low) if high is None else (size > low) & (size <= high) for low, high in bounds]
    seen = pages.agg(*[F.count_if(c).alias(f"kind{k}") for k, c in enumerate(fits)]).first()
    for k, (_, captures) in enumerate(archives):
        if k == 0 or seen[f"kind{k}"]:
            # Equal payloads are of one kind, so no page is a copy of one of another kind.
            records = _records(pages.where(fits[k]), page_id, url, html, min_bytes, date)
            (records.write.mode("errorifexists" if k == 0 else "append").option("lineSep", END).option("compression", "gzip")
                .option("maxRecordsPerFile", RECORDS_PER_CAPTURE * captures).text(path))


def _records(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int, date: str) -> DataFrame:
    """The texts of three records per row, as ``write`` describes them (column ``record``)."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"),
        payload_digest(body.cast("binary")).alias("digest"))
    dups = duplicates(pages, page_id, html, min_bytes)
    rows = rows.join(
        dups, rows["page_id"].eqNullSafe(dups["dup_id"]) & (rows["digest"] == dups["dup_digest"]), "left")
    # A number per row makes record names unique, also for repeated rows; the three records of a
    # capture are made from the same row, so a task that runs again stays consistent in itself.
    rows = rows.withColumn("serial", F.monotonically_increasing_id())
    name = lambda kind: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.md5(F.concat_ws("/", F.lit(kind), F.col("serial").cast("string"), F.col("page_id").cast("string"), F.col("digest"))),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    page = F.col("page_id").cast("string")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("body"), F.lit(END))
    first = name("response")
    same = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri), ("X-Page-Id", page)]
    response = _record(_lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", first), *same,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, PROFILE)),
        ("X-Refers-To-Page-Id", F.col("refers_to").cast("string")),
        ("Content-Type", F.lit("application/http; msgtype=response"))), F.concat(http, F.when(revisit, "").otherwise(F.col("body"))))
    place = F.regexp_replace(F.coalesce(uri, F.lit("")), "^[a-zA-Z]+://[^/?#]*", "")
    request = _record(_lines(
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", name("request")), *same, ("WARC-Concurrent-To", first),
        ("Content-Type", F.lit("application/http; msgtype=request"))),
        F.concat(F.lit("GET "), F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), place)), F.lit(" HTTP/1.1" + END)))
    metadata = _record(_lines(
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", name("metadata")), *same, ("WARC-Concurrent-To", first),
        ("Content-Type", F.lit("application/warc-fields"))),
        F.concat(F.lit("payload-bytes: "), F.octet_length("body"), F.lit("\r\n")))
    return rows.select(F.explode(F.array(response, request, metadata)).alias("record"))


RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())), T.StructField("page_id", T.LongType()),
    T.StructField("refers_to", T.LongType()), T.StructField("uri", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload", T.StringType())])


def parse(content: bytes) -> Iterator[dict]:
    """Records of one archive that is not packed; see ``parse_stream``."""
    yield from parse_stream(io.BytesIO(content))


def parse_stream(stream: BinaryIO, ahead: int = 1 << 20) -> Iterator[dict]:
    """Records of one archive, read one after the other; held are ``ahead`` bytes and a record. A
    record cut short, or a payload that does not fit its digest, raises ValueError."""
    held, at = b"", 0
    while True:
        while (stop := held.find(b"\r\n\r\n", at)) < 0:
            more = stream.read(ahead)
            if not more and at == len(held):
                return
            if not more:
                raise ValueError("a record is cut short")
            held, at = held[at:] + more, 0
        if not held.startswith(b"WARC/", at):
            raise ValueError("no WARC record where one should begin")
        header = held[at:stop]
        head: dict[str, list[str]] = {}
        for line in header.decode("utf-8").split("\r\n")[1:]:
            name, _, value = line.partition(": ")
            head.setdefault(name.lower(), []).append(value)
        size = int(head["content-length"][0])
        end = stop + 4 + size + 4
        if end > len(held):
            held, stop, end = held[at:] + stream.read(max(ahead, end - len(held))), stop - at, end - at
        at = end
        block = held[stop + 4:end - 4]
        if end > len(held) or held[end - 4:end] != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        one = lambda key: head.get(key, [None])[0]  # noqa: E731, B023
        kind, digest, payload, n_bytes = one("warc-type"), one("warc-payload-digest"), None, None
        if kind in ("response", "revisit"):
            http, _, body = block.partition(b"\r\n\r\n")
            n_bytes = int(http.decode("latin-1").lower().split("content-length: ")[1].split("\r\n")[0])
            if kind == "response":
                payload = body.decode("utf-8")
                if len(body) != n_bytes or "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                    raise ValueError(f"the payload of {one('warc-record-id')} does not fit its digest")
        elif kind == "request":
            payload = block.decode("utf-8")
        elif kind == "metadata":
            payload = block.decode("utf-8")
        page, refers = one("x-page-id"), one("x-refers-to-page-id")
        yield {
            "record_id": one("warc-record-id"), "record_type": kind, "concurrent_to": head.get("warc-concurrent-to", []),
            "page_id": None if page is None else int(page), "refers_to": None if refers is None else int(refers),
            "uri": one("warc-target-uri"), "payload_digest": digest and digest.removeprefix("sha1:"),
            "payload_bytes": n_bytes, "payload": payload}


def read(spark: SparkSession, path: str, batch_bytes: int = 8_000_000) -> DataFrame:
    """One row per record of the archives under ``path`` (schema RECORD)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(RECORD)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                packed = pa.BufferReader(content.as_buffer())
                for record in parse_stream(gzip.GzipFile(fileobj=packed)):
                    rows.append(record)
                    size += len(record["payload"] or "")
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with the arrays of its requests and of
    its metadata (record_id, payload).

    Links are read from both sides. A request or metadata record whose partner is not in the
    archives makes a capture of its own with null response fields. A record linked to several
    responses stands in each; repeated record ids of responses each get the linked records.
    """
    primary = records.where("record_type IN ('response', 'revisit')")
    others = records.where("record_type IN ('request', 'metadata')").select(
        "record_type", "concurrent_to", F.struct("record_id", "payload").alias("record"))
    by_response = primary.where(F.size("concurrent_to") > 0).select(
        F.col("record_id").alias("to_stated"), F.explode("concurrent_to").alias("named"), F.lit(True).alias("turned"))
    # The archives are parsed once for both sides: what a record states itself (null: nothing), and
    # the response that names it.
    stated = F.when(F.size("concurrent_to") > 0, F.col("concurrent_to")).otherwise(F.array(F.lit(None).cast("string")))
    turned = F.when(F.col("turned"), F.array("to_stated")).otherwise(F.array().cast("array<string>"))
    both = others.join(by_response, F.col("record.record_id") == F.col("named"), "left").select(
        "record_type", "record", F.explode(F.concat(stated, turned)).alias("to"))
    own = F.coalesce("to", "record.record_id")
    links = both.distinct().select("record_type", "record", own.alias("capture"))
    pick = lambda kind: F.collect_list(F.when(F.col("record_type") == kind, F.col("record")))
    linked = links.groupBy("capture").agg(
        F.array_sort(pick("request")).alias("requests"), F.array_sort(pick("metadata")).alias("metadata"))
    return primary.join(linked, primary["record_id"] == linked["capture"], "full_outer").select(
        F.coalesce("record_id", "capture").alias("capture_id"), "page_id", "record_type", "uri", "refers_to",
        "payload_digest", "payload_bytes", "payload", "requests", "metadata")


def op8_warc_transactions(spark, sf_dir: str) -> DataFrame:
    """All pages written as archives in the shared folder, read back and assembled."""
    path = scratch_path(spark, "warc")
    write(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return assemble(read(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        F.size("requests").cast("long").alias("n_requests"), F.size("metadata").cast("long").alias("n_metadata"))


ORACLE_OP8 = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS digits FROM pages),
h AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS largest FROM p),
d AS (
  SELECT page_id, payload, largest,
    (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(digits, 1 + 5 * (k // 4), 5))::BIGINT >> (5 * (3 - k % 4))) & 31 AS INTEGER), 1), '' ORDER BY k)
     FROM range(32) r(k)) AS payload_digest
  FROM h)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to,
  1::BIGINT AS n_requests, 1::BIGINT AS n_metadata
FROM d
"""
