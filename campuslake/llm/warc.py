"""WARC archives: writing captures as transactions, and assembling them again.

A capture is three records: a request, a response (or a revisit of an earlier
payload) and metadata, tied together by WARC-Concurrent-To. They are written by
Spark's text sink, whose line separator is the blank lines that end a WARC
record, so that every part file is an archive; they are read back as binary
files and cut by Content-Length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, shared_dir, small

MIN_REVISIT_BYTES = 1000
#: Rows of pages to an archive file, so that a reader's memory is bounded.
PAGES_PER_FILE = 2000
CRLF = "\r\n"
END = CRLF + CRLF


# ---------------------------------------------------------------- writing


def with_roles(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes and refers_to (null: a response) for every row.

    Of the rows with an equal payload of at least MIN_REVISIT_BYTES bytes, that of
    the largest id is the response and the others refer to it; rows repeated with
    that id are responses too. A null payload counts as empty; a null id is never
    referred to, and its row is a response only if no id is there to refer to.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1(F.col("payload").cast("binary")), "payload_bytes": F.octet_length("payload").cast("long")})
    # the copies of one payload meet as one pre-aggregated row from each task
    last = rows.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b")).agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    last = small(cut(last.where("n > 1").drop("n"), "last"))
    out = rows.join(last, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")), "left")
    refers = F.when(F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("page_id")), F.col("last"))
    return out.withColumn("refers_to", refers).drop("d", "b", "last")


def record(kind: str, record_id: Column, uri: Column, headers: dict[str, Column], content_type: str, block: Column) -> Column:
    """One record without the blank lines after it; a header whose value is null is left out."""
    head = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: "), record_id, F.lit(f"{CRLF}WARC-Date: 2024-01-01T00:00:00Z{CRLF}WARC-Target-URI: "), uri]
    head += [F.coalesce(F.concat(F.lit(f"{CRLF}{k}: "), v), F.lit("")) for k, v in headers.items()]
    return F.concat(*head, F.lit(f"{CRLF}Content-Type: {content_type}{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block)


def urn(page: Column, part: str) -> Column:
    return F.concat(F.lit("<urn:capture:"), page, F.lit(f":{part}>"))


def records(roles: DataFrame) -> DataFrame:
    """The three records of each row of with_roles(), as text in column `value`."""
    # rows repeated with one id, or with none, stay apart by a number of their own
    key = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit("."), F.monotonically_increasing_id().cast("string"))
    d = roles.withColumn("key", key)
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "")
    page, me = F.col("page_id").cast("string"), urn(F.col("key"), "response")
    status = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{END}")
    digest = F.concat(F.lit("sha1:"), F.col("payload_digest"))
    common = {"X-Page-Id": page, "WARC-Payload-Digest": digest}
    http = "application/http; msgtype=response"
    response = record("response", me, uri, common, http, F.concat(status, F.col("payload")))
    revisit = record("revisit", me, uri, common | {"X-Refers-To-Page": F.col("refers_to").cast("string"), "WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")}, http, status)
    request = record("request", urn(F.col("key"), "request"), uri, {"WARC-Concurrent-To": me}, "application/http; msgtype=request", F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{END}")))
    about = record("metadata", urn(F.col("key"), "metadata"), uri, {"WARC-Concurrent-To": me}, "application/warc-fields", F.concat(F.lit("payload-length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF)))
    either = F.when(F.col("refers_to").isNull(), response).otherwise(revisit)
    return d.select(F.explode(F.array(request, either, about)).alias("value"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", pages_per_file: int = PAGES_PER_FILE) -> None:
    """Write gzipped archives under path, each of pages_per_file pages at most; an empty table gives an empty folder of archives.

    A payload is written whole, as one line of Spark's text sink, so it must fit the
    2 GB of a string; columns other than the three are not read.
    """
    out = records(with_roles(pages, id_col, html_col, url_col)).write
    out.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * pages_per_file).text(path)


# ---------------------------------------------------------------- reading


def cut_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, by Content-Length."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"record {headers.get('warc-record-id')} ends early")
        yield headers, block


RECORD = T.StructType([T.StructField(k, t) for k, t in {
    "record_id": T.StringType(), "kind": T.StringType(), "concurrent_to": T.StringType(), "uri": T.StringType(), "page_id": T.LongType(), "refers_to": T.LongType(),
    "digest": T.StringType(), "payload_sha1": T.StringType(), "payload_bytes": T.LongType(), "length": T.LongType(), "block": T.BinaryType(), "headers": T.MapType(T.StringType(), T.StringType()),
}.items()])


def read_warc(spark: SparkSession, path: str, keep_blocks: bool = True) -> DataFrame:
    """Every record of the archives under path. payload_sha1 and payload_bytes are taken from the block of a response; length is what metadata tells.

    An archive is read whole by a task and may have 2 GB, packed; its records are
    unpacked one after the other.
    """

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for headers, block in cut_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))):
                    kind = headers["warc-type"]
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    digest = headers.get("warc-payload-digest", "").partition(":")[2].lower()
                    if len(digest) == 32:  # base32, as other writers have it
                        digest = base64.b32decode(digest.upper()).hex()
                    fields = dict(x.split(": ", 1) for x in block.decode().split(CRLF) if ": " in x) if kind == "metadata" else {}
                    number = lambda x: int(x) if x else None
                    rows.append({
                        "record_id": headers["warc-record-id"], "kind": kind, "concurrent_to": headers.get("warc-concurrent-to"), "uri": headers.get("warc-target-uri"),
                        "page_id": number(headers.get("x-page-id")), "refers_to": number(headers.get("x-refers-to-page")), "digest": digest or None,
                        "payload_sha1": hashlib.sha1(payload).hexdigest() if payload is not None else None, "payload_bytes": len(payload) if payload is not None else None,
                        "length": number(fields.get("payload-length")), "block": block if keep_blocks else None, "headers": list(headers.items()) if keep_blocks else None,
                    })
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    text, number = pa.string(), pa.int64()
    kinds = pa.schema([("record_id", text), ("kind", text), ("concurrent_to", text), ("uri", text), ("page_id", number), ("refers_to", number), ("digest", text), ("payload_sha1", text), ("payload_bytes", number), ("length", number), ("block", pa.binary()), ("headers", pa.map_(text, text))])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(found: DataFrame, with_blocks: bool = True) -> DataFrame:
    """One nested row for each capture: the response or revisit, with the request and the metadata that are concurrent to it.

    A capture without request or metadata keeps a null there; a request or metadata
    record without its response gives no row. The records of a capture meet in one
    shuffle by the response's id; the archives are parsed once.
    """
    keep = ["record_id", "uri", "block", "headers"] if with_blocks else ["record_id"]
    mine = F.col("kind").isin("response", "revisit")
    main = ["record_id", F.col("kind").alias("record_type"), "uri", "page_id", "refers_to", "digest", "payload_sha1", "payload_bytes", *(["block", "headers"] if with_blocks else [])]
    one = lambda of, *columns: F.first(F.when(of, F.struct(*columns)), ignorenulls=True)
    rows = found.groupBy(F.when(mine, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture")).agg(
        one(mine, *main).alias("main"), one(F.col("kind") == "request", *keep).alias("request"), one(F.col("kind") == "metadata", *keep, "length").alias("metadata")
    )
    return rows.where("main IS NOT NULL").select("main.*", "request", "metadata")


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Write the archives of pages into the shared folder, read them back, and tell for each capture what its records say.

    A response's digest and size are those of the payload read back; a revisit's
    are those that its records carry. Repeated rows give a capture each.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/campuslake/warc-{uuid.uuid4().hex}"
    write_warc(pages, path, id_col, html_col, url_col)
    out = assemble(read_warc(spark, path, keep_blocks=False), with_blocks=False)
    return out.select(
        F.col("page_id").alias(id_col), F.coalesce("payload_bytes", "metadata.length").alias("payload_bytes"), F.coalesce("payload_sha1", "digest").alias("payload_digest"),
        "record_type", "refers_to", F.col("request.record_id").alias("request_id"),
    )
