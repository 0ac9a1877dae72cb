"""WARC archives: writing captures as request, response or revisit, and metadata records; reading and assembling them.

Archives are written by Spark's text writer, a record a value and two line ends
as separator, which is the WARC layout. Reading parses whole records; a
capture's records are joined by their concurrent-to identifiers.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from .common import joined, packed

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE_END = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SEPARATOR = "\r\n\r\n"

RECORDS_PER_FILE = 30_000
BATCH_BYTES = 16 << 20


def record_id(kind: str, *parts: Column) -> Column:
    """Identifier that depends on nothing but the capture, so a retried task writes the same record."""
    digest = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def record(kind: str | Column, identifier: Column, block: Column, **headers: Column) -> Column:
    """Text of a record; headers without a value are left out."""
    named = [
        F.when(value.isNotNull(), F.concat(F.lit("WARC-" + name.replace("_", "-") + ": "), value))
        if name != "Content_Type"
        else F.concat(F.lit("Content-Type: "), value)
        for name, value in headers.items()
    ]
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(
        F.concat_ws(
            LINE_END,
            F.lit(VERSION),
            F.concat(F.lit("WARC-Type: "), kind),
            F.concat(F.lit("WARC-Record-ID: "), identifier),
            *named,
            F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
        ),
        F.lit(RECORD_SEPARATOR),
        block,
    )


def numbered(base: DataFrame) -> DataFrame:
    """Adds `again`: 2, 3 and so on for repeated rows of (page_id, url, digest), null for the first.

    Only rows whose id and url stand more than once are numbered; a null url is
    an empty one here, as in the identifiers. Rows with one url are equal, so it
    doesn't matter which of them gets which number.
    """
    base = base.withColumn("at", F.coalesce("url", F.lit("")))
    repeated = stored(base.groupBy("page_id", "at").agg(F.count("*").alias("n")).where("n > 1").select("page_id", "at"), "repeated-pages")
    single = base.withColumn("again", F.lit(None).cast("int"))
    if repeated.isEmpty():
        return single
    marked = joined(base, repeated.withColumn("more", F.lit(1)), ["page_id", "at"], "left")
    place = F.row_number().over(Window.partitionBy("page_id", "at", "digest").orderBy("url"))
    some = marked.where("more = 1").drop("more").withColumn("again", F.when(place > 1, place))
    return marked.where("more IS NULL").drop("more").withColumn("again", F.lit(None).cast("int")).unionByName(some)


def write_captures(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 100,
    date: str = "2024-01-01T00:00:00Z",
    every_row: bool = False,
) -> None:
    """Write three records per page, gzip-compressed archives, under `path`.

    Of pages with equal payloads of at least `least` bytes the smallest id is
    the response and the others revisit it, without the payload. With
    `every_row`, rows that agree in id, url and payload are captures of their own.
    """
    base = packed(pages, page_id=F.col(page_id), url=F.col(url), payload=F.coalesce(F.col(payload), F.lit("")))
    base = base.drop("row").withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    base = numbered(base) if every_row else base.withColumn("again", F.lit(None).cast("int"))
    copies = (
        base.where((F.col("size") >= least) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min(F.struct("page_id", F.coalesce("url", F.lit("")).alias("url"))).alias("first"), F.count("*").alias("n"))
    )
    missing = base.where((F.col("size") >= least) & F.col("page_id").isNull()).select("digest").distinct().withColumn("more", F.lit(1))
    copies = copies.join(missing, "digest", "left").where((F.col("n") > 1) | F.col("more").isNotNull()).select("digest", "first")
    marked = joined(base, copies, ["digest"], "left")
    original = F.col("first").isNull() | (
        F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.coalesce("url", F.lit("")) == F.col("first.url"))
    )
    captures = marked.withColumn("original", original)
    own = record_id("capture", F.col("page_id"), F.col("url"), F.col("digest"))
    again = record_id("repeated", F.col("page_id"), F.col("url"), F.col("digest"), F.col("again"))
    captures = captures.withColumn("own", F.when(F.col("again").isNull(), own).otherwise(again))
    place = F.regexp_replace("url", r"[\r\n]+", " ")
    host = F.coalesce(F.nullif(F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#\s]*)", 1), F.lit("")), F.lit("unknown"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(RECORD_SEPARATOR)
    )
    shared = {"Date": F.lit(date), "Target_URI": place}
    answer = record(
        F.when(F.col("original"), "response").otherwise("revisit"),
        F.col("own"),
        F.when(F.col("original"), F.concat(http, F.col("payload"))).otherwise(http),
        **shared,
        Payload_Digest=F.concat(F.lit("sha256:"), F.col("digest")),
        Profile=F.when(~F.col("original"), F.lit(REVISIT_PROFILE)),
        Refers_To=F.when(~F.col("original"), record_id("capture", F.col("first.page_id"), F.col("first.url"), F.col("digest"))),
        Content_Type=F.lit("application/http; msgtype=response"),
    )
    asked = record(
        "request",
        record_id("request", F.col("own")),
        F.concat(F.lit("GET / HTTP/1.1\r\nHost: "), host, F.lit(RECORD_SEPARATOR)),
        **shared,
        Concurrent_To=F.col("own"),
        Content_Type=F.lit("application/http; msgtype=request"),
    )
    about = record(
        "metadata",
        record_id("metadata", F.col("own")),
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(LINE_END)),
        **shared,
        Concurrent_To=F.col("own"),
        Content_Type=F.lit("application/warc-fields"),
    )
    records = captures.select(F.explode(F.array(asked, answer, about)).alias("value"))
    (
        records.write.option("lineSep", RECORD_SEPARATOR)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def parsed(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("the archive ends within a record")
        yield headers, block


RECORD_SCHEMA = (
    "record_id string, record_type string, date string, target_uri string, concurrent_to string, refers_to string,"
    " payload_digest string, fields map<string,string>, payload binary"
)
FIELDS = ["warc-record-id", "warc-type", "warc-date", "warc-target-uri", "warc-concurrent-to", "warc-refers-to", "warc-payload-digest"]


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under `path`; `payload` of responses, `fields` of metadata."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    texts = [pa.field(n, pa.string()) for n in ("record_id", "record_type", "date", "target_uri", "concurrent_to", "refers_to", "payload_digest")]
    schema = pa.schema([*texts, pa.field("fields", pa.map_(pa.string(), pa.string())), pa.field("payload", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for content in batch.column(0):
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as stream:
                    for headers, block in parsed(stream):
                        fields, payload = None, None
                        if headers["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                        elif headers["warc-type"] == "metadata":
                            pairs = (line.partition(":") for line in block.decode().splitlines() if line)
                            fields = [(name.strip(), value.strip()) for name, _, value in pairs]
                        out.append((*map(headers.get, FIELDS), fields, payload))
                        size += len(block)
                        if size >= BATCH_BYTES:
                            yield batched(out)
                            out, size = [], 0
        if out:
            yield batched(out)

    def batched(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    return files.mapInArrow(rows, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: structs `request`, `response` (or revisit) and `metadata`, joined by concurrent-to.

    `response` holds all columns of `records`, so callers choose how much of the
    payload is shuffled. A capture without a request or metadata has nulls there;
    records of a capture without a response come out as a row too. A record that
    stands twice counts once.
    """
    whole = F.struct(*records.columns)
    capture = F.coalesce("concurrent_to", "record_id")

    def only(*kinds: str) -> Column:
        return F.first(F.when(F.col("record_type").isin(*kinds), whole), ignorenulls=True)

    return records.groupBy(capture.alias("capture_id")).agg(
        only("request").alias("request"), only("response", "revisit").alias("response"), only("metadata").alias("metadata")
    )


def warc_round_trip(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", every_row: bool = False) -> DataFrame:
    """Write pages as archives under `path`, read them, and give one row per capture.

    Columns: page_id, url, payload_bytes, payload_digest (both of the full
    payload), record_type, refers_to.

    Null payload: an empty one. Null id: it is never the response of a group
    that holds an id. Null url: no target. Rows that agree in id, url and
    payload are one capture and come out once, or with `every_row` as often as
    they go in. Empty table: no rows. Payloads
    must be text, as strings are in Spark; their length is not limited here.
    """
    write_captures(pages, path, page_id, url, payload, every_row=every_row)
    records = read_records(pages.sparkSession, path)
    light = records.withColumns({"bytes": F.octet_length("payload").cast("long"), "sha256": F.sha2("payload", 256)}).drop("payload")
    light = stored(light, "records")  # archives are parsed once, payloads go no farther
    captures = assemble(light)
    flat = captures.select(
        F.nullif(F.col("metadata.fields").getItem("page-id"), F.lit("")).cast("long").alias("page_id"),
        F.col("response.target_uri").alias("url"),
        F.col("response.record_id").alias("record_id"),
        F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").alias("target"),
        F.col("response.bytes").alias("bytes"),
        F.col("response.sha256").alias("sha256"),
    )
    light_responses = light.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("target"), F.col("bytes").alias("full_bytes"), F.col("sha256").alias("full_sha256")
    )
    ids = light.where(F.col("record_type") == "metadata").select(
        F.col("concurrent_to").alias("target"), F.nullif(F.col("fields").getItem("page-id"), F.lit("")).cast("long").alias("refers_to")
    )
    referred = flat.where(F.col("target").isNotNull()).select("target").distinct()
    known = referred.join(light_responses.distinct(), "target").join(ids.distinct(), "target", "left")
    return flat.join(known, "target", "left").select(
        "page_id",
        "url",
        F.coalesce("bytes", "full_bytes").alias("payload_bytes"),
        F.coalesce("sha256", "full_sha256").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
