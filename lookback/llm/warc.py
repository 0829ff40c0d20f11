"""WARC archives: written and read on Spark, and captures assembled from their records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.llm.common import staged
from lookback.session import scratch_dir

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD_SCHEMA = (
    "record_id string, record_type string, concurrent_to array<string>, target_uri string, "
    "date string, refers_to string, declared_digest string, payload_digest string, "
    "payload_bytes long, http_status string, fields string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""
    digest = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def _uri(url: Column) -> Column:
    """A URL fit for one header line: control characters and spaces go, nothing else."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "")


def _record(kind: str | Column, headers: list[tuple[str, Column]], block: Column) -> Column:
    """Text of one record without the two line ends after it; null headers are left out."""
    lines = [
        F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
        for name, value in headers
    ]
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        F.lit(kind) if isinstance(kind, str) else kind,
        F.lit("\r\n"),
        *lines,
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
    )


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write request, response (or revisit) and metadata records of every row to ``path``.

    Of rows whose payloads of at least ``min_bytes`` bytes are equal, that with the
    smallest id holds the payload and the others are revisits that refer to it; smaller
    payloads are all responses. Among rows that repeat the smallest id one is the
    response; null ids come after all others. A null payload is empty. The metadata
    record holds id and url as JSON, so any url survives; header lines hold it without
    white space.

    The rows of a partition form one gzip-compressed file, written and committed by
    Spark. Partitions are dealt by row, so equal payloads cannot crowd one file.
    """
    body = F.coalesce(F.col(payload_col), F.lit(""))
    rows = staged(
        pages.select(
            F.col(id_col).alias("id"),
            F.col(url_col).alias("url"),
            body.alias("body"),
            F.monotonically_increasing_id().alias("capture"),
            F.octet_length(body).cast("long").alias("bytes"),
            base32_sha1(body.cast("binary")).alias("digest"),
        ),
        "warc-rows",
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "capture")
    firsts = (
        rows.where(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "bytes", F.col("first.capture").alias("first"))
    )
    firsts = staged(firsts, "warc-firsts")
    again = (
        rows.select("capture", "digest", "bytes")
        .join(firsts, ["digest", "bytes"])
        .where("capture <> first")
        .select("capture", "first")
    )
    urn = lambda kind, of: F.concat(F.lit(f"<urn:lookback:{kind}:"), of.cast("string"), F.lit(">"))
    full = rows.join(again, "capture", "left")
    uri = _uri(F.col("url"))
    host = F.regexp_extract(uri, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    target = F.regexp_replace(uri, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    stamp = ("WARC-Date", F.lit(date))
    to = ("WARC-Target-URI", F.when(uri != "", uri))
    capture, first = F.col("capture"), F.col("first")
    answer = urn("response", capture)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    request = _record(
        "request",
        [
            ("WARC-Record-ID", urn("request", capture)),
            stamp,
            to,
            ("WARC-Concurrent-To", answer),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(
            F.lit("GET "),
            F.when(target.startswith("/"), target).otherwise(F.concat(F.lit("/"), target)),
            F.lit(" HTTP/1.1\r\nHost: "),
            host,
            F.lit("\r\n\r\n"),
        ),
    )
    response = _record(
        F.when(first.isNull(), "response").otherwise("revisit"),
        [
            ("WARC-Record-ID", answer),
            stamp,
            to,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
            ("WARC-Refers-To", urn("response", first)),
            ("WARC-Profile", F.when(first.isNotNull(), F.lit(REVISIT_PROFILE))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(first.isNull(), F.concat(http, "body")).otherwise(http),
    )
    metadata = _record(
        "metadata",
        [
            ("WARC-Record-ID", urn("metadata", capture)),
            stamp,
            to,
            ("WARC-Concurrent-To", urn("request", capture)),
            ("Content-Type", F.lit("application/json")),
        ],
        F.to_json(F.struct("id", "url"), {"ignoreNullFields": "false"}),
    )
    gap = F.lit("\r\n\r\n")
    # The text writer ends every row with "\n", the last character of the last record.
    full.select(F.concat(request, gap, response, gap, metadata, F.lit("\r\n\r"))).write.option(
        "compression", "gzip"
    ).text(path)


def parse_warc(data: bytes, with_payload: bool) -> Iterator[dict]:
    """Records of one archive: plain, one gzip stream, or a gzip member per record."""
    raw = io.BytesIO(data)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if data[:2] == b"\x1f\x8b" else raw
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        length = int(headers["content-length"][0])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("the archive ends within a record")
        yield _parsed(headers, block, with_payload)


def _parsed(headers: dict[str, list[str]], block: bytes, with_payload: bool) -> dict:
    one = lambda name: headers.get(name, [None])[0]
    kind = one("warc-type")
    status = payload = None
    if (one("content-type") or "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        if kind != "request":
            words = head.split(b"\r\n", 1)[0].split()
            status = words[1].decode("ascii", "replace") if len(words) > 1 else None
    elif kind in ("response", "resource"):
        payload = block
    held = payload if kind in ("response", "resource") else None
    return {
        "record_id": one("warc-record-id"),
        "record_type": kind,
        "concurrent_to": headers.get("warc-concurrent-to", []),
        "target_uri": one("warc-target-uri"),
        "date": one("warc-date"),
        "refers_to": one("warc-refers-to"),
        "declared_digest": (one("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "payload_digest": None
        if held is None
        else base64.b32encode(hashlib.sha1(held).digest()).decode(),
        "payload_bytes": None if held is None else len(held),
        "http_status": status,
        "fields": block.decode("utf-8", "replace") if kind in ("metadata", "warcinfo") else None,
        "payload": held if with_payload else None,
    }


def read_warc(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives (``*.gz`` and plain ``*.warc``) under ``path`` (``RECORD_SCHEMA``).

    A task holds one file at a time, so keep files to some hundred MB, as archives are.
    A file that breaks off within a record raises an error. Without ``with_payload``
    sizes and digests are still those of the whole payloads.
    """
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                (n, {"concurrent_to": pa.list_(pa.string()), "payload_bytes": pa.int64(), "payload": pa.binary()}.get(n, pa.string()))
                for n in names
            ]
        )
        for batch in batches:
            for data in batch.column(0):
                held, size = [], 0
                for record in parse_warc(data.as_py(), with_payload):
                    held.append(record)
                    size += len(record["payload"] or b"") + 500
                    if size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,gz}").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture, joined through ``WARC-Concurrent-To``.

    Rows: ``capture_id``, ``response`` (the response, revisit or resource record as a
    struct), ``original`` (for a revisit the response it refers to), ``requests`` and
    ``metadata`` (arrays of structs, by record id, empty if there are none). Concurrent
    links count both ways, and a record may reach its response directly or through one
    other record (metadata that names the request). Records that reach no response are
    in no capture; a revisit whose response is in no archive has a null ``original``.
    Response records without an id stand alone. ``records`` is read several times:
    stage it.
    """
    records = records.withColumn("rec", F.struct(*records.columns))
    kinds = F.col("record_type").isin("response", "revisit", "resource")
    answers = records.where(kinds)
    others = records.where(~kinds | F.col("record_type").isNull())
    named = records.select(
        F.col("record_id").alias("x"), F.explode("concurrent_to").alias("y"), kinds.alias("answer")
    ).distinct()
    links = named.select("x", "y").unionByName(named.select(F.col("y").alias("x"), F.col("x").alias("y")))
    ids = answers.select(F.col("record_id").alias("capture_id")).distinct()
    direct = links.join(ids, links["y"] == ids["capture_id"]).select("x", "capture_id").distinct()
    near = direct.select(F.col("x").alias("y"), "capture_id")
    two = links.join(near, "y").select("x", "capture_id")
    two = two.join(direct.select("x"), "x", "left_anti")
    reach = direct.unionByName(two).distinct()
    parts = (
        others.select("record_id", "record_type", "rec")
        .join(reach, F.col("record_id") == F.col("x"))
        .groupBy("capture_id")
        .agg(
            *(
                F.sort_array(
                    F.collect_list(F.when(F.col("record_type") == kind, F.col("rec")))
                ).alias(name)
                for kind, name in (("request", "requests"), ("metadata", "metadata"))
            )
        )
    )
    source = records.where("record_type = 'response'").select(
        F.col("record_id").alias("source_id"),
        F.struct("record_id", "payload_digest", "payload_bytes", "payload").alias("original"),
    )
    rows = answers.select(F.col("record_id").alias("capture_id"), F.col("refers_to").alias("to"), F.col("rec").alias("response"))
    none = F.array().cast(records.select(F.array("rec").alias("r")).schema["r"].dataType)
    return (
        rows.join(parts, "capture_id", "left")
        .join(source, F.col("to") == F.col("source_id"), "left")
        .select(
            "capture_id",
            "response",
            "original",
            F.coalesce("requests", none).alias("requests"),
            F.coalesce("metadata", none).alias("metadata"),
        )
    )


def archived_pages(pages: DataFrame, *, id_col: str = "page_id", min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back and return what each capture holds.

    Columns ``id_col``, ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to`` (the id of the response that a revisit refers to), all taken from the
    assembled captures. A row of ``pages`` gives one row, repeated and null ids included.
    """
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    kind = pages.schema[id_col].dataType
    write_warc(pages, path, id_col=id_col, min_bytes=min_bytes)
    records = staged(read_warc(spark, path, with_payload=False), "warc-records")
    about = F.from_json(F.col("metadata")[0]["fields"], f"id {kind.simpleString()}, url string")
    captures = assemble(records).select(
        "capture_id",
        "response",
        "original",
        about["id"].alias("id"),
    )
    captures = staged(captures, "warc-captures")
    first = captures.where("response.record_type = 'response'").select(
        F.col("capture_id").alias("source_id"), F.col("id").alias("refers_to")
    )
    return captures.join(first, F.col("response.refers_to") == F.col("source_id"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("response.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", "original.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        "refers_to",
    )
