"""WARC archives written from pages, and captures assembled from them again.

Writing: one transaction per page (request, response or revisit, metadata), the three records tied
by ``WARC-Concurrent-To``. The archives go out through Spark's text writer, whose line separator is
the end of a WARC record, so a lost task leaves no half-written archive.

Reading: files are cut into records by ``Content-Length``, which is right whatever a payload holds;
the transactions are assembled by a join on the concurrent-to identifiers.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderlens.llm.common import whole

#: Payloads of at least so many bytes are written once; equal ones refer to the first.
REVISIT_BYTES = 1000
#: Captures per archive file, which bounds what one reading task holds.
CAPTURES_PER_FILE = 20_000
END = "\r\n\r\n"
# Names and profile of the WARC 1.1 standard.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED_AT = "2020-01-01T00:00:00Z"

RECORDS = (
    "record_id string, record_type string, concurrent_to string, target_uri string, refers_to string, "
    "page_id long, payload_digest string, payload_bytes long, block_bytes long, headers map<string,string>, "
    "payload binary"
)


def _urn(*parts: Column) -> Column:
    """A record id that depends on content alone, so that a task run again writes the same."""
    digest = F.md5(F.concat_ws(" ", *parts).cast("binary"))
    dashes = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *dashes), F.lit(">"))


def _record(kind: str, record_id: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id]
    for name, value in fields:
        lines.append(F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"\r\n{name}: "), value)))
    length = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("\r\nContent-Length: "), length, F.lit(END), block)


def transactions(
    pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, id_col: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """One ``value`` per page: its request, response or revisit, and metadata record, without the last end.

    A null payload counts as empty, a null url leaves the target header out, a null id sorts first.
    Of equal payloads of ``revisit_bytes`` or more the largest id (then url) is the response. Rows
    equal in all three columns get equal records; ``read_records`` counts them.
    """
    page = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        # Line ends in a url would break a header.
        F.regexp_replace(F.col(url), "[\\x00-\\x20]", "%20").alias("url"),
        whole(html).alias("html"),
    ).select("*", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("bytes"))
    shared = (
        page.where(F.col("bytes") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("shared_digest"), "first")
    )
    page = page.join(
        shared, (F.col("digest") == F.col("shared_digest")) & (F.col("bytes") >= revisit_bytes), "left"
    )
    own = F.struct("page_id", "url")
    revisit = F.col("first").isNotNull() & ~own.eqNullSafe(F.col("first"))

    def capture(key: Column, uri: Column) -> Column:
        return F.concat_ws(" ", F.coalesce(key.cast("string"), F.lit("-")), F.coalesce(uri, F.lit("-")), F.col("digest"))

    mine = capture(F.col("page_id"), F.col("url"))
    exchange_id = _urn(F.lit("response"), mine)
    first_id = _urn(F.lit("response"), capture(F.col("first.page_id"), F.col("first.url")))
    uri = ("WARC-Target-URI", F.col("url"))
    date = ("WARC-Date", F.lit(CAPTURED_AT))
    to_exchange = ("WARC-Concurrent-To", exchange_id)
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    request = _record(
        "request",
        _urn(F.lit("request"), mine),
        [date, uri, to_exchange, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("/")), F.lit(" HTTP/1.1" + END)),
    )
    response = _record("response", exchange_id, [date, uri, digest, http], F.concat(head, F.col("html")))
    again = _record(
        "revisit",
        exchange_id,
        [date, uri, digest, ("WARC-Refers-To", first_id), ("WARC-Profile", F.lit(REVISIT_PROFILE)), http],
        head,
    )
    about = F.concat(
        F.when(F.col("page_id").isNull(), F.lit("")).otherwise(
            F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n"))
        ),
        F.lit("payload-bytes: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n"),
    )
    metadata = _record(
        "metadata",
        _urn(F.lit("metadata"), mine),
        [date, uri, to_exchange, ("Content-Type", F.lit("application/warc-fields"))],
        about,
    )
    between = F.lit(END)
    return page.select(
        F.concat(request, between, F.when(revisit, again).otherwise(response), between, metadata).alias("value")
    )


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write the transactions of ``pages`` as gzipped WARC files under ``folder``, any file system Spark writes to."""
    (
        transactions(pages, revisit_bytes)
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", CAPTURES_PER_FILE)
        .text(folder)
    )


def _headers(lines: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def parse(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a WARC file. Broken off in a record: ValueError."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
        lines = [line]
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise ValueError("the file ends in the headers of a record")
            lines.append(line)
        headers = _headers(b"".join(lines))
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("the file ends in the block of a record")
        yield headers, block


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    kind = headers.get("warc-type", "")
    row = {
        "record_id": headers.get("warc-record-id"),
        "record_type": kind,
        "concurrent_to": headers.get("warc-concurrent-to"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "page_id": None,
        "payload_digest": None,
        "payload_bytes": None,
        "block_bytes": len(block),
        "headers": list(headers.items()) if with_payload else [],
        "payload": None,
    }
    if kind == "response":
        payload = memoryview(block)[block.index(b"\r\n\r\n") + 4 :]
        row["payload_digest"] = hashlib.sha1(payload).hexdigest()
        row["payload_bytes"] = len(payload)
        if headers.get("warc-payload-digest") not in (None, "sha1:" + row["payload_digest"]):
            raise ValueError(f"payload of {row['record_id']} does not match its digest")
        if with_payload:
            row["payload"] = bytes(payload)
    elif kind == "revisit":
        row["payload_digest"] = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    elif kind == "metadata":
        fields = _headers(b"\r\n" + block)
        row["page_id"] = int(fields["page-id"]) if "page-id" in fields else None
    return row


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the WARC files under ``folder`` (``RECORDS``).

    Digest and length of a response are taken from the bytes read; a digest that differs from the
    header's is an error. ``with_payload=False`` leaves the bytes and headers behind in the task.
    """
    schema = pa.schema(
        [
            *[pa.field(name, pa.string()) for name in ("record_id", "record_type", "concurrent_to", "target_uri", "refers_to")],
            pa.field("page_id", pa.int64()),
            pa.field("payload_digest", pa.string()),
            pa.field("payload_bytes", pa.int64()),
            pa.field("block_bytes", pa.int64()),
            pa.field("headers", pa.map_(pa.string(), pa.string())),
            pa.field("payload", pa.binary()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_buffer()
                stream = pa.BufferReader(raw)
                opened = gzip.open(stream) if raw.slice(0, 2).to_pybytes() == b"\x1f\x8b" else stream
                rows, held = [], 0
                for headers, block in parse(io.BufferedReader(opened, 1 << 20)):
                    rows.append(_row(headers, block, with_payload))
                    held += len(block) if with_payload else 512
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(folder).select("content")
    return files.mapInArrow(cut, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``exchange`` (response or revisit), ``request``, ``metadata``, ``first``.

    ``first`` is the response that holds the payload: a revisit's is the one it refers to, a response's
    itself. A record that is not in the archive leaves its part null. Records equal in id are copies of
    one; a capture written n times gives n rows. ``records`` is read three times: stage it.
    """
    parts = [name for name in records.columns if name != "record_id"]
    # Combined before the shuffle: however often a record was written, one row per task remains.
    once = records.groupBy("record_id").agg(
        F.max_by(F.struct(*parts), F.col("block_bytes")).alias("part"), F.count("*").alias("copies")
    )

    def of(*kinds: str) -> DataFrame:
        return once.where(F.col("part.record_type").isin(*kinds))

    request = of("request").select(
        F.col("part.concurrent_to").alias("capture"),
        F.struct(F.col("record_id").alias("id"), F.col("part.target_uri").alias("target_uri")).alias("request"),
    )
    metadata = of("metadata").select(
        F.col("part.concurrent_to").alias("capture"),
        F.struct(F.col("record_id").alias("id"), F.col("part.page_id").alias("page_id")).alias("metadata"),
    )
    captures = (
        of("response", "revisit")
        .select(F.col("record_id").alias("capture"), F.col("part").alias("exchange"), "copies")
        .join(request, "capture", "left")
        .join(metadata, "capture", "left")
    )
    firsts = (
        of("response")
        .select(F.col("record_id").alias("capture"), "part.payload_digest", "part.payload_bytes")
        .join(metadata, "capture", "left")
        .select(
            F.struct(
                F.col("capture").alias("id"),
                F.col("metadata.page_id").alias("page_id"),
                "payload_digest",
                "payload_bytes",
            ).alias("first")
        )
    )
    # A third of all captures may refer to one response; they are on the side of the join that Spark splits.
    wanted = F.coalesce(F.col("exchange.refers_to"), F.col("capture"))
    return captures.join(firsts, wanted == F.col("first.id"), "left").select(
        F.col("capture").alias("record_id"),
        "exchange",
        "request",
        "metadata",
        "first",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
