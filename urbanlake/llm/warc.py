"""WARC archives: writing captures and assembling transactions again.

A page becomes three records: its request, a response (or a revisit, when an
earlier page already archived the same payload) and metadata.  Request and
metadata name the response by ``WARC-Concurrent-To``.  Reading parses the
archives record by record and joins what belongs to one capture through those
identifiers into one nested row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm.common import written

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads from this size on are archived once.
LEAST_BYTES = 100
#: Records and payload bytes in one archive file, which the reader takes as a
#: whole (a longer payload has a file of its own).
FILE_RECORDS, FILE_BYTES = 6000, 32 << 20
#: Payload sizes up to which pages share files; those beyond are alone.
SIZES = (16 << 10, 256 << 10, 4 << 20)

RECORD = (
    "type string, record_id string, concurrent_to string, page_id long, refers_to long, target_uri string,"
    " payload_bytes long, payload_digest string, intact boolean, block binary"
)


def _header(*fields: tuple[str, Column | str]) -> Column:
    """A WARC header; fields whose value is null are left out."""
    lines = [F.lit("WARC/1.1" + CRLF)]
    for name, value in fields:
        value = F.lit(value) if isinstance(value, str) else value.cast("string")
        # a line break inside a value would end the field
        value = F.regexp_replace(value, "[\r\n]+", "%0D%0A")
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    return F.concat(*lines, F.lit(CRLF))


def _record(block: Column, *fields: tuple[str, Column | str]) -> Column:
    return F.concat(_header(*fields, ("Content-Length", F.octet_length(block))), block)


def _urn(kind: str, run: str, row: Column) -> Column:
    digest = F.md5(F.concat(F.lit(f"{run}/{kind}/"), row.cast("string")))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES, date: str | None = None,
) -> None:
    """Write one transaction per page as gzip-compressed WARC 1.1 files.

    Pages are written by classes of size, and a file takes as many of a class
    as keep within ``file_bytes`` (and ``file_records``); beyond the largest
    class a page has a file of its own.  ``date`` is the capture date in the
    records, now if not given.

    The payload is the html in UTF-8, null as empty.  Of rows with equal
    payloads of at least ``LEAST_BYTES`` bytes, every row with the smallest id
    (there are several only if rows repeat) is a response, the others revisit
    it; rows with a null id never come first.  Smaller payloads are always
    responses.  A null url leaves out the target, line breaks in it are
    escaped.  Other columns are not read.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha2(payload, 256).alias("digest"),
    )
    shared = rows.where(F.col("bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # written first: its size is then known when the join is planned
    shared = written(shared.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-shared")
    run = uuid.uuid4().hex
    linked = rows.join(shared, "digest", "left").withColumn("row", F.monotonically_increasing_id())
    linked = linked.withColumn("revisit", F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    uri, date, page = ("WARC-Target-URI", F.col("url")), ("WARC-Date", date), ("X-Page-Id", F.col("page_id"))
    # each class is a scan of its own: row numbers are told apart by it
    size = F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))
    level = F.lit(0)
    for most in SIZES:
        level = level + (size > most).cast("int")
    linked = linked.withColumn("level", level)
    row = F.concat_ws("/", "level", "row")
    main, revisit = _urn("response", run, row), F.col("revisit")
    response = _record(
        F.concat(http, F.when(revisit, "").otherwise(F.col("payload"))),
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", main), date, uri, page,
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", F.when(revisit, PROFILE)),
        ("X-Refers-To-Page-Id", F.when(revisit, F.col("first"))),
        ("Content-Type", "application/http; msgtype=response"),
    )
    request = _record(
        F.lit(f"GET / HTTP/1.1{CRLF}Accept: text/html{CRLF * 2}"),
        ("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", run, row)), ("WARC-Concurrent-To", main), date, uri, page,
        ("Content-Type", "application/http; msgtype=request"),
    )
    metadata = _record(
        F.concat(F.lit("payload-length: "), F.col("bytes").cast("string"), F.lit(CRLF)),
        ("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", run, row)), ("WARC-Concurrent-To", main), date, uri, page,
        ("Content-Type", "application/warc-fields"),
    )
    records = linked.select("level", F.explode(F.array(request, response, metadata)).alias("value"))
    # the line separator of the text writer is the end of a WARC record
    for i, most in enumerate([*SIZES, None]):
        captures = max(1, min(file_records // 3, file_bytes // most)) if most else 1
        writer = records.where(F.col("level") == i).select("value").write.mode("append")
        writer.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", 3 * captures).text(path)


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of an uncompressed archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        header = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode("utf-8", "replace").partition(":")
            header[name.lower()] = value.strip()
        yield header, stream.read(int(header["content-length"]))


def read_records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``.  Digest and size of a
    response are taken from its payload, and ``intact`` tells whether the
    header's digest agrees; those of a revisit are its headers'.  ``blocks``
    False leaves the blocks out."""

    def body(batches: Iterator) -> Iterator:
        import gzip
        import hashlib
        import io

        import pyarrow as pa

        schema = pa.schema(
            [("type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("page_id", pa.int64())]
            + [("refers_to", pa.int64()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
            + [("intact", pa.bool_()), ("block", pa.binary())]
        )
        number = lambda x: int(x) if x is not None else None
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for header, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    kind, size, digest, intact = header.get("warc-type"), None, None, True
                    if kind in ("response", "revisit"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        digest = header.get("warc-payload-digest", "").removeprefix("sha256:")
                        if kind == "response":
                            size, found = len(payload), hashlib.sha256(payload).hexdigest()
                            digest, intact = found, found == digest
                        else:
                            lengths = [x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                            size = int(lengths[0]) if lengths else None
                    rows.append(
                        (
                            kind, header.get("warc-record-id"), header.get("warc-concurrent-to"), number(header.get("x-page-id")),
                            number(header.get("x-refers-to-page-id")), header.get("warc-target-uri"), size, digest, intact,
                            block if blocks else None,
                        )
                    )
                    held += len(block) * blocks
                    if len(rows) >= 10_000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content").mapInArrow(body, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (the response's record id),
    ``response`` (null if the archives lack it), ``requests`` and ``metadata``
    (arrays).  A record that names no other stands for its own capture."""
    whole = F.struct(*records.columns)
    by = records.withColumn("capture", F.coalesce("concurrent_to", "record_id"))
    pick = lambda *kinds: F.when(F.col("type").isin(*kinds), whole)
    return by.groupBy("capture").agg(
        F.first(pick("response", "revisit"), ignorenulls=True).alias("response"),
        F.collect_list(pick("request")).alias("requests"),
        F.collect_list(pick("metadata")).alias("metadata"),
    )
