"""WARC archives: one gzip member per record, written and read by Spark tasks.

``write`` makes a record of every page. Of pages with equal payloads of at least ``least_bytes`` bytes the one with
the smallest id is a response, the others are revisits that name it and carry no payload. The bytes go
through Spark's file writer, so archives appear only when their task has committed and work on every store:
a row is a gzip member without its last byte, and the writer's line separator is that byte. A
member ends with the record's length, lowest byte first, so its last byte is zero for records below 16 MiB; a
longer record is followed by an empty member, whose last byte is zero too.

``read`` walks through each archive once: members are decompressed in chunks as they come, a record ends
where its content length says, and its digests are checked. A damaged archive gives the records before
the damage and one row with ``error``.

Edge cases: NULL html is an empty payload; NULL urls are written as ``about:blank``; a NULL page id is chosen as
response only if all ids of the payload are NULL, and is read back as NULL; of rows with equal ids and payloads one is
the response; an empty table gives no record; other columns are ignored. An archive is bounded by records and bytes
and is read by one task.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

LEAST_BYTES = 100
_EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
_CHUNK = 64 * 1024
FIELDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, archive string, error string"


# --- writing --------------------------------------------------------------------------------------


def choose_records(pages: DataFrame, least_bytes: int = LEAST_BYTES, broadcast_rows: int = 1_000_000) -> DataFrame:
    """page_id, url, payload, digest, refers_to, is_revisit of (page_id, url, html).

    What to write is decided on digests and ids alone: counts and smallest ids per digest, for digests that occur twice.
    They are broadcast if there are at most ``broadcast_rows`` of them, counted first; beyond that payloads are shuffled
    once, by digest, where a frequent one can be split. Only pages that repeat an id with its payload are looked at again.
    """
    rows = pages.select(
        "page_id", F.coalesce("url", F.lit("about:blank")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= least_bytes
    repeated = stored(
        rows.where(long_enough)
        .groupBy("digest", "page_id")
        .agg(F.count("*").alias("n"))
        .groupBy("digest")
        .agg(F.sum("n").alias("n"), F.min("page_id").alias("first_id"), F.min_by("n", F.coalesce("page_id", F.lit(2**63 - 1))).alias("n_first"))
        .where("n > 1")
        .select(F.col("digest").alias("_digest"), "first_id", "n_first"),
        "repeated",
    )
    small = repeated.limit(broadcast_rows + 1).count() <= broadcast_rows
    known = F.broadcast(repeated) if small else repeated
    met = rows.join(known, (F.col("digest") == F.col("_digest")) & long_enough, "left")
    of_first = F.col("page_id").eqNullSafe(F.col("first_id"))
    out = met.withColumn("is_revisit", F.col("_digest").isNotNull() & ~of_first)
    several = repeated.where("n_first > 1")
    if not several.isEmpty():
        # rows with the first id and the same payload are told apart by url alone; one of each digest is the response
        out = out.where(F.col("_digest").isNull() | ~of_first | (F.col("n_first") == 1))
        same = rows.where(long_enough).join(several, (F.col("digest") == F.col("_digest")) & of_first)
        alike = same.groupBy("page_id", "url", "digest", "_digest", "first_id", "n_first").agg(
            F.any_value("payload").alias("payload"), F.count("*").alias("copies")
        )
        order = Window.partitionBy("digest").orderBy("url")
        alike = alike.withColumn("place", F.row_number().over(order)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        out = out.unionByName(alike.withColumn("is_revisit", (F.col("place") > 1) | (F.col("copy") > 1)).drop("copies", "place", "copy"))
    return out.select(
        "page_id", "url", "payload", "digest", F.when(F.col("is_revisit"), F.col("first_id")).alias("refers_to"), "is_revisit"
    )


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "none" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {_header(url)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{'none' if refers_to is None else refers_to}>",
        ]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _header(value: str) -> str:
    """A header value on one line; line breaks are percent-encoded, as in any URI."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def member_of(record: bytes) -> bytes:
    """A gzip member that ends with a zero byte; see the module text."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(record) + packer.flush()
    return member if member[-1] == 0 else member + _EMPTY_MEMBER


def _members(archive_bytes: int):
    """Rows as gzip members without their last byte, and the number of the archive within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        volume, size = 0, 0
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for at in range(0, batch.num_rows, 256):
                values, volumes = [], []
                for row in zip(*(c.slice(at, 256).to_pylist() for c in columns), strict=True):
                    member = member_of(record_bytes(*row))[:-1]
                    if size and size + len(member) > archive_bytes:
                        volume, size = volume + 1, 0
                    size += len(member) + 1
                    values.append(member)
                    volumes.append(volume)
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array(volumes, pa.int32())], names=["value", "volume"])

    return run


def write(
    pages: DataFrame, path: str, records_per_file: int = 2000, least_bytes: int = LEAST_BYTES, archive_bytes: int = 64 * 1024 * 1024
) -> None:
    """Archives of all ``pages`` (page_id, url, html) under ``path``.

    An archive has at most ``records_per_file`` records and ``archive_bytes`` bytes, or a single record.
    """
    members = choose_records(pages, least_bytes).mapInArrow(_members(archive_bytes), "value binary, volume int")
    # the writer takes the bytes of a string as they are
    members.select(F.col("value").cast("string").alias("value"), "volume").write.option("lineSep", "\0").option(
        "maxRecordsPerFile", records_per_file
    ).partitionBy("volume").text(path)


# --- reading --------------------------------------------------------------------------------------


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, decompressing chunk by chunk.

    Raises ValueError where the archive is damaged.
    """
    data, at = memoryview(content), 0
    while at < len(data):
        unpacker, parts = zlib.decompressobj(31), []
        try:
            while not unpacker.eof:
                if at >= len(data):
                    raise ValueError("the archive ends inside a member")
                chunk = data[at : at + _CHUNK]
                parts.append(unpacker.decompress(chunk))
                at += len(chunk) - len(unpacker.unused_data)
        except zlib.error as error:
            raise ValueError(f"not a gzip member: {error}") from error
        if record := b"".join(parts):
            yield _framed(record)


def _framed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise ValueError("no record header")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    if not headers.get("content-length", "").isdigit():
        raise ValueError("no content length")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("the content length does not fit the record")
    return headers, rest[:length]


def _digest(data: bytes, kind: str) -> str:
    if kind == "sha256":
        return hashlib.sha256(data).hexdigest()
    if kind == "sha1":  # as most archives have it
        return base64.b32encode(hashlib.sha1(data).digest()).decode()
    raise ValueError(f"unknown digest {kind}")


def checked(headers: dict[str, str], block: bytes) -> dict[str, object]:
    """The fields of a record. Raises ValueError if a digest does not fit."""
    if "warc-block-digest" in headers:
        kind, _, value = headers["warc-block-digest"].partition(":")
        if _digest(block, kind) != value:
            raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, _, value = headers["warc-payload-digest"].partition(":")
    revisit = headers["warc-type"] == "revisit"
    lengths = [line[15:].strip() for line in http.split(b"\r\n") if line[:15].lower() == b"content-length:"]
    if not revisit and _digest(payload, kind) != value:
        raise ValueError("payload digest differs")
    size = int(lengths[0]) if lengths else len(payload)
    if not revisit and size != len(payload):
        raise ValueError("payload length differs")
    return {
        "page_id": _page_of(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "record_type": headers["warc-type"],
        "payload_bytes": size,
        "payload_digest": value,
        "refers_to": _page_of(headers["warc-refers-to"]) if revisit else None,
        "payload": None if revisit else payload,
        "error": None,
    }


def _page_of(name: str) -> int | None:
    value = name.strip("<>").rpartition(":")[2]
    return None if value == "none" else int(value)


_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("archive", pa.string()), ("error", pa.string())]
)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            archive, content, rows, size = batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), [], 0
            walk = records(content)
            while True:
                try:
                    headers, block = next(walk)
                    row = checked(headers, block)
                except StopIteration:
                    break
                except (ValueError, KeyError) as error:
                    rows.append({"archive": archive, "error": str(error) or type(error).__name__})
                    break
                rows.append(row | {"archive": archive})
                size += len(block)
                if size > 8_000_000:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``, with ``FIELDS`` as columns."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read_batches, FIELDS)
