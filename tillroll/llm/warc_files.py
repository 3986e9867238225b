"""Reading of WARC files as crawlers write them.

Files may be WARC/1.0 or 1.1, plain or compressed (one gzip member a record, or one in all), with any
record ids and with bodies of any bytes. Spark's text source cuts them at ``WARC/1.`` and keeps the bytes
between; cuts inside a record, where a payload quotes the version line, are mended by the declared
Content-Length. A compressed file is read by one task in order; a plain one may be cut into splits, and a record
that lies across a split's end with a quoted version line in it can't be put together: it has ``complete``
false, as has a record that ends early. ``strict`` makes such a record an error.

Every record is a row: an empty file has none, repeated records are rows of their own, and a header that a record lacks is
null. Of repeated headers the first counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import small_batches
from .warc import header_map

MARK = b"WARC/1."
_BEGIN = re.compile(rb"[01]\r?\n")
_END = re.compile(rb"\r?\n\r?\n")
_STATUS = re.compile(rb"HTTP/[0-9.]+ ([0-9]{3})")
#: Header fields that become columns.
FIELDS = {
    "warc_type": b"warc-type",
    "record_id": b"warc-record-id",
    "url": b"warc-target-uri",
    "date": b"warc-date",
    "profile": b"warc-profile",
    "refers_to_id": b"warc-refers-to",
    "refers_to_url": b"warc-refers-to-target-uri",
    "refers_to_date": b"warc-refers-to-date",
    "content_type": b"content-type",
}
_SCHEMA = (
    ", ".join(f"{name} string" for name in FIELDS)
    + ", version string, status int, http_head string, body binary, complete boolean"
)


def _fields(head: bytes) -> dict[bytes, bytes]:
    """Header fields by name in small letters; folded lines belong to the line before."""
    found: dict[bytes, bytes] = {}
    for line in re.sub(rb"\r?\n[ \t]+", b" ", head).splitlines():
        name, colon, value = line.partition(b":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


class _Record:
    """A record that is being put together from pieces."""

    def __init__(self, piece: bytes):
        self.data = bytearray(piece)
        self._measure()

    def _measure(self) -> None:
        self.fields, self.need, self.begin = {}, None, None
        if end := _END.search(self.data):
            self.fields, self.begin = _fields(bytes(self.data[: end.start()])), end.end()
            length = self.fields.get(b"content-length", b"")
            self.need = self.begin + (int(length) if length.isdigit() else 0)

    def full(self) -> bool:
        return self.need is not None and len(self.data) >= self.need

    def add(self, piece: bytes) -> None:
        self.data += MARK + piece
        if self.need is None:
            self._measure()

    def row(self) -> dict:
        row = {}
        for name, field in FIELDS.items():
            value = self.fields.get(field)
            row[name] = None if value is None else value.decode("utf-8", "replace")
        for name in ("record_id", "refers_to_id", "url"):
            if row[name] is not None:
                row[name] = row[name].removeprefix("<").removesuffix(">")
        payload = bytes(self.data[self.begin : self.need]) if self.begin else b""
        head, status = None, None
        if (row["content_type"] or "").startswith("application/http"):
            end = _END.search(payload)
            first, payload = (payload[: end.start()], payload[end.end() :]) if end else (payload, b"")
            head = first.decode("latin-1")
            if found := _STATUS.match(first):
                status = int(found[1])
        version = f"WARC/1.{chr(self.data[0])}" if _BEGIN.match(self.data) else None
        return row | {"version": version, "status": status, "http_head": head, "body": payload, "complete": self.full()}


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    record, file = None, None
    for batch in batches:
        for piece, path in zip(batch.column("piece").to_pylist(), batch.column("file").to_pylist()):
            if path != file and record:
                yield record.row()
                record = None
            file = path
            if record and not record.full():
                record.add(piece)
                continue
            if record:
                yield record.row()
                record = None
            if piece.strip():
                record = _Record(piece)
    if record:
        yield record.row()


def read_warc(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    """The records of WARC files: the fields of ``FIELDS``, ``version``, HTTP ``status``, ``http_head``, ``headers`` and ``body``
    (for other contents the whole payload), ``captured`` as a timestamp and ``complete``."""
    pieces = spark.read.option("lineSep", MARK.decode()).text(path).select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in _records(batches):
            held.append(row)
            size += len(row["body"])
            if size > 1 << 24 or len(held) >= 1000:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    rows = small_batches(pieces).mapInArrow(run, _SCHEMA)
    when = F.coalesce(
        F.try_to_timestamp("date", F.lit("yyyy-MM-dd'T'HH:mm:ssX")),
        F.try_to_timestamp("date", F.lit("yyyy-MM-dd'T'HH:mm:ss.[SSSSSSSSS][SSSSSS][SSS]X")),
    )
    found = rows.withColumns({"captured": when, "headers": header_map(F.col("http_head"))})
    if strict:
        wrong = F.concat(F.lit("incomplete WARC record "), F.coalesce("record_id", F.lit("without id")))
        sure = F.when(F.col("complete"), True).otherwise(F.raise_error(wrong).cast("boolean"))
        found = found.withColumn("complete", sure)
    return found


_ARROW = pa.schema(
    [
        *((name, pa.string()) for name in (*FIELDS, "version")),
        ("status", pa.int32()),
        ("http_head", pa.string()),
        ("body", pa.binary()),
        ("complete", pa.bool_()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)
