"""WARC archives through a chunked record table.

A payload becomes rows (row, chunk number, data, bytes so far, SHA-1 so far): no row
holds more than `chunk` bytes, or three more where a character would be cut. An Arrow
generator cuts each payload once, from a view of its bytes, with running digests; the
chunk rows are written as a table, and only they move from then on. The last row of
each payload gives its length and digests, from which the plan of records is made
without any payload. The plan's row of a record sorts in front of its chunks and a
running window hands its fields down, so that the record's lines leave a task in
order and a task holds no payload: the window spills. The first chunk becomes a
`response` record, the others `continuation` records that name it, as the format's
segmentation asks; a payload that an earlier record has becomes a `revisit` without a
payload. Spark's text writer commits the files, so a lost executor leaves nothing
half-written. Files are compressed and not split when read, so a file's lines arrive
in order.

Reading follows the lines as a stream and hands out payloads piece by piece: it
buffers at most PIECE bytes and a line, whatever a record's length, and yields rows
(record, chunk number, size, data, digest so far). The SHA-1 runs along, over the
segments of a record too, which follow each other in a file; the row that ends a
record is marked as last and has the digest of the whole payload, which must be the
one that the record names.

Equal payloads: those of the same SHA-256 and length. Of equal payloads of at least
`least` bytes the largest id is the response, the others revisit it. Defined
results: a null payload counts as empty. Rows that share an id and a payload are
one record and give a result row each; rows that share an id with different
payloads are different records. A null id is a record named `none`, and is a
response only where no equal payload has an id. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlspike.session import scratch_path

CHUNK = 1 << 16  # bytes of a payload in one record
PIECE = 1 << 16  # bytes that the reader hands out at once
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
CHUNKS = "row long, id long, url string, chunk long, data binary, size long, digest string, sha string, last boolean"
COLUMNS = (
    "record string, id long, kind string, refers long, payload_bytes long, "
    "chunk long, size long, data binary, digest string, last boolean"
)


def arrow_schema(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])


def pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def pieces(raw: memoryview, chunk: int) -> Iterator[memoryview]:
    """raw in parts of chunk bytes that end where a UTF-8 character ends; one empty part for nothing."""
    start, size = 0, len(raw)
    while True:
        end = min(start + chunk, size)
        while end < size and raw[end] & 0xC0 == 0x80:
            end += 1
        yield raw[start:end]
        start = end
        if start >= size:
            return


def cut(pages: DataFrame, key: str, payload: str, url: str | None, chunk: int) -> DataFrame:
    """The chunked record table of pages (see CHUNKS): size and digest run along, sha is
    the SHA-256 of the whole payload and stands in its last row only."""
    schema = arrow_schema(CHUNKS)

    def run(batches):
        for batch in batches:
            out, held = [], 0
            for row, own, target, body in zip(*(batch.column(i) for i in range(4))):
                row, own, target = row.as_py(), own.as_py(), target.as_py()
                raw = memoryview(body.as_buffer() if body.is_valid else b"")
                sha1, sha256, size = hashlib.sha1(), hashlib.sha256(), 0
                for number, part in enumerate(pieces(raw, chunk)):
                    sha1.update(part)
                    sha256.update(part)
                    size += len(part)
                    last = size == len(raw)
                    digest = base64.b32encode(sha1.copy().digest()).decode()
                    whole = sha256.hexdigest() if last else None
                    out.append((row, own, target, number, bytes(part), size, digest, whole, last))
                    held += 200 + len(part)
                    if held > 4_000_000:
                        yield pack(out, schema)
                        out, held = [], 0
            if out:
                yield pack(out, schema)

    target = F.col(url) if url else F.lit(None)
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        target.cast("string").alias("url"),
        F.col(payload).cast("string").alias("body"),
    )
    return rows.mapInArrow(run, CHUNKS)


def name(key: Column, sha: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(":"), F.substring(sha, 1, 16), F.lit(">"))


def plan_records(chunks: DataFrame, least: int) -> DataFrame:
    """(row, id, url, sha, bytes, digest, count, refers) for each payload; count: of its
    chunks; refers: the id of the response, null for responses."""
    ends = chunks.filter("last").select(
        "row", "id", "url", "sha", F.col("size").alias("bytes"), "digest", (F.col("chunk") + 1).alias("count")
    )
    first = ends.filter(F.col("bytes") >= least).groupBy("sha", "bytes").agg(F.max("id").alias("first"))
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers")
    return ends.join(first, ["sha", "bytes"], "left").select(*ends.columns, refers)


def records(chunks: DataFrame, least: int) -> DataFrame:
    """(value): each WARC record as a text whose last line end is left to the writer."""
    plan = plan_records(chunks, least)
    fields = F.struct(*[c for c in plan.columns if c != "row"])
    heads = plan.select("row", F.lit(-1).cast("long").alias("chunk"), F.lit(None).cast("binary").alias("data"), fields.alias("head"))
    parts = chunks.select("row", "chunk", "data", F.lit(None).cast(heads.schema["head"].dataType).alias("head"))
    along = Window.partitionBy("row").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = heads.unionByName(parts).withColumn("head", F.first("head").over(along))
    rows = rows.filter((F.col("chunk") == 0) | ((F.col("chunk") > 0) & F.col("head.refers").isNull()))
    rows = rows.select("chunk", F.col("data").cast("string").alias("part"), "head.*")
    rows = rows.withColumn("own", name(F.col("id"), F.col("sha")))

    first, visit = F.col("chunk") == 0, F.col("refers").isNotNull()
    several = (F.col("count") > 1) & ~visit
    segment = F.col("chunk") + 1
    part = F.when(visit, F.lit("")).otherwise(F.col("part"))
    block = F.concat(F.when(first, F.lit(HTTP)).otherwise(F.lit("")), part)
    later = F.concat(F.expr("substring(own, 1, length(own) - 1)"), F.lit("/"), segment.cast("string"), F.lit(">"))

    def line(label: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{label}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    kind = F.when(visit, "revisit").when(first, "response").otherwise("continuation")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.when(first, F.col("own")).otherwise(later)),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "_")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(visit, name(F.col("refers"), F.col("sha")))),
        line("WARC-Profile", F.when(visit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Segment-Number", F.when(several, segment)),
        line("WARC-Segment-Origin-ID", F.when(several & ~first, F.col("own"))),
        line("WARC-Segment-Total-Length", F.when(several & (segment == F.col("count")), F.col("bytes") + len(HTTP))),
        line("Payload-Length", F.col("bytes")),
        line("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        line("Content-Length", F.octet_length("block")),
        F.lit("\r\n"),
    )
    return rows.withColumn("block", block).select(F.concat(head, F.col("block"), F.lit("\r\n\r")).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    payload: str = "html",
    url: str | None = "url",
    least: int = 0,
    chunk: int = CHUNK,
) -> None:
    """Write a record, or several segments, for each row of pages into archives under path."""
    spark = pages.sparkSession
    table = scratch_path(spark, "chunks")
    cut(pages, key, payload, url, chunk).write.option("compression", "zstd").parquet(table)
    chunks = spark.read.schema(CHUNKS.replace(" long", " bigint")).parquet(table)
    records(chunks, least).write.option("lineSep", "\n").option("compression", "gzip").text(path)


class Parser:
    """Follows the lines of archives; yields payload pieces with the digest so far."""

    def __init__(self, piece: int = PIECE):
        self.piece = piece
        self.between, self.record, self.open = True, None, False

    def line(self, raw: bytes) -> Iterator[tuple]:
        """The rows that a line, given without its newline, completes."""
        if self.between:
            if raw.startswith(b"WARC/"):
                self.between, self.fields, self.left = False, {}, None
        elif self.left is None:
            text = raw.rstrip(b"\r")
            if text:
                label, _, value = text.partition(b":")
                self.fields[label.strip().lower().decode()] = value.strip().decode()
            else:
                yield from self.begin()
        else:
            data = (raw + b"\n")[: self.left]
            self.left -= len(data)
            if self.in_http:
                self.in_http = data != b"\r\n"
            else:
                yield from self.payload(data)
            if not self.left:
                yield from self.end()

    def begin(self) -> Iterator[tuple]:
        fields = self.fields
        self.left = int(fields["content-length"])
        segment = int(fields.get("warc-segment-number", 1))
        if segment == 1:
            self.record, self.kind = fields["warc-record-id"], fields["warc-type"]
            self.sha, self.buffer, self.chunk, self.size = hashlib.sha1(), bytearray(), 0, 0
        elif fields["warc-segment-origin-id"] != self.record or segment != self.segment + 1:
            raise ValueError(f"segment {segment} of {fields['warc-segment-origin-id']} is out of order")
        self.segment, self.in_http = segment, segment == 1
        self.complete = "warc-segment-number" not in fields or "warc-segment-total-length" in fields
        if not self.left:
            yield from self.end()

    def payload(self, data: bytes) -> Iterator[tuple]:
        view = memoryview(data)
        while len(view):
            if len(self.buffer) == self.piece:
                yield self.row(False)
            room = self.piece - len(self.buffer)
            self.buffer += view[:room]
            view = view[room:]

    def end(self) -> Iterator[tuple]:
        self.between = True
        if self.complete:
            yield self.row(True)

    def row(self, last: bool) -> tuple:
        data = bytes(self.buffer)
        self.buffer.clear()
        self.sha.update(data)
        self.size += len(data)
        digest = base64.b32encode(self.sha.copy().digest()).decode()
        declared, size = self.fields["warc-payload-digest"].partition(":")[2], int(self.fields["payload-length"])
        refers = None
        if self.kind == "revisit":
            digest, refers = declared, self.number(self.fields["warc-refers-to"])
        elif last and (digest, self.size) != (declared, size):
            raise ValueError(f"{self.record}: {self.size} bytes, {digest}; {size} and {declared} declared")
        self.chunk += 1
        return (
            self.record, self.number(self.record), self.kind, refers, size,
            self.chunk - 1, len(data), data, digest, last,
        )

    @staticmethod
    def number(record: str) -> int | None:
        text = record.split(":")[2]
        return None if text == "none" else int(text)


def chunk_table(spark: SparkSession, path: str, piece: int = PIECE, data: bool = True) -> DataFrame:
    """The archives under path as rows of chunks (see COLUMNS); data: whether rows
    carry their bytes besides sizes and digests."""
    lines = spark.read.option("lineSep", "\n").text(path)
    schema = arrow_schema(COLUMNS)
    blank = schema.get_field_index("data")

    def run(batches):
        parser = Parser(piece)
        for batch in batches:
            out, held = [], 0
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                for row in parser.line(raw):
                    out.append(row if data else (*row[:blank], None, *row[blank + 1 :]))
                    held += 200 + row[6] * data
                if held > 4_000_000:
                    yield pack(out, schema)
                    out, held = [], 0
            if out:
                yield pack(out, schema)

    return lines.mapInArrow(run, COLUMNS)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    whole = chunk_table(spark, path, data=False).filter("last")
    return whole.select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
    )


OP6_WARC = """
WITH payload AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(sha, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payload
"""

QUERIES = {"op6_warc": (op6_warc, OP6_WARC)}
