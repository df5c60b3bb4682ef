"""WARC archives: writing, reading, and resolving repeated payloads to revisit records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.llm.tables import table
from cohorts.session import materialize, materialize_with, new_path

# Bytes of payload that a file of an archive is planned for.
FILE_BYTES = 24 << 20
# Tables of repeated records of up to so many rows are broadcast (under 100 bytes each); larger ones are joined by shuffle.
BROADCAST_ROWS = 50_000

# The profile of revisits with identical payload, and the name space of record ids.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2026-01-01T00:00:00Z"

DIGEST = "struct<payload_bytes:bigint, payload_digest:string, record_uuid:string>"
RECORD = (
    "record_id string, record_type string, refers_to string, target_uri string, payload_bytes bigint, "
    "payload_digest string, payload string, page_id bigint, block_digest string, block_bytes bigint"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")  # noqa: S324  the digest that archives use


def digest_column():
    @F.arrow_udf(DIGEST)
    def digests(ids: pa.Array, payloads: pa.Array) -> pa.Array:
        sizes, found, names = [], [], []
        for key, payload in zip(ids.to_pylist(), payloads, strict=True):
            raw = payload.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            sizes.append(len(raw))
            found.append(payload_digest(raw))
            names.append(str(uuid.uuid5(NAMES, f"{key}:{found[-1]}")))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(found, pa.string()), pa.array(names, pa.string())],
            ["payload_bytes", "payload_digest", "record_uuid"],
        )

    return digests


def resolve_revisits(headers: DataFrame, id_col: str = "page_id", min_bytes: int = 0) -> tuple[DataFrame, int]:
    """``(id, payload_digest, refers_to, refers_uuid)`` of every record that repeats another's payload; how many there are.

    ``headers`` holds a row per record: id, ``payload_digest``, ``payload_bytes``, ``record_uuid``. Of
    records with one digest and at least ``min_bytes`` bytes, that with the largest id is the
    original, and the rest are in the result. Headers are shuffled by digest, combined on the map side; only digests with
    several records are joined back. Rows that agree in id and digest are one record; null ids come last and are never the original of others.
    """
    heads = headers.where(F.col("payload_bytes") >= min_bytes)
    first = F.max(F.struct(col(id_col).alias("id"), F.col("record_uuid"))).alias("top")
    lowest = F.min(col(id_col)).alias("low")
    nulls = F.count(F.when(col(id_col).isNull(), 1)).alias("nulls")
    groups = heads.groupBy("payload_digest").agg(first, lowest, nulls)
    groups = groups.where((F.col("low") < F.col("top.id")) | (F.col("nulls") > 0) & F.col("top.id").isNotNull())
    originals = materialize(groups.select("payload_digest", F.col("top.id").alias("refers_to"), F.col("top.record_uuid").alias("refers_uuid")), "originals")
    repeats = heads.select(col(id_col).alias("_id"), "payload_digest").distinct().join(originals, "payload_digest")
    repeats = repeats.where(F.col("_id").isNull() | (F.col("_id") < F.col("refers_to")))
    out, facts = materialize_with(repeats, "revisits", n="count(1)")
    return out, facts["n"]


def record_text(
    kind: Column, name: Column, uri: Column, id_text: Column, digest: Column, size: Column, refers_uuid: Column, refers_to: Column, payload: Column
) -> Column:
    """A record from its version line to the end of its block, as text; a revisit's block is empty."""
    line = lambda label, value: F.concat(F.lit(f"{label}: "), value, F.lit("\r\n"))
    is_revisit = kind == "revisit"
    block = F.when(is_revisit, F.lit("")).otherwise(payload)
    clean = F.regexp_replace(F.coalesce(uri, F.lit("")), r"[\r\n]+", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), name, F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(is_revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        F.when(is_revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), refers_uuid, F.lit(">")))).otherwise(F.lit("")),
        F.when(is_revisit, line("X-Refers-To-Page", refers_to.cast("string"))).otherwise(F.lit("")),
        F.when(id_text.isNotNull(), line("X-Page-ID", id_text)).otherwise(F.lit("")),
        line("X-Payload-Length", size.cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
    file_bytes: int = FILE_BYTES, broadcast_rows: int = BROADCAST_ROWS,
) -> str:
    """Write a record for every row of ``pages`` to gzip-compressed archives in ``path``.

    A first pass takes digests; the narrow headers decide which records repeat a payload, and the
    second pass writes: originals as responses with their payload, repeats as revisits with fresh headers
    that name the original. Payloads are not shuffled while repeats are few enough to broadcast. Files
    go through Spark's own writer, so retried tasks leave no halves. A file
    holds about ``file_bytes`` of payload, whatever the table's size.

    Null payloads are empty; a null url is an empty target. Ids may be null or repeated; rows that agree in id and payload are records of one kind.
    """
    own = pages.select(col(id_col).alias("_id"), col(url_col).alias("_url"), F.coalesce(col(payload_col), F.lit("")).alias("_payload"))
    own = own.withColumn("_d", digest_column()("_id", "_payload"))
    heads, facts = materialize_with(own.select("_id", "_d.*"), "headers", n="count(1)", b="sum(payload_bytes)")
    repeats, n = resolve_revisits(heads, "_id", min_bytes)
    repeats = repeats.select(F.col("_id").alias("_rid"), F.col("payload_digest").alias("_rd"), "refers_to", "refers_uuid")
    on = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_d.payload_digest") == F.col("_rd"))
    known = own.join(F.broadcast(repeats) if n <= broadcast_rows else repeats, on, "left")
    kind = F.when(F.col("_rd").isNull(), "response").otherwise("revisit")
    record = record_text(
        kind, F.col("_d.record_uuid"), F.col("_url"), F.col("_id").cast("string"), F.col("_d.payload_digest"), F.col("_d.payload_bytes"),
        F.col("refers_uuid"), F.col("refers_to"), F.col("_payload"),
    )
    a_file = max(1, int(file_bytes // max(1, (facts["b"] or 0) // max(1, facts["n"] or 0))))
    writer = known.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", a_file).text(path)
    return path


HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive; a block is as long as its header says."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, _, rest = data[at : end + 2].partition(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        heads = {m[1].decode().lower(): m[2].decode() for m in HEADER.finditer(rest)}
        size = int(heads["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size:
            raise ValueError(f"record at byte {at} is cut short")
        yield heads, block
        at = end + 4 + size + 4


COLUMNS = [
    ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.string()), ("page_id", pa.int64()), ("block_digest", pa.string()),
    ("block_bytes", pa.int64()),
]


def _rows(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                raw = file.as_buffer().to_pybytes()
                rows = []
                for heads, block in parse_records(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw):
                    page = heads.get("x-page-id")
                    rows.append((
                        heads["warc-record-id"], heads["warc-type"], heads.get("x-refers-to-page"), heads.get("warc-target-uri"),
                        int(heads.get("x-payload-length", len(block))), heads["warc-payload-digest"].removeprefix("sha1:"),
                        block.decode() if payloads else None, int(page) if page else None, payload_digest(block), len(block),
                    ))
                    if len(rows) == 1000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), COLUMNS, strict=True)], names=[n for n, _ in COLUMNS]
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives in ``path``; a task holds one file at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_rows(payloads), RECORD)


def verified(records: DataFrame) -> DataFrame:
    """Records whose figures come from the blocks read back; a block that isn't what its header says raises.

    A response's size and digest are those of its block. A revisit has an empty block, so its own are those in its header.
    """
    sound = F.when(
        F.col("record_type") == "response",
        (F.col("block_digest") == F.col("payload_digest")) & (F.col("block_bytes") == F.col("payload_bytes")),
    ).otherwise(F.col("block_bytes") == 0)
    wrong = F.concat(F.lit("block and header of an archive differ: "), F.col("record_id"))
    is_response = F.col("record_type") == "response"
    return records.withColumns({
        "payload_bytes": F.when(~sound, F.raise_error(wrong).cast("long")).when(is_response, F.col("block_bytes")).otherwise(F.col("payload_bytes")),
        "payload_digest": F.when(is_response, F.col("block_digest")).otherwise(F.col("payload_digest")),
    })


def op8_warc(spark: SparkSession, base: str) -> DataFrame:
    pages = table(spark, base, "pages").select("page_id", "url", "html")
    path = write_archives(pages, new_path(spark, "warc"))
    records = verified(read_archives(spark, path, payloads=False))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")
    )


WARC_SQL = """
WITH heads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), '') AS payload_digest FROM heads
), placed AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM named
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM placed
"""

QUERIES = {"op8_warc": op8_warc}
SQL = {"op8_warc": WARC_SQL}
