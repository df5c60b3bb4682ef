"""Substring dedup: content-defined chunks from a gear hash, matched by digest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorts.functions.columns import col
from cohorts.llm.tables import table
from cohorts.session import materialize

# A cut looks at the hash of GEAR bytes; it is the highest of REACH places on either side.
GEAR, REACH = 16, 24
# Bytes between cuts in a stretch that repeats itself.
PIECE = 48
# Runs of shared chunks of fewer words are left alone, unless they have so many bytes (scripts without blanks).
MIN_WORDS, MIN_BYTES = 12, 160
# Bytes of text that are hashed at a time.
BLOCK = 1 << 22
# A number for each byte value, from a fixed digest.
TABLE = np.array(
    [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)], dtype=np.uint32
)


def gear(data: np.ndarray) -> np.ndarray:
    """Hash at every place of the bytes up to it: the sum of TABLE values, shifted by their distance, over GEAR bytes.

    Sums over 1, 2, 4, ... bytes are combined, so the whole array costs a few vector operations.
    """
    value, size = TABLE[data], 1
    while size < GEAR:
        longer = value.copy()
        longer[size:] += value[:-size] << np.uint32(size)
        value, size = longer, size * 2
    return value


def _highest(value: np.ndarray, size: int) -> np.ndarray:
    """Maximum of ``size`` values from every place on; shorter by ``size - 1``."""
    have = 1
    while have * 2 <= size:
        value = np.maximum(value[:-have], value[have:])
        have *= 2
    rest = size - have
    return np.maximum(value[:-rest], value[rest:]) if rest else value


def cuts(data: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """Places where a chunk ends, by content alone; character borders of UTF-8. ``ends`` are the ends of the texts in ``data``.

    A candidate's hash is no lower than those at the REACH places on either side, all of its own text. Candidates within
    REACH of each other are equal and stand in a stretch that repeats itself, at the same place of every repeat: of such a
    series the first counts, and from there the first in every PIECE bytes. So an insertion moves only the cuts next to
    it, chunks are longer than REACH bytes, and a repeating stretch falls into equal pieces, whatever its neighbours are.
    """
    ends = np.array([len(data)]) if ends is None else ends
    starts = np.concatenate(([0], ends[:-1]))
    found, margin = [], GEAR - 1 + REACH
    last = first = owner = -1
    for start in range(0, len(data), BLOCK):
        low, high = max(0, start - margin), min(len(data), start + BLOCK + REACH)
        if high - low <= margin + REACH:
            continue
        value = gear(data[low:high])[GEAR - 1 :]
        around = _highest(value, REACH)
        mid = value[REACH : len(value) - REACH]
        before, after = around[: len(mid)], around[REACH + 1 : REACH + 1 + len(mid)]
        places = np.flatnonzero((mid >= before) & (mid >= after)) + low + margin + 1
        texts = np.searchsorted(ends, places, side="right")
        # what a place looked at is of its own text, even after a step of three bytes to a character's border
        inside = texts < len(ends)
        places, texts = places[inside], texts[inside]
        inside = (places > starts[texts] + margin) & (places + REACH + 3 < ends[texts])
        places, texts = places[inside], texts[inside]
        if not len(places):
            continue
        earlier = np.concatenate(([last], places[:-1]))
        fresh = (places - earlier > REACH) | (texts != np.concatenate(([owner], texts[:-1])))
        begun = np.maximum.accumulate(np.where(fresh, np.arange(1, len(places) + 1), 0))
        origin = np.where(begun > 0, places[begun - 1], first)
        found.append(places[fresh | ((places - origin) // PIECE > (earlier - origin) // PIECE)])
        last, first, owner = places[-1], origin[-1], texts[-1]
    out = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    for _ in range(3):
        out = out + ((data[out] & 0xC0) == 0x80)
    return np.unique(out)


CHUNKS = "_id bigint, _t bigint, at int, size int, words int, h1 bigint, h2 bigint"


def chunk_texts(raws: list[bytes]) -> tuple[np.ndarray, ...]:
    """Number of the text, start, size, words begun, and 128-bit digest (two columns) of every chunk of the texts, none empty."""
    joined = b"".join(raws)
    data = np.frombuffer(joined, dtype=np.uint8)
    ends = np.cumsum([len(r) for r in raws])
    starts = ends - [len(r) for r in raws]
    edges = np.concatenate((starts, cuts(data, ends), ends[-1:]))
    edges.sort()
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = ~blank
    begins[1:] &= blank[:-1]
    begins[starts] = ~blank[starts]
    upto = np.concatenate(([0], np.cumsum(begins)))
    places = edges.tolist()
    digests = b"".join(
        [hashlib.blake2b(joined[x:y], digest_size=16).digest() for x, y in zip(places[:-1], places[1:], strict=True)]
    )
    number = np.searchsorted(ends, edges[:-1], side="right")
    digest = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
    return number, edges[:-1] - starts[number], np.diff(edges), np.diff(upto[edges]), digest


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, raws, size = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer()
            if raw is None or not len(raw):
                continue
            keys.append(key)
            raws.append(raw.to_pybytes())
            size += len(raws[-1])
            if size >= BLOCK:
                yield _chunk_batch(keys, raws)
                keys, raws, size = [], [], 0
        if raws:
            yield _chunk_batch(keys, raws)


def _chunk_batch(keys: list, raws: list[bytes]) -> pa.RecordBatch:
    number, at, size, words, digest = chunk_texts(raws)
    texts = np.array([text_key(r) for r in raws], dtype=np.int64)
    arrays = [pa.array(keys, pa.int64()).take(pa.array(number)), pa.array(texts[number])]
    arrays += [pa.array(c.astype(np.int32)) for c in (at, size, words)]
    arrays += [pa.array(np.ascontiguousarray(digest[:, k])) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(arrays, names=["_id", "_t", "at", "size", "words", "h1", "h2"])


def text_key(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)


def shared_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES
) -> DataFrame:
    """``(_id, _t, at, size, words, first_id)``: chunks that other documents hold too, in runs of ``min_words`` words or ``min_bytes`` bytes.

    A row per place: byte offset and size in the document's UTF-8 text. ``first_id`` is the smallest id with the chunk. Digests are counted by
    partial aggregates of lowest and highest id, so a chunk that a third of all rows share is no hot group;
    the chunks of several documents are joined back, the large side split where skewed. Neighbouring shared chunks of
    a document form a run.

    Null and empty texts have no chunks. Rows with the same id are one document: what only they share isn't shared. Null ids are one further document,
    which is never the first of a chunk.
    """
    chunks = docs.select(col(id_col).cast("long").alias("_id"), col(text_col).alias("_text")).mapInArrow(_chunks, CHUNKS)
    chunks = materialize(chunks, "chunks")
    groups = chunks.groupBy("h1", "h2").agg(
        F.min("_id").alias("first_id"), F.max("_id").alias("_last"), F.max(F.col("_id").isNull().cast("int")).alias("_null")
    )
    several = (F.col("first_id") < F.col("_last")) | ((F.col("_null") == 1) & F.col("first_id").isNotNull())
    shared = materialize(groups.where(several).select("h1", "h2", "first_id"), "shared")
    hits = chunks.join(shared, ["h1", "h2"]).select("_id", "_t", "at", "size", "words", "first_id")
    own = Window.partitionBy("_id", "_t")
    by_place = own.orderBy("at")
    end = F.lag(F.col("at") + F.col("size")).over(by_place)
    # equal rows repeat a document's chunks: the same place again continues its run
    fresh = (F.col("at") > F.coalesce(end, F.lit(-1))).cast("int")
    hits = hits.withColumn("_fresh", fresh)
    hits = hits.withColumn("_run", F.sum("_fresh").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    copies = F.count(F.lit(1)).over(Window.partitionBy("_id", "_t", "at"))
    hits = hits.withColumn("_copies", copies)
    run = Window.partitionBy("_id", "_t", "_run")
    words, size = [F.sum(F.col(c) / F.col("_copies")).over(run) for c in ("words", "size")]
    kept = hits.withColumn("_words", words).withColumn("_bytes", size)
    kept = kept.where((F.col("_words") > min_words - 0.5) | (F.col("_bytes") > min_bytes - 0.5))
    return kept.select("_id", "_t", "at", "size", "words", "first_id").distinct()


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document (id and text) that holds a passage of another: what is shared, and what goes.

    ``spans`` lists (start, end) in bytes, ``removed`` those whose chunks a smaller id holds, ``first_ids`` the ids that keep them.
    """
    hits = shared_chunks(docs, id_col, text_col, min_words)
    span = F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end"))
    goes = F.coalesce(F.col("first_id") < F.col("_id"), F.lit(True))
    return hits.groupBy("_id", "_t").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("words").alias("n_words"),
        F.sum(F.when(goes, F.col("size")).otherwise(0)).alias("removed_bytes"),
        F.array_sort(F.collect_list(span)).alias("spans"),
        F.array_sort(F.collect_list(F.when(goes, span))).alias("removed"),
        F.array_sort(F.collect_set("first_id")).alias("first_ids"),
    )


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, gone in zip(texts, spans, strict=True):
        raw, parts, at = (text or "").encode(), [], 0
        for start, end in sorted((s["start"], s["end"]) for s in (gone if gone is not None else [])):
            parts.append(raw[at:start])
            at = end
        out.append((b"".join(parts) + raw[at:]).decode())
    return pd.Series(out)


@F.pandas_udf(T.LongType())
def _text_key(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: text_key((t or "").encode()))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Rows of ``docs`` without the repeated passages that a smaller id keeps; a null text stays null."""
    gone = repeats(docs, id_col, text_col, min_words).where("removed_bytes > 0")
    gone = materialize(gone.select(F.col("_id").alias("_gid"), F.col("_t").alias("_gt"), "removed"), "removed")
    keyed = docs.withColumn("_t", _text_key(col(text_col)))
    joined = keyed.join(gone, col(id_col).cast("long").eqNullSafe(F.col("_gid")) & (F.col("_t") == F.col("_gt")), "left")
    text = F.when(F.col("removed").isNull(), col(text_col)).otherwise(_without(col(text_col), F.col("removed")))
    return joined.withColumn(text_col, text).select(*[col(c) for c in docs.columns])


def op7_chunks(spark: SparkSession, base: str) -> DataFrame:
    found = repeats(table(spark, base, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        F.col("_id").alias("doc_id"), "n_chunks", "n_words", "removed_bytes", "first_ids", spans.alias("spans")
    )


QUERIES = {"op7_chunks": op7_chunks}
SQL: dict[str, str] = {}
