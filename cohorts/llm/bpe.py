"""Byte-level BPE with a local rank file: encoding of whole texts, and decoding of ids to raw bytes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorts.functions.columns import col
from cohorts.llm.tables import table

# A text longer than this many characters is encoded in parts.
PART_CHARS = 1 << 16
# Texts of this many characters together go through one call.
BATCH_CHARS = 1 << 22
# No match of the pattern crosses from a letter or digit to a following blank or line feed.
SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?=[ \n])")
# The library's pattern engine overflows its stack on longer runs of white space, so they are handed over as pieces.
LONG_BLANK = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


@lru_cache(maxsize=4)
def load(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; one a process."""
    with open(ranks, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Pieces of about ``size`` characters, cut where the pattern always starts a new match.

    A stretch without such a place stays in one piece, so the ids equal those of the whole text.
    """
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(encoding: tiktoken.Encoding, text: str, size: int = PART_CHARS) -> list[int]:
    """The ids of ``encode_ordinary(text)``, for texts of any length.

    A run of white space is one match up to its last character, which belongs to what
    follows it, if anything does. Long runs are therefore merged as one piece on their own.
    """
    if len(text) < 4096:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for blank in LONG_BLANK.finditer(text):
        for part in safe_parts(text[start : blank.start()], size):
            ids.extend(encoding.encode_ordinary(part))
        start = blank.end() if blank.end() == len(text) else blank.end() - 1
        ids.extend(encoding._encode_single_piece(text[blank.start() : start]))
    for part in safe_parts(text[start:], size):
        ids.extend(encoding.encode_ordinary(part))
    return ids


def rank_file(spark: SparkSession, ranks: str) -> tuple[str, bool]:
    """How tasks find the rank file: a path on every machine, or, for a URI, a file sent with the job."""
    if "://" not in ranks:
        return ranks, False
    spark.sparkContext.addFile(ranks)
    return ranks.rsplit("/", 1)[1], True


# Columns after the id.
FACTS = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))]


def _mapper(ranks: str, sent: bool, pattern: str, ids_out: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(SparkFiles.get(ranks) if sent else ranks, pattern)
        names = [str(i) for i in range(encoding.n_vocab)]

        def row(text: str | None) -> tuple:
            ids = encode(encoding, text or "")
            raw = encoding.decode_bytes(ids)
            digest = hashlib.sha256(",".join([names[i] for i in ids]).encode("ascii")).hexdigest()
            found = (len(ids), digest, hashlib.sha256(raw).hexdigest())
            return (found + (ids,)) if ids_out else found

        facts = FACTS if ids_out else FACTS[:-1]
        for batch in batches:
            texts, start = batch.column(1), 0
            schema = pa.schema([batch.schema.field(0), *[pa.field(*f) for f in facts]])
            while start < batch.num_rows:
                stop, chars = start, 0
                while stop < batch.num_rows and chars < BATCH_CHARS:
                    chars += len(texts[stop].as_buffer() or b"") if texts[stop].is_valid else 0
                    stop += 1
                rows = [row(t) for t in texts.slice(start, stop - start).to_pylist()]
                columns = list(zip(*rows, strict=True))
                arrays = [batch.column(0).slice(start, stop - start)]
                arrays += [pa.array(c, type=kind) for c, (_, kind) in zip(columns, facts, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                start = stop

    return run


def encode_texts(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids_out: bool = False
) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and ``ids`` if asked for.

    Every match of ``pattern`` is merged by the ranks on its own, without special tokens.
    Long texts are cut only at places where a new match always begins, so ids equal those of
    the whole text. ``decoded_sha256`` is the digest of the bytes that the ids decode to.
    One narrow stage without a shuffle; ids leave a task in batches bounded by text size.

    Null and empty texts have no ids. Rows are independent: equal rows give equal results,
    and other columns are not read.
    """
    spark = docs.sparkSession
    path, sent = rank_file(spark, ranks)
    id_type = docs.select(col(id_col)).schema[0].dataType
    fields = [
        T.StructField(id_col, id_type), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ]
    if ids_out:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    kind = T.StructType(fields)
    run = _mapper(path, sent, pattern, ids_out)
    return docs.select(col(id_col), col(text_col)).mapInArrow(run, kind)


def decode_ids(df: DataFrame, ranks: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``bytes`` (binary) to every row: the raw bytes of its ids, which need not be valid UTF-8; null ids give null."""
    path, sent = rank_file(df.sparkSession, ranks)

    @F.pandas_udf(T.BinaryType())
    def to_bytes(ids):
        encoding = load(SparkFiles.get(path) if sent else path, pattern)
        return ids.map(lambda x: None if x is None else encoding.decode_bytes([int(i) for i in x]))

    return df.withColumn("bytes", to_bytes(col(ids_col)))


def op4_bpe(spark: SparkSession, base: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_texts(table(spark, base, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES = {"op4_bpe": op4_bpe}
SQL: dict[str, str] = {}
