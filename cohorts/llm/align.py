"""Alignment of two tokenizers over the same bytes: links between overlapping tokens, groups between shared ends.

A text's tokens A and tokens B are two sorted lists of byte ends. Merging the lists gives both results:
every distinct end closes one stretch that one token of each side covers (a link), and every end that
both lists hold closes a group. The merge is cut into pieces of equal work by binary searches along its
diagonals; a piece needs nothing of its neighbours but the token that is open at its end.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorts.functions.columns import col
from cohorts.llm.bpe import encode, rank_file
from cohorts.llm.tables import table
from cohorts.session import materialize, materialize_with, new_path

# Ends merged in one piece.
PIECE = 1 << 15
# Up to so many different id pairs, 16 bytes each, their counts go to the tasks; beyond, links are shuffled to them.
SENT_PAIRS = 4_000_000
# Different id pairs that a task adds up before it hands them on, and tokens or links taken up at a time.
HELD_PAIRS, HELD_LINKS = 1 << 19, 1 << 19
# Pieces that a reader takes at a time, and their bytes that go to a Python worker at a time.
BATCH_ROWS, BATCH_BYTES = 128, 8 << 20

# How the vocabulary file writes bytes as characters, and the pattern its tokenizer splits by.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLANK = "▁"


@lru_cache(maxsize=2)
def byte_level(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a byte-level vocabulary file in JSON, and the byte length of every id.

    Where ids follow the order of the merges, as is checked, merging by id is merging by rank, which the rank
    library does several times faster than the library the file was written for. Special tokens are left out, so
    that their strings are ordinary text.
    """
    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    hidden = [b for b in range(256) if b not in PRINTED]
    value = {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in stated["added_tokens"] if t["special"]}
    vocab = stated["model"]["vocab"]
    ranks = {bytes(value[c] for c in token): i for token, i in vocab.items() if token not in special}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in stated["model"]["merges"])
    order = [vocab[a + b] for a, b in pairs]
    split = stated["pre_tokenizer"]
    if order != sorted(order) or split["type"] != "ByteLevel" or split["add_prefix_space"] or stated["normalizer"]:
        raise ValueError(f"{path} is no plain byte-level vocabulary with ids in the order of its merges")
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    sizes[list(ranks.values())] = [len(token) for token in ranks]
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes], np.ndarray]:
    """The piece model of a file, and the bytes and byte length of every id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    listed = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    raw = [bytes([int(t[3:-1], 16)]) if model.is_byte(i) else t.replace(BLANK, " ").encode() for i, t in enumerate(listed)]
    return model, raw, np.array([len(r) for r in raw], dtype=np.int64)


def tokens(text: str | None, a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Ids and byte ends of both tokenizers over a blank and the text; None where either does not give back these bytes."""
    if not text:
        return None
    by_rank, a_sizes = byte_level(a_path)
    model, raw, b_sizes = pieces(b_path)
    whole = (" " + text).encode()
    b = model.encode(text, num_threads=1)
    if b"".join(map(raw.__getitem__, b)) != whole:
        return None
    a = encode(by_rank, " " + text)
    if by_rank.decode_bytes(a) != whole:
        return None
    a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
    return a, np.cumsum(a_sizes[a]), b, np.cumsum(b_sizes[b])


def lengths(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([ends[:1], ends[1:] - ends[:-1]])


def partition(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of two sorted lists into pieces of ``size`` merged elements: positions in ``a`` and in ``b``.

    Diagonal d holds all ways to take d elements from both lists; the merge crosses it where ``a[i - 1] <= b[j]`` and
    ``b[j - 1] < a[i]``, i + j = d. All diagonals are searched at once. An end that both lists hold is never cut
    in two: its second half moves over the border.
    """
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, size), total) if total else np.zeros(2, dtype=np.int64)
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (active := low < high).any():
        mid = (low + high) // 2
        ahead = np.zeros(len(d), dtype=bool)
        ahead[active] = a[mid[active]] <= b[(d - mid - 1)[active]]
        low, high = np.where(active & ahead, mid + 1, low), np.where(active & ~ahead, mid, high)
    i, j = low, d - low
    torn = np.zeros(len(d), dtype=bool)
    inner = (i > 0) & (j < len(b))
    torn[inner] = a[i[inner] - 1] == b[j[inner]]
    return i, j + torn


@dataclass
class Merged:
    """What one piece gives: ``left`` and ``right`` place the linked tokens of A and B, ``at`` and ``to`` its shared ends."""

    a: np.ndarray
    b: np.ndarray
    left: np.ndarray
    right: np.ndarray
    at: np.ndarray
    to: np.ndarray

    @property
    def keys(self) -> np.ndarray:
        return (self.a[self.left] << 32) | self.b[self.right]


def merge(a_ids: np.ndarray, a_steps: np.ndarray, b_ids: np.ndarray, b_steps: np.ndarray, n_a: int, n_b: int) -> Merged:
    """Merges a piece that owns the first ``n_a`` and ``n_b`` tokens; one more of each side may follow, open at its end."""
    a, b = np.cumsum(a_steps), np.cumsum(b_steps)
    right = np.searchsorted(b, a[:n_a], "left")
    shared = np.zeros(n_a, dtype=bool)
    own = right < n_b
    shared[own] = b[right[own]] == a[:n_a][own]
    at, to = np.flatnonzero(shared), right[shared]
    alone = np.ones(n_b, dtype=bool)
    alone[to] = False
    alone = np.flatnonzero(alone)
    left = np.concatenate([np.arange(n_a), np.searchsorted(a, b[alone], "left")])
    return Merged(a_ids, b_ids, left, np.concatenate([right, alone]), at, to)


@lru_cache(maxsize=2)
def labels(n_ids: int) -> np.ndarray:
    """Decimal ids followed by a comma, a bar or a semicolon, as rows of bytes filled up with zeros."""
    table = np.array([f"{i}{mark}".encode() for mark in ",|;" for i in range(n_ids)])
    return table.view(np.uint8).reshape(len(table), -1)


def joined(n_ids: int, places: np.ndarray) -> bytes:
    cells = labels(n_ids)[places]
    return cells[cells > 0].tobytes()


def written(m: Merged, n_ids: int, first: int, last: int) -> bytes:
    """Groups between the piece's shared ends number ``first`` and ``last``, each closed by a semicolon."""
    start_a, start_b = (m.at[first - 1] + 1, m.to[first - 1] + 1) if first else (0, 0)
    ends_a, ends_b = m.at[first:last] + 1 - start_a, m.to[first:last] + 1 - start_b
    if not len(ends_a):
        return b""
    n_a, n_b = ends_a[-1], ends_b[-1]
    pos_a, pos_b = np.arange(n_a), np.arange(n_b)
    before_b = np.concatenate([[0], ends_b])[np.searchsorted(ends_a, pos_a, "right")]
    before_a = ends_a[np.searchsorted(ends_b, pos_b, "right")]
    mark = np.zeros(n_a + n_b, dtype=np.int64)
    ids = np.empty(n_a + n_b, dtype=np.int64)
    ids[pos_a + before_b] = m.a[start_a : start_a + n_a]
    ids[pos_b + before_a] = m.b[start_b : start_b + n_b]
    mark[(pos_a + before_b)[ends_a - 1]] = 1
    mark[(pos_b + before_a)[ends_b - 1]] = 2
    return joined(n_ids, ids + n_ids * mark)


def fragments(m: Merged, n_ids: int, n_a: int, n_b: int) -> tuple[bool, str, str, str, str, str]:
    """Whether a group ends in the piece; tokens up to the first shared end, whole groups, and tokens after the last one."""
    text = lambda ids: joined(n_ids, ids).decode("ascii")
    if not len(m.at):
        return False, text(m.a[:n_a]), text(m.b[:n_b]), "", "", ""
    head = text(m.a[: m.at[0] + 1]), text(m.b[: m.to[0] + 1])
    return (True, *head, written(m, n_ids, 1, len(m.at)).decode("ascii"), text(m.a[m.at[-1] + 1 : n_a]), text(m.b[m.to[-1] + 1 : n_b]))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Pieces are wide rows, so readers and workers take few of them at a time."""
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, "spark.sql.parquet.columnarReaderBatchSize": BATCH_ROWS}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# Tokens are one cell of bytes each (32-bit numbers), which readers and writers copy as a whole.
TOKEN_FIELDS = [
    ("_row", pa.int64()), ("piece", pa.int32()), ("n_pieces", pa.int32()), ("n_a", pa.int32()), ("n_b", pa.int32()),
    ("a_ids", pa.binary()), ("a_steps", pa.binary()), ("b_ids", pa.binary()), ("b_steps", pa.binary()),
]
TOKEN_DDL = "_row long, piece int, n_pieces int, n_a int, n_b int, a_ids binary, a_steps binary, b_ids binary, b_steps binary"


def _cells(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.astype("<i4").tobytes() for r in rows], type=pa.binary())


def _file(path: str, sent: bool) -> str:
    return SparkFiles.get(path) if sent else path


def _tokenizer(a_path: str, a_sent: bool, b_path: str, b_sent: bool, size: int) -> Callable:
    """Arrow rows (id, row, text) to one row for every piece of a text's merge; texts without tokens have one empty piece."""

    def cut(row: int, text: str | None) -> Iterator[tuple]:
        found = tokens(text, _file(a_path, a_sent), _file(b_path, b_sent))
        if found is None:
            none = np.zeros(0, dtype=np.int64)
            yield row, 0, 1, 0, 0, none, none, none, none
            return
        a, a_ends, b, b_ends = found
        if len(a) + len(b) <= size:
            yield row, 0, 1, len(a), len(b), a, lengths(a_ends), b, lengths(b_ends)
            return
        i, j = partition(a_ends, b_ends, size)
        for k in range(len(i) - 1):
            one, two = slice(i[k], i[k + 1] + 1), slice(j[k], j[k + 1] + 1)
            base = min(a_ends[i[k] - 1] if i[k] else 0, b_ends[j[k] - 1] if j[k] else 0)
            steps = np.diff(a_ends[one], prepend=base), np.diff(b_ends[two], prepend=base)
            yield row, k, len(i) - 1, i[k + 1] - i[k], j[k + 1] - j[k], a[one], steps[0], b[two], steps[1]

    def pack(ids: list, rows: list[tuple], field: pa.Field) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(ids, type=field.type)]
        arrays += [pa.array(c, type=kind) for c, (_, kind) in zip(columns[:5], TOKEN_FIELDS[:5], strict=True)]
        arrays += [_cells(c) for c in columns[5:]]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([field, *[pa.field(*f) for f in TOKEN_FIELDS]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            field, ids, rows, held = batch.schema.field(0), [], [], 0
            for k in range(batch.num_rows):
                for piece in cut(batch.column(1)[k].as_py(), batch.column(2)[k].as_py()):
                    ids.append(batch.column(0)[k].as_py())
                    rows.append(piece)
                    held += piece[3] + piece[4]
                    if held >= HELD_LINKS:
                        yield pack(ids, rows, field)
                        ids, rows, held = [], [], 0
            if rows:
                yield pack(ids, rows, field)

    return run


def _merged(batch: pa.RecordBatch, first: int) -> Iterator[tuple[int, Merged, int, int]]:
    """The pieces of a batch, merged; ``first`` is the place of the column ``_row``."""
    n_a, n_b = batch.column(first + 3).to_numpy(), batch.column(first + 4).to_numpy()
    cells = [batch.column(k) for k in range(first + 5, first + 9)]
    for k in range(batch.num_rows):
        parts = [np.frombuffer(c[k].as_buffer(), dtype="<i4").astype(np.int64) for c in cells]
        yield k, merge(*parts, int(n_a[k]), int(n_b[k])), int(n_a[k]), int(n_b[k])


PAIR_SCHEMA = pa.schema([("pair", pa.int64()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces to id pairs with the links that hold them, added up within the task as far as memory allows."""
    keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    waiting, links = [], 0

    def add() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (keys[:0], counts[:0])
        known, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
        return known, np.bincount(back, weights=np.concatenate([counts, n]), minlength=len(known)).astype(np.int64)

    for batch in batches:
        for _, m, _, _ in _merged(batch, 0):
            waiting.append(m.keys)
            links += len(m.left)
            if links >= HELD_LINKS:
                keys, counts = add()
                waiting, links = [], 0
        if len(keys) >= HELD_PAIRS:
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], schema=PAIR_SCHEMA)
            keys, counts = keys[:0], counts[:0]
    keys, counts = add()
    if len(keys):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], schema=PAIR_SCHEMA)


def _piece_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every piece's own id pairs with their links: (row, pair, n)."""
    schema = pa.schema([("_row", pa.int64()), *PAIR_SCHEMA])
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for k, m, _, _ in _merged(batch, 0):
            keys, n = np.unique(m.keys, return_counts=True)
            if len(keys):
                arrays = [pa.array(np.full(len(keys), rows[k])), pa.array(keys), pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)


FACTS = [("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())]
OPEN = [("cut", pa.bool_()), ("head_a", pa.string()), ("head_b", pa.string()), ("body", pa.string()), ("tail_a", pa.string()), ("tail_b", pa.string())]
FACT_DDL = "n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, cut boolean, head_a string, head_b string, body string, tail_a string, tail_b string"


def _judge(n_ids: int, sent: object | None) -> Callable:
    """Pieces to their facts. A text of one piece has its digest at once, pieces of others hand on what is to be stitched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = sent.value if sent is not None else (None, None)
        for batch in batches:
            single = batch.column(3).to_numpy() == 1
            rows = []
            for k, m, n_a, n_b in _merged(batch, 1):
                best = total = 0
                if keys is not None and len(m.left):
                    found = values[np.searchsorted(keys, m.keys)]
                    best, total = int((found & 1).sum()), int((found >> 1).sum())
                facts = (len(m.at), len(m.left), best, total)
                if single[k]:
                    text = written(m, n_ids, 0, len(m.at))[:-1]
                    digest = hashlib.sha256(text).hexdigest() if text else ""
                    rows.append((*facts, digest, None, None, None, None, None, None))
                else:
                    rows.append((*facts, None, *fragments(m, n_ids, n_a, n_b)))
            if rows:
                columns = zip(zip(*rows, strict=True), FACTS + OPEN, strict=True)
                arrays = batch.columns[:6] + [pa.array(c, type=kind) for c, (_, kind) in columns]
                fields = [*list(batch.schema)[:6], *[pa.field(*f) for f in FACTS + OPEN]]
                yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    return run


STITCHED = pa.schema([("_row", pa.int64()), ("groups_sha256", pa.string())])


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of row and piece to one digest a row; holds one open group and no text's whole string."""
    row, digest, started, open_a, open_b = None, None, False, [], []
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if r["_row"] != row:
                if row is not None:
                    done.append((row, digest.hexdigest()))
                row, digest, started, open_a, open_b = r["_row"], hashlib.sha256(), False, [], []
            open_a.append(r["head_a"])
            open_b.append(r["head_b"])
            if r["cut"]:
                text = f"{''.join(open_a)[:-1]}|{''.join(open_b)[:-1]};{r['body']}"[:-1]
                digest.update(((";" if started else "") + text).encode("ascii"))
                started, open_a, open_b = True, [r["tail_a"]], [r["tail_b"]]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=STITCHED)
    if row is not None:
        yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([digest.hexdigest()])], schema=STITCHED)


@dataclass
class Alignment:
    """``documents``: a row for every input row, with its figures. ``pairs``: ``a``, ``b``, ``n`` links in the corpus, ``best``."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE,
    sent_pairs: int = SENT_PAIRS,
) -> Alignment:
    """Aligns two tokenizers over every text of ``docs``.

    ``a_path`` is a byte-level vocabulary in JSON, applied to a blank and the text, ``b_path`` a piece model, which adds
    that blank itself; special tokens are ordinary text. ``documents`` has the id, ``n_a`` and ``n_b`` tokens,
    ``n_groups``, ``n_links``, ``n_best`` (links whose pair has the highest count of its B id; ties count),
    ``count_sum`` (sum of the pair counts over links) and ``groups_sha256``.

    Texts are encoded once; tokens are written as pieces of ``piece`` merged ends, so no later row grows with a text.
    Pair counts add up within tasks, then by shuffle. Up to ``sent_pairs`` different pairs, the counts go to the tasks
    as arrays; beyond, every piece's pairs are shuffled to their counts. Pieces of long texts are sorted by
    text and place and stitched as a stream.

    Null and empty texts, and those that either tokenizer does not give back byte by byte, have no tokens: zeros,
    and an empty ``groups_sha256``. Equal rows give equal rows; a null id is an id like others; other columns are not read.
    """
    spark = docs.sparkSession
    a_path, a_sent = rank_file(spark, a_path)
    b_path, b_sent = rank_file(spark, b_path)
    rows = docs.select(col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    path = new_path(spark, "tokens")
    cut = rows.mapInArrow(_tokenizer(a_path, a_sent, b_path, b_sent, piece), f"_id {id_type}, {TOKEN_DDL}")
    with small_batches(spark):
        cut.write.option("compression", "zstd").parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)

    counted = cut.drop("_id").where("n_a > 0 or n_b > 0").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    b_id = F.col("pair").bitwiseAND((1 << 32) - 1)
    with small_batches(spark):
        counted, facts = materialize_with(counted, "pairs", rows="count(1)", a="max(pair >> 32)", b="max(pair & 4294967295)")
    highest = counted.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))
    pairs = counted.withColumn("b", b_id).join(highest, "b").select(
        F.shiftright("pair", 32).alias("a"), "b", "n", (F.col("n") == F.col("top")).alias("best"), "pair"
    )

    n_ids = 1 + max(facts["a"] or 0, facts["b"] or 0)
    sent = None
    if facts["rows"] <= sent_pairs:
        here = pairs.select("pair", F.shiftleft("n", 1).bitwiseOR(F.col("best").cast("long")).alias("v")).toArrow()
        keys, values = here["pair"].to_numpy(), here["v"].to_numpy()
        order = np.argsort(keys)
        sent = spark.sparkContext.broadcast((keys[order], values[order]))
    judged = cut.mapInArrow(_judge(n_ids, sent), f"_id {id_type}, _row long, piece int, n_pieces int, n_a int, n_b int, {FACT_DDL}")
    with small_batches(spark):
        judged = materialize(judged, "judged")
    if sent is not None:
        sent.unpersist()

    single = judged.where("n_pieces = 1")
    long = judged.where("n_pieces > 1")
    parts = long.select("_row", "piece", *[name for name, _ in OPEN]).repartition("_row").sortWithinPartitions("_row", "piece")
    stitched = parts.mapInArrow(_stitch, "_row long, groups_sha256 string")
    figures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    sums = [F.sum(c).cast("long").alias(c) for c in figures]
    whole = long.groupBy("_row", "_id").agg(*sums).join(stitched, "_row").select("_row", "_id", *figures, "groups_sha256")
    out = single.select("_row", "_id", *[F.col(c).cast("long").alias(c) for c in figures], "groups_sha256").unionByName(whole)
    if sent is None:
        own = cut.drop("_id").where("n_a > 0 or n_b > 0").mapInArrow(_piece_pairs, "_row long, pair long, n long")
        met = own.withColumnRenamed("n", "here").join(materialize(pairs, "counts"), "pair")
        sums = met.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("here")).otherwise(0)).alias("n_best"), F.sum(F.col("here") * F.col("n")).alias("count_sum")
        )
        out = out.drop("n_best", "count_sum").join(sums, "_row", "left").fillna(0, ["n_best", "count_sum"])
    documents = out.select(F.col("_id").alias(id_col), *figures, "groups_sha256")
    return Alignment(documents, pairs.drop("pair"))


def op13_align(spark: SparkSession, base: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, base, "documents")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).documents


QUERIES = {"op13_align": op13_align}
SQL: dict[str, str] = {}
