"""Alignment of two tokenizers against a plain version, and odd inputs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohorts.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(libraries, text):
    """Lists of (id, bytes) by the two libraries themselves, or None."""
    first, second = libraries
    if not text:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    value = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    found = first.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(value[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else None


def plain(libraries, texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups as text."""
    linked, out = [], []
    for text in texts:
        found = plain_tokens(libraries, text)
        links, groups = [], []
        if found:
            spans = []
            for side in found:
                at, here = 0, []
                for i, raw in side:
                    here.append((at, at + len(raw), i))
                    at += len(raw)
                spans.append(here)
            links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if max(x[0], y[0]) < min(x[1], y[1])]
            start = 0
            for end in sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]}):
                groups.append("|".join(",".join(str(i) for s, _, i in side if start <= s < end) for side in spans))
                start = end
        linked.append(links)
        out.append((len(found[0]) if found else 0, len(found[1]) if found else 0, len(groups), len(links), ";".join(groups)))
    counts = Counter(p for links in linked for p in links)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [
        (*o[:4], sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), o[4]) for o, links in zip(out, linked)
    ], counts, top


def sample():
    rng = random.Random(7)
    words = ["the", "Überraschung", "naïve", "12345", "  ", "\n\n", "don't", "a漢字b", "😀", "ﬁ", "x" * 40, "\t", "\x00", "thheand", "<|endoftext|>", "<unk>", "<0x41>"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    return [None, "", " ", "a", "▁ literal", "\n", *texts, texts[3], texts[3], "é" * 500]


@pytest.mark.parametrize("piece,sent", [(1 << 15, 1 << 20), (7, 1 << 20), (1, 0), (50, 0)])
def test_alignment(spark, libraries, piece, sent):
    texts = sample()
    want, counts, top = plain(libraries, texts)
    rows = [(i if i != 9 else None, t, "clash", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, piece string, _row int").repartition(3)
    got = align.align(docs, A, B, piece=piece, sent_pairs=sent)
    found = {r.doc_id: r for r in got.documents.collect()}
    assert len(found) == len(texts)
    for i, w in enumerate(want):
        r = found[i if i != 9 else None]
        digest = hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (*w[:6], digest), (i, texts[i])
    assert {(r.a, r.b): (r.n, r.best) for r in got.pairs.collect()} == {p: (n, n == top[p[1]]) for p, n in counts.items()}
    assert want[0][0] == want[1][0] == want[4][0] == 0 and max(w[0] - w[2] for w in want) > 5


def test_alignment_of_long_and_repeated_texts(spark, libraries):
    text = "word and Wörter, " * 9_000
    docs = spark.createDataFrame([(5, text), (5, text), (6, None)], "doc_id bigint, text string")
    out = align.align(docs, A, B, piece=1000).documents
    rows = out.orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [5, 5, 6] and rows[0] == rows[1] and rows[0].n_a > 30_000 and rows[2].n_links == 0
    whole = align.align(docs, A, B).documents.orderBy("doc_id").collect()
    assert rows == whole and len(rows[0].groups_sha256) == 64
    assert align.align(docs.limit(0), A, B).documents.count() == 0
    sent = align.align(docs, f"file://{A}", f"file://{B}").documents
    assert sent.agg(F.sum("n_links")).first()[0] == sum(r.n_links for r in rows)


def test_partition_is_even_and_keeps_shared_ends():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 10, 1000):
        for _ in range(60):
            last = int(rng.integers(1, 200))
            a, b = (np.unique(np.append(rng.integers(1, last + 1, int(rng.integers(0, 150))), last)) for _ in range(2))
            i, j = align.partition(a, b, size)
            merged = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
            for k, d in enumerate([*range(0, len(merged), size), len(merged)]):
                taken = merged[:d]
                if d < len(merged) and d and merged[d] == (merged[d - 1][0], 1):
                    taken = merged[: d + 1]
                assert (i[k], j[k]) == (sum(s == 0 for _, s in taken), sum(s == 1 for _, s in taken))
    assert [x.tolist() for x in align.partition(a[:0], b[:0], 5)] == [[0, 0], [0, 0]]


def test_ranks_give_the_ids_of_the_library(libraries):
    by_rank, _ = align.byte_level(A)
    rng = random.Random(9)
    marks = ["a", "B", "1", " ", "\n", "  ", "'s", "'", "é", "　", "\x1c", "%", "漢", "ll", "́", "​", "²", "ǅ"]
    for _ in range(2000):
        text = " " + "".join(rng.choice(marks) for _ in range(rng.randrange(40)))
        assert by_rank.encode_ordinary(text) == libraries[0].encode(text, add_special_tokens=False).ids, repr(text)
    every = [by_rank.decode_single_token_bytes(i) for i in range(by_rank.n_vocab - 1)]
    assert all(by_rank._encode_single_piece(raw) == [i] for i, raw in enumerate(every))


def test_tokens_travel_as_bytes(libraries):
    """A piece's tokens are four cells of bytes, whatever their number, and come back as they were cut."""
    a_path, b_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    texts = ["", "plain words of one piece", "many words that fill several pieces " * 40]
    rows = pa.RecordBatch.from_arrays([pa.array([7, 8, 9]), pa.array([0, 1, 2]), pa.array(texts)], names=["_id", "_row", "_text"])
    for batch in align._tokenizer(a_path, False, b_path, False, 64)(iter([rows])):
        assert not [f.name for f in batch.schema if pa.types.is_list(f.type)]
        ids = {}
        for k, m, n_a, n_b in align._merged(batch, 1):
            known = ids.setdefault(batch.column(0)[k].as_py(), ([], []))
            known[0].extend(m.a[:n_a].tolist())
            known[1].extend(m.b[:n_b].tolist())
        for row, text in zip((7, 8, 9), texts, strict=True):
            found = align.tokens(text, a_path, b_path)
            assert ids[row] == (([], []) if found is None else (found[0].tolist(), found[2].tolist()))
