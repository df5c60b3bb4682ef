"""Components, Jaccard join, chunk dedup, nearest neighbours: against plain versions."""

import random

import numpy as np
import pytest

from cohorts.llm import ann, chunks, jaccard
from cohorts.llm.graph import components
from tests.llm import brute


@pytest.mark.parametrize("edges", [
    [], [(5, 5)], [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 50)] + [(i, 1000 + i) for i in range(50)], [(3, 1), (1, 3), (9, 8), (8, 3)],
])
def test_components(spark, edges):
    names = sorted({x for e in edges for x in e if e[0] != e[1]})
    groups = brute.Groups(len(names))
    for u, v in edges:
        if u != v:
            groups.join(names.index(u), names.index(v))
    low = {}
    for i, n in enumerate(names):
        low[groups.find(i)] = min(low.get(groups.find(i), n), n)
    got = components(spark.createDataFrame(edges or [(1, 1)], "u bigint, v bigint")).collect()
    assert {r.vertex: r.root for r in got} == {n: low[groups.find(i)] for i, n in enumerate(names)} and len(got) == len(names)


def edited(rng, words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        kind, i = rng.random(), rng.randrange(len(words)) if words else 0
        if kind < 0.5 and words:
            words[i] = rng.choice(vocabulary)
        elif kind < 0.75:
            words.insert(i, rng.choice(vocabulary))
        elif words:
            del words[i]
    return words


def near_copies():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 8, 12, 20, 30, 45, 60, 80, 120, 300, 700]))
        texts += [" ".join(edited(rng, words, rng.randint(0, max(1, len(words) // 25)), vocabulary)) for _ in range(rng.randint(1, 6))]
    words, passage = rng.choices(vocabulary, k=150), rng.choices(vocabulary, k=60)
    texts += [" ".join(edited(rng, words, rng.randint(0, 4), vocabulary)) for _ in range(60)]
    texts += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(20)]
    texts += ["", "   ", None, "A b C", "a B c", texts[0], texts[0]]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    return rows + [rows[5], (None, texts[70]), (10**6, texts[71]), (10**6, texts[2])]


@pytest.mark.parametrize(("words", "percent", "options"), [
    (3, 90, {}), (5, 80, {"region_sets": 5, "rounds": 0}), (5, 80, {"region_sets": 12, "rounds": 2, "broadcast_ids": 0}),
])
def test_jaccard_links_are_exact(spark, monkeypatch, words, percent, options):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = near_copies()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, n_shingles string")
    got = jaccard.link_documents(docs, words=words, percent=percent, **options).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute.jaccard_components(rows, words, percent)


@pytest.mark.parametrize("percent", [34, 50, 66])
def test_small_sets_link_at_low_thresholds(spark, percent):
    rng = random.Random(percent)
    rows = [(1, "a b c"), (2, "a b c d"), (3, "q"), (4, "q"), (5, "r s"), (6, "r s t u")]
    rows += [(10 + i, " ".join(rng.choices("klmnop", k=rng.randint(1, 7)))) for i in range(60)]
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), words=3, percent=percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute.jaccard_components(rows, 3, percent)


def test_signatures_end_once_they_suffice():
    """A set sends no more slices of a size class than linked sets can differ in, and one."""
    rng, rule = np.random.default_rng(3), jaccard.Rule(5, 80)
    for n in (200, 400, 1000):
        most = sum(rule.differ(int(rule.starts[c + 1]) - 1) + 1 for c in rule.classes(n))
        assert len(rule.signatures(np.unique(rng.integers(0, 2**63, n).astype(np.uint64)))) <= most


def test_entries_are_sent_small():
    rng = np.random.default_rng(4)
    entries = np.zeros(100, dtype=jaccard.ENTRY)
    entries["sig"], entries["doc"] = rng.integers(0, 2**64, 100, dtype=np.uint64), rng.integers(0, jaccard.CODE, 100)
    back = jaccard.received_entries(jaccard.sent_entries(entries))
    assert (back["sig"] == entries["sig"] >> np.uint64(24)).all() and (back["doc"] == entries["doc"]).all()
    assert jaccard.SENT.itemsize < jaccard.ENTRY.itemsize


def test_jaccard_empty_table(spark):
    assert jaccard.link_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_signatures_meet_at_the_threshold():
    rng = np.random.default_rng(1)
    for percent in (30, 40, 50, 60, 66, 80, 90):
        listed = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
        rule = jaccard.Rule(3, percent, listed)
        for n in [*range(1, 130), 500, 2000] if percent >= 80 else range(1, 40):
            shares = rng.integers(0, min(n, 300) + 1) if rng.random() < 0.5 else 0
            a = np.concatenate((rng.choice(listed, shares, replace=False), rng.integers(0, 2**63, n - shares).astype(np.uint64)))
            rng.shuffle(a)
            for grown in range(n * (100 - percent) // percent + 1):
                lost = (n * (100 - percent) - percent * grown) // 100
                if lost < 0 or lost > n or rng.random() > 20 / n:
                    continue
                b = np.concatenate((a[: n - lost], rng.integers(0, 2**63, grown).astype(np.uint64)))
                a_set, b_set = np.unique(a), np.unique(b)
                common = len(np.intersect1d(a_set, b_set))
                if not len(b_set) or not rule.linked(np.array(common), len(a_set), len(b_set)):
                    continue
                assert len(np.intersect1d(rule.signatures(a_set), rule.signatures(b_set))), (percent, n, grown, lost)


def test_chunks_of_repeating_stretches_and_of_texts_without_blanks(spark):
    """Equal stretches are found whatever stands around them; scripts without blanks count by bytes."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choices("abcdefghij", k=n))
    stretches = ["no " * 120, "=" * 400, "ab, cd; " * 60, "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(600)), "漢" * 300]
    rows = []
    for i, stretch in enumerate(stretches):
        rows += [(2 * i + k, " ".join(word(5) for _ in range(40 + 9 * k)) + " " + stretch + " ".join(word(6) for _ in range(30))) for k in range(2)]
    rows.append((50, " ".join(word(5) for _ in range(200))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r._id: r for r in chunks.repeats(docs).collect()}
    assert sorted(got) == list(range(2 * len(stretches)))
    for i, stretch in enumerate(stretches):
        for k in range(2):
            found = sum(e - s for s, e in got[2 * i + k].spans)
            assert found >= len(stretch.encode()) - 3 * chunks.PIECE - 2 * chunks.REACH, (i, k)
    left = {r.doc_id: r.text for r in chunks.drop_repeats(docs).collect()}
    assert all(left[i] == dict(rows)[i] for i in range(0, 10, 2)) and all(len(left[i]) < len(dict(rows)[i]) - 100 for i in range(1, 10, 2))


def test_cuts_of_a_series_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer(("xyz " * 900 + "q1w2e3r4t5 lorem ipsum dolor " * 3 + "aa" * 2000).encode(), dtype=np.uint8)
    whole = chunks.cuts(data)
    assert 120 < len(whole) and (np.diff(whole) > chunks.REACH).all() and (np.diff(whole) <= 4 * chunks.PIECE).all()
    for block in (101, 777, 4096):
        monkeypatch.setattr(chunks, "BLOCK", block)
        assert (chunks.cuts(data) == whole).all()
    twice = chunks.cuts(np.concatenate((data, data)), np.array([len(data), 2 * len(data)]))
    assert (twice == np.concatenate((whole, whole + len(data)))).all()


def test_chunks_follow_content():
    rng = random.Random(5)
    vocabulary = [f"{rng.choice(['ab', 'cé', 'def', 'ghij'])}{i}" for i in range(500)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 400))).encode() for _ in range(60)] + [b"x", b"A " * 5000, "漢".encode() * 300]
    together = chunks.chunk_texts(texts)
    for i, text in enumerate(texts):
        alone, mine = chunks.chunk_texts([text]), together[0] == i
        assert all((together[k][mine] == alone[k]).all() for k in range(1, 5))
        assert alone[2].sum() == len(text) and alone[3].sum() == len(text.split())
        for at, size in zip(alone[1], alone[2]):
            text[at : at + size].decode()
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    whole, block = chunks.cuts(data), chunks.BLOCK
    try:
        chunks.BLOCK = 777
        assert (chunks.cuts(data) == whole).all()
    finally:
        chunks.BLOCK = block
    value = chunks.gear(data[:100])
    for i in (15, 40, 99):
        assert int(value[i]) == sum(int(chunks.TABLE[data[i - j]]) << j for j in range(16)) % 2**32
    found = 0
    for _ in range(200):  # a passage of 51 words stands out, whatever surrounds it
        passage = " ".join(rng.choices(vocabulary, k=51))
        sides = [chunks.chunk_texts([f"{' '.join(rng.choices(vocabulary, k=rng.randrange(90)))} {passage} {' '.join(rng.choices(vocabulary, k=50))}".encode()]) for _ in range(2)]
        known = set(map(tuple, sides[1][4].tolist()))
        found += sum(int(w) for w, d in zip(sides[0][3], map(tuple, sides[0][4].tolist())) if d in known) >= chunks.MIN_WORDS
    assert found >= 198


def test_repeated_passages(spark):
    rng = random.Random(6)
    vocabulary = [f"word{i}x" for i in range(3000)]
    make = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage = make(80)
    texts = [f"{make(100)} {passage} {make(60)}", f"{make(7)} {passage} {make(5)}", make(200), make(30), "", None, make(150)]
    rows = [(10 * i + 5, t, "x") for i, t in enumerate(texts)] + [(65, texts[6], "x"), (None, texts[6], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, at string")
    got = {r._id: r for r in chunks.repeats(docs).collect()}
    assert set(got) == {5, 15, 65, None} and got[5].removed_bytes == 0 and got[15].first_ids == [5] and got[15].n_words >= 60
    out = {r.doc_id: r.text for r in chunks.drop_repeats(docs).collect()}
    assert out[5] == texts[0] and out[35] == texts[3] and out[55] is None and out[65] == texts[6] and len(out[15]) < len(texts[1]) - 300
    assert out[None] == "" and chunks.repeats(docs.limit(0)).count() == 0
    unchanged = chunks.repeats(docs.where("doc_id in (25, 35, 65)"))
    assert unchanged.count() == 0  # rows of one id share nothing with others


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (1500, 24)).astype(np.float32)
    x[700:1200] = x[700] + rng.normal(0, 0.05, (500, 24))
    x[40] = x[41]
    vectors = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    bad = [(2000, None, "x"), (2050, [0.0] * 24, "x"), (2100, [float("nan")] * 24, "x"), (2150, [1.0, None] * 12, "x"), (2200, [1.0], "x"), (None, [1.0] * 24, "x")]
    df = spark.createDataFrame(vectors + bad + vectors[41:42], "vec_id bigint, embedding array<float>, score string")
    queries = df.where("vec_id % 50 = 0")
    got = ann.nearest(df, queries, block=256, query_batch=16, n_pivots=64, posted=32)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    wide = x.astype(np.float64)
    unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        scores = unit @ unit[q]
        scores[q] = -9
        best = np.lexsort((np.arange(1500), -scores))[:5]
        assert sorted(found[q]) == [1, 2, 3, 4, 5]
        hits += len({v for v, _ in found[q].values()} & set(best.tolist()))
        assert all(abs(s - scores[v]) < 1e-12 for v, s in found[q].values())
    assert set(found) == set(range(0, 1500, 50)) and hits >= 0.9 * 150
    few = ann.nearest(df.where("vec_id < 4"), queries.where("vec_id = 0"))
    assert [r["rank"] for r in few.orderBy("rank").collect()] == [1, 2, 3]
    assert ann.nearest(df.limit(0), queries).count() == 0 and ann.nearest(df, queries.limit(0)).count() == 0


def test_rerank_takes_equal_vectors_by_id():
    """A group of equal vectors larger than the least share, stored in falling order of id."""
    n, k = 4000, 5
    ids, x = np.arange(n, 0, -1), np.ones((n, 4))
    agree = np.zeros(n, dtype=np.int16)
    agree[:3500] = 100  # ids 501 to 4000
    x[3500:] = -1.0
    best = ann.Best(1, k)
    ann.rerank(best, 0, agree, ids, x, ann.norms(x), np.array([9999]), np.ones((1, 4)), np.array([2.0]), 0.08, 0.02)
    assert best.ids[0].tolist() == [501, 502, 503, 504, 505]
