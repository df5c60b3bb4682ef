"""Filter audit and winnowing against plain versions, and odd inputs."""

import random
import re
import string
from itertools import permutations

import pytest

from cohorts.llm import audit, winnow
from tests.llm import brute


def fails(text):
    words = brute.WORD.findall(text)
    return {
        name for name, bad in (
            ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
            ("C", 100 * sum(c in string.ascii_uppercase for c in text) > 10 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
        ) if bad
    }


def plain_audit(rows, labels):
    """{(part, order, step): figures} from (id, text, lang) and (id, quality, toxic), one document at a time."""
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    out, removed = {}, {}
    for i, text, lang in rows:
        text, part = text or "", lang or ""
        bad = fails(text)
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            bad = bad | {"E"}
        for order in permutations("ABCDE"):
            there = True
            for step, f in enumerate(order, 1):
                row = out.setdefault((part, "".join(order), step), [0] * 6)
                goes = there and f in bad
                row[2] += not there and f in bad
                there = there and not goes
                row[0] += there
                row[1] += goes
                row[3] += bad == {f}
                row[4] += goes and i in good
                row[5] += goes and i in toxic
                removed[part, f] = removed.get((part, f), 0) + goes
    return {key: (*row, removed[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def test_audit(spark):
    rng = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "d|e", "é漢", "x"] + [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words[: rng.choice([6, 306])]) for _ in range(rng.choice([5, 99, 100, 140]))) for _ in range(40)]
    texts += ["A" * 10 + "b" * 90, "A" * 11 + "b" * 89, " ".join(f"w{i % 80}" for i in range(100)), " ".join(f"w{i % 79}" for i in range(100)), "", None, "\x1c" * 50]
    rows = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    rows += [(100 + i, rng.choice(texts), rng.choice(["en", "fr"])) for i in range(60)] + [(7, texts[7], "en"), (None, texts[3], "en"), (None, texts[3], None), (3, texts[9], "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in rows if rng.random() < 0.6] + [(5, 1, 0), (5, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id bigint, text string, lang string, part string, mask int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = audit.audit_filters(docs.repartition(5), marks)
    found = {(r.part, r.filter_order, r.step): (*[r[c] for c in audit.COUNTS], r.shapley) for r in got.collect()}
    assert found == plain_audit(rows, labels)
    assert {k[0] for k in found} == {"", "en", "de", "fr"} and len(found) == 4 * 600
    assert audit.audit_filters(docs.limit(0), marks).count() == 0
    unlabelled = audit.audit_filters(docs, marks.limit(0)).selectExpr("sum(good_lost) g", "sum(kept) k").first()
    assert unlabelled.g == 0 and unlabelled.k > 0
    copies = spark.range(20_000).selectExpr("id as doc_id", "'same text' as text", "'en' as lang")
    last = audit.audit_filters(copies, marks).where("filter_order = 'EABCD' and step = 1").first()
    assert (last.removed, last.kept, last.unique_fails) == (19_999, 1, 0)


def plain_passages(docs, items, span=10):
    """Per document: words, hit words, ids of items with an occurrence."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOWER))

    windows = {}
    for i, text in items:
        w = words(text)
        size = min(len(w), span)
        for p in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + size]), set()).add(i)
    out = []
    for _, text in docs:
        w, hit, met = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for p in range(len(w) - size + 1):
                if tuple(w[p : p + size]) in windows:
                    hit |= set(range(p, p + size))
                    met |= windows[tuple(w[p : p + size])]
        out.append((len(w), len(hit), sorted(str(i) for i in met if i is not None)))
    return out


def passages_sample(rng, common):
    pool = ["a", "b", "c"] if common else [f"w{i}" for i in range(50)] + ["Über", "漢字", "x1"]
    make = lambda n: [rng.choice(pool) for _ in range(n)]
    passages = [make(rng.choice([1, 2, 4, 5, 6, 9, 10, 11, 14, 30])) for _ in range(14)]
    items = [(i, rng.choice([" ", ", ", "\n"]).join(make(rng.randrange(3)) * (len(p) > 9) + p)) for i, p in enumerate(passages)]
    items += [(100, items[9][1]), (None, items[8][1]), (101, None), (102, " ,.! "), (7, items[7][1].upper()), (103, "w1 " * 40)]
    docs = []
    for i in range(60):
        parts = [make(rng.randrange(40)) + rng.choice(passages)[rng.randrange(2):] for _ in range(rng.randrange(1, 5))]
        docs.append((i, rng.choice([" ", "-", "\x00"]).join(w for part in parts for w in part)))
    docs += [(200, None), (201, ""), (202, "w1 " * 300), (None, docs[3][1]), (3, docs[3][1]), (4, "another text " + items[10][1]), (203, items[13][1])]
    return docs, items


@pytest.mark.parametrize("common,step,limit", [(False, 4096, 1000), (False, 11, 0), (True, 7, 1000), (True, 4096, 0)])
def test_winnowing(spark, common, step, limit):
    rng = random.Random(step)
    docs, items = passages_sample(rng, common)
    frame = spark.createDataFrame([(*d, "clash", "x") for d in docs], "doc_id bigint, text string, items string, hash string")
    bench = spark.createDataFrame([(*i, 5) for i in items], "item_id bigint, text string, span int")
    got = winnow.find_passages(frame.repartition(3), bench, step=step, broadcast_contexts=limit, broadcast_items=limit)
    want = plain_passages(docs, items)
    found = sorted(((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=str)
    assert found == sorted(((str(d[0]), *w) for d, w in zip(docs, want)), key=str)
    assert all(sum(s.end - s.first for s in r.spans) == r.n_hit and r.hash == "x" for r in got.collect())
    assert sum(w[1] > 0 for w in want) > 20


def test_winnowing_without_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "..."), (2, None)], "item_id bigint, text string")
    r = winnow.find_passages(docs, bench).first()
    assert (r.n_words, r.n_hit, r.spans, r["items"]) == (3, 0, [], [])
    bench = spark.createDataFrame([(1, "words")], "item_id bigint, text string")
    assert winnow.find_passages(docs, bench).first().n_hit == 1
    assert winnow.find_passages(docs.limit(0), bench).count() == 0
    assert winnow.find_passages(docs, bench.limit(0)).first().n_hit == 0


def test_winnowing_of_a_very_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    text = "lorem ipsum dolor " * 60_000 + passage + " sit amet" * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    r = winnow.find_passages(docs, spark.createDataFrame([(5, "x " + passage + " y")], "item_id bigint, text string")).first()
    assert (r.n_words, r.n_hit, [tuple(s) for s in r.spans], r["items"]) == (220_040, 40, [(180_000, 180_040)], ["5"])
