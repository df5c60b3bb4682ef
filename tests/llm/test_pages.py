"""Url rules and aliases, WARC archives, mixing, and the pipeline."""

import gzip
import random
import time
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cohorts.llm import mixing, registry, urls, warc
from cohorts.session import materialize, new_path, scratch_dir
from tests.compare import TESTDATA, connect, differences
from tests.llm import brute

BASE = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", ["op2_redirects", "op8_warc", "op9_jaccard", "op10_line_dedup"])
def test_query_equals_sql(spark, name):
    text, ok = differences(spark, connect(BASE), BASE, name)
    assert ok, text


def test_all_ten_are_registered():
    assert {n.split("_")[0] for n in registry.queries()} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "jaccard", "mixing", "bpe"]


PAGES = [
    (1, "HTTP://Blocked.Example.NET/es/a?x=1#top", None), (2, "https://ok.org/one", "<link href='http://blocked.example.net/es/a?x=1' rel=\"canonical\">"),
    (3, "http://ok.org/two", '<META http-equiv="refresh" content="0; url=/one">'), (4, "http://ok.org/three", '<link rel=canonical href="http://nowhere.org/x">'),
    (5, "http://ok.org/four", '<link rel="canonical" href="//nowhere.org/x">'), (6, "http://www.example.com/en/1", "<link rel=canonical href=http://example.com/en/1>"),
    (7, "http://x.org/en/1", '<link rel="canonical" href="http://example.com/en/1">'), (8, None, None), (9, "no url", "<p>"), (10, "http://m.x.org/en/1", ""),
    (11, "http://example.com", None), (12, "http://a.fr.net/fr", "x"), (13, "http://a.fr.net/fr/", "x"), (2, "https://ok.org/one", ""), (14, "http://ok.org/five", '<link rel="stylesheet" href="http://example.com/en/1">'),
    (15, "http://ok.org/dir/six", '<link rel="canonical" href="../seven"><link rel="canonical" href="eight">'), (16, "http://ok.org/dir/eight?", '<link rel="canonical" href="/one">'),
]
VERDICTS = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow", 9: "allow", 10: "block", 11: "allow", 12: "allow", 13: "block", 14: "allow", 15: "allow", 16: "block"}


@pytest.mark.parametrize("limit", [urls.BROADCAST_RULES, 0])
def test_blocks_reach_aliases(spark, limit):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id bigint, url string, html string, rule string")
    got = urls.judge_urls(pages, urls.RULES, broadcast_rules=limit).collect()
    assert len(got) == len(PAGES)
    assert {r.page_id: r.verdict for r in got} == VERDICTS
    by_id = {r.page_id: r for r in got}
    assert (by_id[1].host, by_id[1].path, by_id[1].rule) == ("blocked.example.net", "/es/a", "net/es/")
    assert (by_id[8].host, by_id[8].path, by_id[8].rule) == ("", "", None) and by_id[11].rule is None and by_id[6].rule == "www.example.com/en/"
    extra = spark.createDataFrame([("http://ok.org/five", "http://example.com/en/1")], "source string, target string")
    more = {r.page_id: r.verdict for r in urls.judge_urls(pages, urls.RULES, links=extra).collect()}
    assert more == VERDICTS | {14: "block"}
    assert urls.judge_urls(pages.limit(0), urls.RULES).count() == 0


REFERENCES = [
    ("?id=3", "x.org/a/b?id=3"), ("#top", "x.org/a/b?q=1"), ("/go?next=http://x.net/es/a", "x.org/go?next=http://x.net/es/a"),
    ("//Y.org/z", "y.org/z"), ("c", "x.org/a/c"), ("./c", "x.org/a/c"), ("../c", "x.org/c"), ("../../../c/./d/..", "x.org/c/"), ("..", "x.org/"),
    (".", "x.org/a/"), ("http://z.org/a/../b?c=../d#e", "z.org/b?c=../d"), ("HTTPS://Z.org", "z.org"), ("mailto:a@b", None), ("c?d=/../e", "x.org/a/c?d=/../e"),
    ("javascript:x://y", None), ("/a//b/../c", "x.org/a//c"), ("...", "x.org/a/..."),
]


def test_references_are_resolved(spark):
    rows = spark.createDataFrame([(i, "HTTP://x.org/a/b?q=1", to) for i, (to, _) in enumerate(REFERENCES)], "i int, url string, target string")
    got = rows.select("i", urls.key_of(urls.resolved(F.col("target"), F.col("url"))).alias("key")).collect()
    assert {r.i: r.key for r in got} == {i: key for i, (_, key) in enumerate(REFERENCES)}
    bare = spark.createDataFrame([("http://x.org", "c")], "url string, target string")
    assert bare.select(urls.key_of(urls.resolved(F.col("target"), F.col("url")))).first()[0] == "x.org/c"


@pytest.mark.parametrize(("tag", "target"), [
    ('<link rel="alternate Canonical" href=/c>', "x.org/c"), ('<link data-rel="canonical" href="/c">', None), ('<link rel="x-canonical" href="/c">', None),
    ('<link rel=canonical data-href="/d" HREF = \'/c?a=1&amp;b\'>', "x.org/c?a=1&b"), ('<link title="a > b" rel="canonical" href="/c">', "x.org/c"),
    ('<link title="rel=canonical href=/d" rel="next" href="/c">', None), ('<linker rel=canonical href="/c">', None), ('<meta rel=canonical href="/c">', None),
    ('<meta http-equiv="Refresh" content="0; URL=/c">', "x.org/c"), ('<meta content="5;url= \'/c\' x" http-equiv=refresh />', "x.org/c"), ('<meta content="5;url=/c" http-equiv=refresh/>', None),  # an unquoted value takes the slash
   
    ('<meta http-equiv="refresh" content="30">', None), ('<meta name="refresh" content="0; url=/c">', None), ("<link rel=canonical>", None), ('<link rel="canonical" href="">', None),
])
def test_tags_are_read(spark, tag, target):
    pages = spark.createDataFrame([("http://x.org/a", f"<p>{tag}</p>")], "url string, html string")
    got = [r.target for r in urls.declared_links(pages).collect()]
    assert got == ([target] if target else [])


@pytest.mark.parametrize("verdicts", [("allow", "block"), ("block", "allow")])
def test_allow_precedes_block_of_the_same_rule(spark, verdicts):
    pages = spark.createDataFrame([(1, "http://x.org/a", "")], "page_id bigint, url string, html string")
    assert urls.judge_urls(pages, [("x.org/", v) for v in verdicts]).first().verdict == "allow"


@pytest.mark.parametrize("limit", [warc.BROADCAST_ROWS, 0])
def test_archives(spark, limit):
    same = "<p>gleich ü</p>\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/\nb", same), (7, "http://c", same), (3, None, None), (4, "http://e", ""), (5, "u", "own"), (7, "http://c", same), (None, "n", same), (None, "n", "alone"), (9, "big", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, refers_to string")
    path = warc.write_archives(pages, new_path(spark, "warc"), broadcast_rows=limit, file_bytes=1000)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows)
    facts = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got)
    want = []
    for key, _, html in rows:
        payload = (html or "").encode()
        kin = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        top = max(kin, default=None)
        first = top is None or key == top
        want.append((str(key), "response" if first else "revisit", None if first else str(top), len(payload), warc.payload_digest(payload)))
    assert facts == sorted(want)
    names = {r.record_id for r in got if r.record_type == "response"}
    for r in got:
        if r.record_type == "response":
            assert warc.payload_digest(r.payload.encode()) == r.payload_digest
        else:
            assert r.payload == ""
    assert len(names) == 5
    kept = {r.page_id: r for r in warc.read_archives(spark, warc.write_archives(pages, new_path(spark, "warc"), min_bytes=10)).collect()}
    assert kept[3].record_type == kept[4].record_type == "response" and kept[1].record_type == "revisit"
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0), new_path(spark, "warc"))).count() == 0


def test_payloads_read_back_are_compared(spark):
    records = warc.read_archives(spark, warc.write_archives(spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc")], "page_id bigint, url string, html string"), new_path(spark, "warc")))
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in warc.verified(records).collect()) == [(i, 3, warc.payload_digest(b"abc")) for i in (1, 2)]
    for wrong in ({"block_digest": F.lit("A" * 32)}, {"block_bytes": F.lit(4).cast("long")}):
        with pytest.raises(Exception, match="block and header"):
            warc.verified(records.withColumns(wrong)).collect()


def test_parser_goes_by_length():
    record = b"WARC/1.1\r\nContent-Length: 9\r\nWARC-Type: response\r\n\r\nab\r\n\r\ncd\n\r\n\r\n"
    assert [b for _, b in warc.parse_records(gzip.decompress(gzip.compress(record * 2)))] == [b"ab\r\n\r\ncd\n"] * 2
    with pytest.raises(ValueError):
        list(warc.parse_records(record[:-9]))


def projected(p, tokens, targets, ridge, most):
    """Plain projected gradient with very many short steps."""
    share = tokens / tokens.sum()
    importance = 1 / np.maximum(targets, share @ p)
    rate = np.ones(len(p))
    for _ in range(60_000):
        gradient = p @ ((share * rate) @ p * importance - targets * importance) + ridge * (rate - 1)
        rate = np.clip(rate - 0.3 * gradient, 0, most)
    return rate


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_are_the_least_squares(spark, most):
    rng = np.random.default_rng(4)
    steps = rng.multinomial(mixing.STEPS, [0.6, 0.25, 0.15], 40) if most is None else np.eye(3, dtype=int)[rng.integers(0, 3, 40)] * 1000
    tokens = rng.integers(0, 500, 40)
    rows = [(int(t), *map(int, s)) for t, s in zip(tokens, steps)]
    df = spark.createDataFrame(rows, "tokens bigint, p0 int, p1 int, p2 int")
    targets = np.array([0.5, 0.2, 0.1])
    rates, reached = mixing.fit_rates(df, targets, ridge=0.05, most=most, max_steps=400)
    p = steps / mixing.STEPS
    want = projected(p, tokens, targets, 0.05, np.inf if most is None else most)
    assert np.allclose(rates.of(p)[0], want, atol=2e-2) and np.allclose(reached, (tokens / tokens.sum() * want) @ p, atol=1e-3)
    assert mixing.fit_rates(df.limit(0), targets)[1].tolist() == [0, 0, 0]


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_settle_with_the_ridge_in_use(spark, most):
    """Posteriors that overlap, targets that no rates meet: steps end by the proven distance from the best rates."""
    rng = np.random.default_rng(14)
    chances = rng.dirichlet([2.0, 0.5, 0.15], 60)
    steps = np.array([rng.multinomial(mixing.STEPS, c) for c in chances])
    tokens = rng.integers(1, 500, 60)
    df = spark.createDataFrame([(int(t), *map(int, s)) for t, s in zip(tokens, steps)], "tokens bigint, p0 int, p1 int, p2 int")
    p, share = steps / mixing.STEPS, tokens / tokens.sum()
    targets = (share @ p) * np.array([1.02, 0.5, 0.05])
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        rates, _ = mixing.fit_rates(df, targets, most=most)
    want = projected(p, tokens, targets, mixing.RIDGE, np.inf if most is None else most)
    off = np.abs(rates.of(p)[0] - want)
    assert np.sqrt(share @ off**2) <= mixing.SETTLED and off.max() < 0.1
    with pytest.warns(UserWarning, match="did not settle"):
        mixing.fit_rates(df, targets, most=most, max_steps=2)


def test_mixing_reaches_targets_and_learns_labels(spark):
    docs, labels = mixing.table(spark, f"{TESTDATA}/sf0.01", "documents"), mixing.domain_labels(mixing.table(spark, f"{TESTDATA}/sf0.01", "labels"))
    out, reached = mixing.mix(docs.withColumn("rate", F.lit("clash")), labels, mixing.TARGETS, carry=["doc_id", "rate"])
    out = out.cache()
    assert out.count() == docs.count() and out.where("rate < 0").count() == 0
    assert all(abs(reached[d] - t) < 0.02 for d, t in mixing.TARGETS.items())
    top = F.when(F.col("p_good") > 0.5, "good").when(F.col("p_poor") > F.col("p_toxic"), "poor").otherwise("toxic")
    right = out.join(labels, "doc_id").agg(F.avg((top == F.col("domain")).cast("int"))).first()[0]
    assert right > 0.85
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "word"), (3, "word"), (None, "x")], "doc_id bigint, text string")
    plain, _ = mixing.mix(odd, labels.limit(0), mixing.TARGETS)
    assert plain.count() == 5 and plain.select("p_good").distinct().count() == 1
    assert mixing.mix(odd.limit(0), labels, mixing.TARGETS)[0].count() == 0


def test_pipeline_stages(spark):
    docs = corpus_pipeline.table(spark, BASE, "documents")
    extra = docs.withColumn("n_words", F.lit("clash")).withColumn("at", F.lit(1))
    kept = corpus_pipeline.quality(spark, extra, BASE)
    assert kept.columns == extra.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert 0 < len(rows) < docs.count()
    lined = corpus_pipeline.line_dedup(spark, kept, BASE)
    want = {i: w[0] for (i, _), w in zip(rows, brute.dedup_lines(rows))}
    assert {r.doc_id: r.text for r in lined.collect()} == want and lined.columns == extra.columns
    twice = materialize(lined.union(lined.where(F.col("doc_id") == rows[3][0])), "twice")
    near = corpus_pipeline.jaccard(spark, twice, BASE)
    left = [i for i, _, c in brute.jaccard_components(list(want.items()), 5, 80) if i == c]
    assert sorted(r.doc_id for r in near.collect()) == sorted(left) and near.columns == extra.columns
    mixed = corpus_pipeline.mixing(spark, near, BASE)
    assert set(r.doc_id for r in mixed.collect()) <= set(left) and mixed.columns == extra.columns
    coded = {r.doc_id: r for r in corpus_pipeline.bpe(spark, mixed, BASE).collect()}
    assert len(coded) == mixed.count() and all(len(r.ids) == r.n_tokens for r in coded.values())


def test_stages_leave_no_copy_of_the_texts(spark):
    """Neither whole texts nor their shingles stay in scratch tables behind the first three stages, nor shuffle files behind a table."""
    docs = corpus_pipeline.table(spark, BASE, "documents")
    files = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def tables():
        found = files.listFiles(spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)), True)
        names = set()
        while found.hasNext():
            path = found.next().getPath()
            names |= {path.getParent().toString()} if path.getName().endswith(".parquet") else set()
        return names

    def shuffled():
        return disk.getAllFiles().mkString(" ").count(".data")

    known, files_before = tables(), shuffled()
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = materialize(stage(spark, docs, BASE), f"out_{name}")
        for table in tables() - known:
            if "/out_" not in table:
                assert not {"_row", "text", "_text", "shingles"} & set(spark.read.parquet(table).columns), table
        docs = out
    deadline = time.time() + 20
    while shuffled() > files_before and time.time() < deadline:
        time.sleep(0.5)
    assert shuffled() <= files_before + 16  # those of counts and collects that no table is made of


def test_rows_of_one_text_are_judged_by_language_and_source(spark):
    """The quality stage joins verdicts by text, language and source, nulls included, and returns every row that passes."""
    docs = corpus_pipeline.table(spark, BASE, "documents")
    odd = docs.unionByName(docs.withColumn("lang", F.lit(None).cast("string"))).unionByName(docs.limit(20)).withColumn("doc_id", F.col("doc_id") % 50)
    judged = corpus_pipeline.judge(odd.select("doc_id", "text", "lang", "source")).where("kept")
    key = lambda r: (r.doc_id, r.text, r.lang, r.source)
    assert sorted(map(key, corpus_pipeline.quality(spark, odd, BASE).collect()), key=str) == sorted(map(key, judged.collect()), key=str)


def test_jaccard_stage_keeps_other_texts_of_an_id(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"{w}{rng.randrange(10**6)}" for _ in range(80)) for w in "abcd")
    rows = [(3, a), (5, a + " end"), (5, b), (5, b), (8, b + " end"), (9, c), (9, c + " end"), (None, c), (None, d), (None, d), (7, None), (7, ""), (7, "x")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id bigint, text string, lang string")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.jaccard(spark, docs, BASE).collect()), key=str)
    nine = [t for i, t in got if i == 9]
    assert len(nine) == 1 and nine[0] in (c, c + " end")
    empty = [t for i, t in got if i == 7 and not t]
    assert len(empty) == 1
    assert [r for r in got if r[0] != 9 and r[1]] == sorted([(3, a), (5, b), (None, d), (7, "x")], key=str)


def test_pipeline_on_odd_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x " * 50, "en", "s", 100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, BASE)
            assert name == "bpe" or out.columns == docs.columns
            out.collect()
