"""Mixing to target weights: domain posteriors from labelled documents, and rates that bring expected totals to targets."""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorts.functions.columns import col
from cohorts.llm.tables import row_key, table
from cohorts.session import materialize

DOMAINS = ("good", "poor", "toxic")
# Wanted token totals, as shares of all tokens of the input.
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}

# Labelled documents that the classifier is fitted on at most (lowest hashes of their ids): half give word
# weights, half give the coefficients. Words of the model: those in at least MIN_DOCS of them, MAX_WORDS at most.
SAMPLE, MIN_DOCS, MAX_WORDS = 6_000, 4, 50_000
# Posteriors are rounded to this many steps, so equal ones can be counted together.
STEPS = 1000
# Pull of rates to one; step limit; rates are settled when their distance from the best ones is proven to be no more
# than this (root of the mean square over all tokens).
RIDGE, MAX_STEPS, SETTLED = 1e-3, 600, 0.01
# Distance of a reached total from its target (share of all tokens) that gives a warning.
TOLERANCE = 0.005

# Lower case, and blanks for the punctuation around words.
FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b".,;:!?\"'()[]{}|", b"abcdefghijklmnopqrstuvwxyz" + b" " * 15
)
SYMBOLS, CAPITALS = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(raw: bytes) -> set[bytes]:
    return set(raw.translate(FOLD).split())


def features(raw: bytes, place: dict[bytes, int], weight: np.ndarray) -> np.ndarray:
    """Mean and largest word weight for each domain, and shares that tell prose from lists and noise."""
    words = raw.translate(FOLD).split()
    distinct = set(words)
    size, n = max(1, len(raw)), max(1, len(words))
    known = [place[w] for w in distinct if w in place]
    own = weight[known] if known else np.zeros((1, weight.shape[1]))
    shares = (
        np.sqrt((len(raw) - len(raw.translate(None, SYMBOLS))) / size),
        np.sqrt((len(raw) - len(raw.translate(None, CAPITALS))) / size),
        np.sqrt(raw.count(b"!") / size),
        len(distinct) / n,
        len(known) / max(1, len(distinct)),
        np.log1p(len(words)),
    )
    return np.concatenate((own.sum(axis=0) / max(1, len(distinct)), own.max(axis=0), shares))


class Model:
    """Word weights, and a softmax over standardised features."""

    def __init__(self, words: list[bytes], weight: np.ndarray, prior: np.ndarray):
        self.place = {w: i for i, w in enumerate(words)}
        self.weight, self.prior = weight, prior
        self.mean = self.spread = self.coefficients = None

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 600) -> None:
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.column_stack((np.ones(len(x)), (x - self.mean) / self.spread))
        wanted = np.eye(len(self.prior))[y]
        beta = np.zeros((z.shape[1], len(self.prior)))
        ahead, momentum = beta.copy(), 1.0
        rate = 1.0 / (0.5 * np.linalg.eigvalsh(z.T @ z / len(z))[-1] + ridge)
        for _ in range(rounds):
            gradient = z.T @ (softmax(z @ ahead) - wanted) / len(z) + ridge * ahead
            moved = ahead - rate * gradient
            following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            ahead = moved + (momentum - 1) / following * (moved - beta)
            beta, momentum = moved, following
        self.coefficients = beta

    def posterior(self, x: np.ndarray) -> np.ndarray:
        if self.coefficients is None:
            return np.tile(self.prior, (len(x), 1))
        return softmax(np.column_stack((np.ones(len(x)), (x - self.mean) / self.spread)) @ self.coefficients)


def softmax(score: np.ndarray) -> np.ndarray:
    grown = np.exp(score - score.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def domain_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)``: toxic where marked so, else good or poor by quality; rows without a label are left out."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain")).where("doc_id is not null and domain is not null")


def _count_words(n_domains: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(n_domains)]
        for batch in batches:
            for text, k in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[k].update(words_of(text.as_buffer().to_pybytes()))
        for k, own in enumerate(counts):
            if own:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(own), pa.binary()), pa.array([k] * len(own), pa.int32()), pa.array(list(own.values()), pa.int64())],
                    names=["word", "k", "n"],
                )

    return run


def train(
    docs: DataFrame, labels: DataFrame, domains: tuple[str, ...] = DOMAINS, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> Model:
    """A classifier of ``labels`` (``doc_id``, ``domain``), fitted on a bounded sample of labelled documents.

    Document frequencies of words by domain, from one half of the sample, give log-odds weights; a
    softmax over ten-odd features is fitted on the other half, so its posteriors are calibrated
    on texts whose words were not counted. Without documents of two domains every posterior is the prior.
    """
    known = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
    marked = labels.select(F.col("doc_id").alias("_lid"), known.cast("int").alias("k")).where("k >= 0")
    marked = marked.groupBy("_lid").agg(F.min("k").alias("k"))
    present = marked.join(docs.select(col(id_col).alias("_lid")).distinct(), "_lid", "left_semi")
    picked = present.orderBy(F.xxhash64("_lid"), "_lid").limit(sample)
    own = docs.select(col(id_col).alias("_lid"), col(text_col).alias("text")).where("text is not null")
    texts = own.join(F.broadcast(picked), "_lid").select("text", "k", (F.xxhash64(F.lit(11), "_lid") % 2 == 0).alias("first"))
    texts = materialize(texts, "sample")
    sizes = {r["k"]: r["n"] for r in texts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    prior = np.array([(sizes.get(k, 0) + 1) / (total + len(domains)) for k in range(len(domains))])
    if len(sizes) < 2:
        return Model([], np.zeros((0, len(domains))), prior)

    counts = texts.where("first").select("text", "k").mapInArrow(_count_words(len(domains)), "word binary, k int, n bigint")
    by_word = counts.groupBy("word").agg(*[
        F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(len(domains))
    ])
    df = sum((F.col(f"n{k}") for k in range(len(domains))), F.lit(0))
    top = by_word.withColumn("df", df).where(F.col("df") >= MIN_DOCS).orderBy(F.desc("df"), "word").limit(MAX_WORDS).collect()
    held = texts.where("first").groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()
    n_docs = np.zeros(len(domains))
    for r in held:
        n_docs[r["k"]] = r["n"]
    n = np.array([[r[f"n{k}"] for k in range(len(domains))] for r in top], dtype=float).reshape(len(top), len(domains))
    inside = (n + 0.5) / (n_docs + 1)
    outside = (n.sum(axis=1, keepdims=True) - n + 0.5) / (n_docs.sum() - n_docs + 1)
    model = Model([bytes(r["word"]) for r in top], np.log(inside / outside), prior)

    place, weight = model.place, model.weight
    sent = docs.sparkSession.sparkContext.broadcast((place, weight))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weight = sent.value
        for batch in batches:
            rows = [features(t.as_buffer().to_pybytes(), place, weight).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "k"])

    rows = texts.where("not first").select("text", "k").mapInArrow(featured, "x array<double>, k int").collect()
    if len({r["k"] for r in rows}) > 1:
        model.fit(np.array([r["x"] for r in rows]), np.array([r["k"] for r in rows]))
    return model


def judged_type(n_domains: int) -> T.StructType:
    fields = [T.StructField("tokens", T.LongType())]
    return T.StructType(fields + [T.StructField(f"p{k}", T.IntegerType()) for k in range(n_domains)])


def with_posteriors(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``_j``: the number of words, and a posterior for each domain in steps of 1/STEPS that add up to one."""
    n = len(model.prior)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(judged_type(n))
    def judge(texts: pa.Array) -> pa.Array:
        model = sent.value
        x, tokens = [], []
        for text in texts:
            raw = text.as_buffer().to_pybytes()
            tokens.append(len(raw.split()))
            x.append(features(raw, model.place, model.weight))
        p = model.posterior(np.array(x).reshape(len(x), -1))
        steps = np.floor(p * STEPS).astype(np.int32)
        steps[np.arange(len(steps)), p.argmax(axis=1)] += STEPS - steps.sum(axis=1)
        arrays = [pa.array(tokens, pa.int64())] + [pa.array(np.ascontiguousarray(steps[:, k])) for k in range(n)]
        return pa.StructArray.from_arrays(arrays, ["tokens", *[f"p{k}" for k in range(n)]])

    return docs.withColumn("_j", judge(F.coalesce(col(text_col), F.lit(""))))


class Rates:
    """Rates as a function of posteriors: the steps of a projected gradient descent, which depend on totals only."""

    def __init__(self, step: float, ridge: float, most: float | None):
        self.step, self.ridge, self.most = step, ridge, most
        self.pulls: list[tuple[np.ndarray, float]] = []

    def of(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rates, the points ahead of them at which the next gradient is taken, and how the last step moved: from its point, from its rates."""
        rate = ahead = np.ones(len(p))
        off = by = np.zeros(len(p))
        for pull, momentum in self.pulls:
            moved = np.maximum(0.0, ahead - self.step * (p @ pull + self.ridge * (ahead - 1)))
            if self.most is not None:
                moved = np.minimum(moved, self.most)
            off, by = ahead - moved, moved - rate
            ahead = moved + momentum * by
            rate = moved
        return rate, ahead, off, by


def fit_rates(
    posteriors: DataFrame, targets: np.ndarray, ridge: float = RIDGE, most: float | None = None, max_steps: int = MAX_STEPS
) -> tuple[Rates, np.ndarray]:
    """Nonnegative rates whose expected totals match ``targets`` (shares of all tokens) in least squares; the totals reached.

    ``posteriors`` holds ``tokens`` and ``p0``, ``p1``, ... in steps. Minimises the squared distance of totals from targets, each weighed
    by the larger of its target and its natural total, plus ``ridge`` times the token-weighed squared distance of rates from one,
    over rates of at least zero (and at most ``most``). Documents of equal posterior get equal rates, so tokens are first added up by
    posterior; a step is then one distributed pass over those sums, and only a few totals return.

    Steps have momentum, which starts anew when a step turns against it. The ridge makes the objective strongly convex, so the
    length of a step bounds the distance from the best rates; steps end when that bound is SETTLED, and running out of them gives a warning.
    """
    k = len(targets)
    names = [f"p{i}" for i in range(k)]
    cells = materialize(posteriors.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "cells")
    share = [F.col(n) / STEPS for n in names]
    pairs = [(i, j) for i in range(k) for j in range(k)]
    facts = cells.agg(
        F.sum("tokens").alias("all"), *[F.sum(F.col("tokens") * share[i] * share[j]).alias(f"g{i}_{j}") for i, j in pairs],
        *[F.sum(F.col("tokens") * share[i]).alias(f"m{i}") for i in range(k)],
    ).first()
    if not facts["all"]:
        return Rates(1.0, ridge, most), np.zeros(k)
    everything = float(facts["all"])
    mass = np.array([facts[f"m{i}"] for i in range(k)]) / everything
    gram = np.array([facts[f"g{i}_{j}"] for i, j in pairs]).reshape(k, k) / everything
    importance = 1 / np.maximum(np.maximum(targets, mass), 1e-6)
    root = np.sqrt(importance)
    rates = Rates(1 / (np.linalg.eigvalsh(root[:, None] * gram * root[None, :])[-1] + ridge), ridge, most)

    def totals() -> tuple[np.ndarray, np.ndarray, float, float]:
        sent = cells.sparkSession.sparkContext.broadcast(rates)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(2 * k + 2)
            for batch in batches:
                p = np.column_stack([batch.column(i).to_numpy() for i in range(k)]) / STEPS
                tokens = batch.column(k).to_numpy() / everything
                rate, point, off, by = sent.value.of(p)
                sums += np.concatenate(((tokens * rate) @ p, (tokens * point) @ p, [tokens @ off**2, tokens @ (off * by)]))
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()])], names=["sums"])

        rows = cells.select(*names, "tokens").mapInArrow(add, "sums array<double>")
        found = np.array(rows.agg(*[F.sum(F.col("sums")[i]) for i in range(2 * k + 2)]).first(), dtype=float)
        sent.unpersist()
        return found[:k], found[k : 2 * k], float(found[-2]), float(found[-1])

    now, ahead, _, _ = totals()
    weight = 1.0
    for _ in range(max_steps):
        following = (1 + np.sqrt(1 + 4 * weight**2)) / 2
        rates.pulls.append(((ahead - targets) * importance, (weight - 1) / following))
        now, ahead, off, turn = totals()
        if (2 / ridge + rates.step) * np.sqrt(off) / rates.step <= SETTLED:
            break
        weight = 1.0 if turn > 0 else following
    else:
        warnings.warn(f"rates did not settle in {max_steps} steps", stacklevel=2)
    return rates, now


def with_rates(df: DataFrame, rates: Rates, n_domains: int, column: str = "rate") -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(rates)

    @F.arrow_udf(T.DoubleType())
    def rate_of(*shares: pa.Array) -> pa.Array:
        p = np.column_stack([s.to_numpy(zero_copy_only=False) for s in shares]) / STEPS
        return pa.array(sent.value.of(p)[0])

    return df.withColumn(column, rate_of(*[F.col(f"p{i}") for i in range(n_domains)]))


def draw(*keys: str) -> Column:
    """A number in [0, 1) for every row, a function of its key alone."""
    return F.pmod(F.xxhash64(F.lit(29), *keys), F.lit(1 << 40)).cast("double") / float(1 << 40)


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float], relative: bool = False, most: float | None = None,
    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, sample: int = SAMPLE,
) -> tuple[DataFrame, dict[str, float]]:
    """Rows of ``docs`` (columns ``carry``, by default all) with tokens, posteriors, ``rate`` and ``copies``; the totals reached.

    ``targets`` gives a wanted token total for each domain, as a share of all tokens, or with ``relative`` as
    a multiple of the domain's own expected total. ``copies`` is the whole part of the rate, plus one where a
    draw by the row's id and text falls below its fraction: expected copies equal the rate, and a retried task draws the same.

    Null and empty texts have no tokens and are judged like any other text. Equal rows have equal rates and draws. Null ids are drawn by
    their text. Rates that don't settle, and totals over TOLERANCE from their targets, give a warning. Without labels of two domains all posteriors are the prior. Columns of the input named like a result are replaced.
    """
    domains = tuple(targets)
    model = train(docs, labels, domains, id_col, text_col, sample)
    made = {"tokens", "rate", "copies", *[f"p_{d}" for d in domains]}
    names = [c for c in (docs.columns if carry is None else carry) if c not in made]
    keyed = row_key(with_posteriors(docs, model, text_col), id_col, text_col)
    judged = materialize(keyed.select(*[col(c) for c in names], "_id", "_t1", "_t2", "_j.*"), "posteriors")
    wanted = np.array([targets[d] for d in domains], dtype=float)
    if relative:
        sums = judged.agg(F.sum("tokens").alias("n"), *[F.sum(F.col("tokens") * F.col(f"p{i}") / STEPS).alias(f"m{i}") for i in range(len(domains))]).first()
        wanted = wanted * np.array([(sums[f"m{i}"] or 0.0) / (sums["n"] or 1) for i in range(len(domains))])
    rates, reached = fit_rates(judged, wanted, most=most)
    missed = {d: (round(float(r), 4), round(float(w), 4)) for d, r, w in zip(domains, reached, wanted, strict=True) if abs(r - w) > TOLERANCE}
    if missed and reached.any():
        warnings.warn(f"totals (reached, wanted) that no rates up to {most} meet: {missed}", stacklevel=2)
    out = with_rates(judged, rates, len(domains))
    copies = F.floor("rate") + (draw("_id", "_t1", "_t2") < F.col("rate") - F.floor("rate")).cast("long")
    out = out.withColumn("copies", copies)
    shares = [(F.col(f"p{i}") / STEPS).alias(f"p_{d}") for i, d in enumerate(domains)]
    return out.select(*[col(c) for c in names], "tokens", *shares, "rate", "copies"), dict(zip(domains, reached.tolist(), strict=True))


def op3_mixing(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    out, _ = mix(docs, domain_labels(table(spark, base, "labels")), TARGETS, carry=["doc_id"])
    return out


QUERIES = {"op3_mixing": op3_mixing}
SQL: dict[str, str] = {}
