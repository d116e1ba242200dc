"""Mixing to target weights: soft domain membership, and nonnegative document rates by projected gradient.

A classifier fitted on the labelled table gives each document a probability for each domain. A document's rate says how
often it is to be read in an epoch. The rates solve, over all documents d and domains k,

    minimise  1/2 sum_k (sum_d rate_d * tokens_d * p_dk - target_k)^2 / spread_k  +  ridge/2 sum_d tokens_d * (rate_d - 1)^2
    subject to  rate_d >= 0

by projected gradient steps. First documents with like probabilities (cells of 1/``cells``, a few thousand at most)
take steps together until nothing moves any more; where that is so, a document's rate is ``max(0, 1 - p.g / ridge)`` with
the gradient g. From there on every document takes steps of its own: all of them follow from its probabilities and the
domain residuals of the steps before, so a step is one aggregation over the stored probabilities that returns one number per
domain. They end when no domain's total moves by more than ``tolerance`` of its target. No rate is stored between steps,
and a lost executor costs the recomputation of its part only. ``reached`` compares the totals with the targets: documents
may not be able to meet them (no document reads as toxic, say), and then the nearest totals are taken.

Features are counts over the text divided by its length (no label, language, source or id). The classifier is a softmax
regression on at most ``fit_rows`` labelled rows (those with the smallest hash of ``doc_id``); everything else covers all
documents. The three domains are ``good`` (quality 1, not toxic), ``weak`` (quality 0, not toxic) and ``toxic``.

Rows
    Null and empty text: 0 tokens, the domain shares of the labelled rows as probabilities, rate 1 from the ridge term. Null ids: a row
    like any other, never labelled. Null labels: not used for fitting. No labelled rows: equal probabilities. Empty
    table: no rows. A ``doc_id`` with several label rows counts once for each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casemill.functions.arrays import let
from casemill.llm.textbatch import chunks, column_bytes, words_of
from casemill.session import stage

DOMAINS = ("good", "weak", "toxic")


@dataclass(frozen=True)
class Mixing:
    # The wanted share of each domain, and the size of the epoch as a multiple of all tokens.
    weights: tuple[float, ...] = (0.92, 0.07, 0.01)
    epoch: float = 1.1
    fit_rows: int = 20_000
    slots: int = 256
    cells: int = 64
    steps: int = 12
    tolerance: float = 1e-3
    ridge: float = 2e-5
    seed: int = 7


def _features(texts: list[bytes], slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Words per document, and a dense row per document: word-hash shares (square roots) and shares of byte classes."""
    w = words_of(texts)
    n = np.diff(w.first)
    doc = np.repeat(np.arange(len(texts)), n)
    lower = (w.buffer | 0x20).astype(np.uint8)
    first = np.minimum(w.start + 3, np.maximum(w.end - 1, w.start))
    prefix = (lower[w.start].astype(np.int64) * 31 + lower[np.minimum(w.start + 1, first)]) * 31 + lower[np.minimum(w.start + 2, first)]
    slot = (prefix * 31 + lower[first]) * 0x9E3779B1 % (1 << 32) * slots >> 32
    bag = np.bincount(doc * slots + slot, minlength=len(texts) * slots).reshape(len(texts), slots)
    bag = np.sqrt(bag / np.maximum(n, 1)[:, None])
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    b = w.buffer
    kinds = [(b >= 65) & (b <= 90), (b >= 48) & (b <= 57), b >= 128, np.isin(b, list(b"#*$%&|<>!")), b == 10, np.isin(b, list(b".,"))]
    shares = [np.diff(np.concatenate([[0], np.cumsum(k)])[begin]) / np.maximum(np.diff(begin) - 1, 1) for k in kinds]
    return n, np.column_stack([bag, np.sqrt(np.array(shares).T), np.log1p(n)[:, None] / 10, np.ones(len(texts))])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labels: DataFrame, p: Mixing) -> np.ndarray:
    """Weights of the softmax regression (features by domains), from at most ``fit_rows`` labelled rows."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1)
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").select("doc_id", domain.alias("domain"))
    chosen = known.withColumn("order", F.xxhash64("doc_id", F.lit(p.seed))).orderBy("order", "doc_id").limit(p.fit_rows)
    # one text for each id, so that no more rows than chosen labels come to the driver
    texts = docs.select("doc_id", "text").join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = texts.join(chosen.select("doc_id", "domain"), "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for domain, texts in chunks(batch.column("domain").to_pylist(), column_bytes(batch, "text")):
                x = _features(texts, p.slots)[1].astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(domain, pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], names=["domain", "x"])

    size = p.slots + 8
    found = rows.mapInArrow(task, "domain int, x binary").toPandas()
    if not len(found):
        return np.zeros((size, len(DOMAINS)))
    x = np.frombuffer(b"".join(found["x"]), np.float32).reshape(-1, size).astype(np.float64)
    y = np.eye(len(DOMAINS))[found["domain"].to_numpy()]
    order = np.lexsort([*x.T[::17], found["domain"].to_numpy()])
    x, y = x[order], y[order]
    w, speed = np.zeros((size, len(DOMAINS))), np.zeros((size, len(DOMAINS)))
    rate = 1.0 / max(1.0, float(np.linalg.eigvalsh(x.T @ x / len(x))[-1]) / 2)
    for _ in range(400):
        grad = x.T @ (_softmax(x @ w) - y) / len(x) + 1e-5 * w
        speed = 0.95 * speed - rate * grad
        w = w + speed
    return w


def memberships(docs: DataFrame, weights: np.ndarray, p: Mixing) -> DataFrame:
    """``doc_id, text_row, n_tokens, p`` (probabilities in the order of DOMAINS)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in chunks(batch.column("doc_id").to_pylist(), column_bytes(batch, "text")):
                n, x = _features(texts, p.slots)
                post = _softmax(x @ weights)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                    pa.FixedSizeListArray.from_arrays(pa.array(post.ravel()), len(DOMAINS)).cast(pa.list_(pa.float64())),
                ], names=["doc_id", "n_tokens", "p"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id bigint, n_tokens bigint, p array<double>")


def _rate(start: np.ndarray, steps: list[list[float]], ridge: float, step: float, ahead: bool = False) -> Column:
    """The rate after the steps so far, or the point ahead of it where the next gradient is taken.

    A step subtracts the gradient per token at the point ahead, then cuts at 0; the next point ahead goes on in the
    direction of the step (the accelerated form of projected gradient)."""
    pull = lambda g: sum((F.get("p", F.lit(k)) * g(k) for k in range(len(DOMAINS))), F.lit(0.0))
    first = F.greatest(F.lit(0.0), F.lit(1.0) - pull(lambda k: F.lit(float(start[k]))) / F.lit(ridge))
    if not steps:
        return first
    history = F.array(*[F.array(*[F.lit(float(v)) for v in (*g, _momentum(t))]) for t, g in enumerate(steps)])
    begin = let(first, lambda r: F.struct(r.alias("rate"), r.alias("ahead")))

    def follow(s: Column, g: Column) -> Column:
        new = F.greatest(F.lit(0.0), s["ahead"] - F.lit(step) * (
            pull(lambda k: F.get(g, F.lit(k))) + F.lit(ridge) * (s["ahead"] - F.lit(1.0))))
        return F.struct(new.alias("rate"), (new + F.get(g, F.lit(len(DOMAINS))) * (new - s["rate"])).alias("ahead"))

    return F.aggregate(history, begin, follow)["ahead" if ahead else "rate"]


def _momentum(t: int) -> float:
    return t / (t + 3.0)


def _settled(prob: np.ndarray, tokens: np.ndarray, target: np.ndarray, scale: np.ndarray, step: float, ridge: float) -> np.ndarray:
    """The gradient per token where projected gradient on the cells comes to rest; momentum starts anew when it overshoots.
    ``tokens`` and ``target`` are shares of all tokens."""
    rate = ahead = np.ones(len(tokens))
    t = 0
    for _ in range(100_000):
        g = ((tokens * ahead) @ prob - target) / scale**2
        new = np.maximum(0.0, ahead - step * (prob @ g + ridge * (ahead - 1.0)))
        moved = new - rate
        t = 0 if (ahead - new) @ moved > 0 else t + 1
        rate, ahead = new, new + _momentum(t) * moved
        if np.abs(moved).max() < 1e-12:
            break
    return ((tokens * rate) @ prob - target) / scale**2


def mixing_rates(docs: DataFrame, labels: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """``doc_id, n_tokens, p_good, p_weak, p_toxic, rate`` for every document."""
    members = stage(memberships(docs, fit_domains(docs, labels, p), p), "mixing-members")
    k = range(len(DOMAINS))
    parts = [(F.col("n_tokens") * F.get("p", F.lit(i))) for i in k]
    out = members.select("doc_id", "n_tokens", *[F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "p")
    cell = [F.floor(F.get("p", F.lit(i)) * p.cells).alias(f"c{i}") for i in k]
    grams = [F.sum(F.get("p", F.lit(i)) * parts[j]).alias(f"g{i}{j}") for i in k for j in k]
    cells = members.groupBy(*cell).agg(F.sum("n_tokens").cast("double").alias("n"), *[F.sum(parts[i]).alias(f"s{i}") for i in k], *grams).where("n > 0")
    found = cells.orderBy(*[f"c{i}" for i in k]).toPandas()
    tokens = float(found["n"].sum()) if len(found) else 0.0
    if tokens == 0:
        return out.drop("p").withColumn("rate", F.lit(1.0))
    target = p.epoch * np.array(p.weights)
    share = found["n"].to_numpy() / tokens
    prob = found[[f"s{i}" for i in k]].to_numpy() / found["n"].to_numpy()[:, None]
    gram = np.array([found[f"g{i}{j}"].sum() for i in k for j in k]).reshape(len(k), len(k)) / tokens
    # the residual of each domain is taken in units of the tokens it holds, so no domain is too small to be steered
    scale = np.maximum(np.sqrt(np.diag(gram)), 1e-9)
    step = 1.0 / (float(np.linalg.eigvalsh(gram / np.outer(scale, scale))[-1]) + p.ridge)
    start = _settled(prob, share, target, scale, step, p.ridge)
    steps: list[list[float]] = []
    before = np.full(len(k), np.inf)
    while len(steps) < p.steps:
        now = members.withColumn("_r", _rate(start, steps, p.ridge, step, ahead=True)).agg(
            *[F.sum(F.col("_r") * parts[i]).alias(f"s{i}") for i in k]).first()
        sums = np.array([float(now[f"s{i}"]) for i in k]) / tokens
        steps.append(((sums - target) / scale**2).tolist())
        if (np.abs(sums - before) <= p.tolerance * target).all():
            break
        before = sums
    return out.withColumn("rate", _rate(start, steps, p.ridge, step)).drop("p")


def reached(rates: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """``domain, target, expected``: the wanted tokens of each domain and the expected ones under the rates."""
    sums = rates.agg(F.sum("n_tokens").alias("all"), *[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS])
    rows = F.array(*[F.struct(F.lit(d).alias("domain"), (F.col("all") * F.lit(p.epoch * w)).alias("target"), F.col(d).alias("expected"))
                     for d, w in zip(DOMAINS, p.weights)])
    return sums.select(F.inline(rows))


def mixed(docs: DataFrame, labels: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """The documents as often as their rate says; all columns stay. The fraction of a rate is rounded up or down by a
    hash of the id, so the expected count is the rate. Rows of one id share one count, that of their longest text."""
    rates = mixing_rates(docs, labels, p).where("doc_id is not null").groupBy("doc_id").agg(
        F.max_by("rate", F.struct("n_tokens", "rate")).alias("rate"))
    dice = F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = (F.floor("rate") + F.when(dice < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    # the rows of docs travel as one column, so that none of their names can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    out = rows.join(rates.select("doc_id", times.alias("times")), F.col("doc.doc_id") == F.col("doc_id"), "left")
    out = out.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.coalesce("times", F.lit(1)))))
    return out.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
