"""Latent topics by online variational Bayes (Hoffman, Blei, Bach 2010): the rules of Spark's ``LDA`` with all texts in every
step, in Arrow batches where the counts lie.

A text's topic weights are the fixed point of its own update, reached when two steps in a row differ by ``CLOSE`` for each
topic on average. The plain update needs hundreds of steps while the topics are still alike; here two plain steps give the
direction and the length of a longer one (squared extrapolation, Varadhan and Roland 2008), cut where a weight would fall below
its prior. Texts of a batch are worked on together, ordered by their number of terms, and leave it when they are done, so a
result does not depend on the texts beside it. All texts start from equal weights: no random numbers by partition.

A step hands on one row for each term and task; the driver holds the weights of the vocabulary, which is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casemill.operators.vectors import Vocabulary, _parts

# Those of Spark's LDA.
STEPS = 10
CLOSE = 1e-3
SHAPE = 100.0  # of the gamma distribution the topics start from
TAU, KAPPA = 1024.0, 0.51  # a step weighs (TAU + number) ** -KAPPA
LONGEST = 64.0  # times a plain step
ROUNDS = 100  # of longer steps; then plain ones, which always come to an end
CELLS = 65_536  # terms of texts that are worked on together
TINY = 1e-100


def digamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    f = 1 / (y * y)
    below = 1 / x + 1 / (x + 1) + 1 / (x + 2) + 1 / (x + 3) + 1 / (x + 4) + 1 / (x + 5)
    return np.log(y) - 0.5 / y - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132)))) - below


def trigamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    f = 1 / (y * y)
    below = sum(1 / ((x + i) * (x + i)) for i in range(6))
    return 1 / y + f / 2 + f / y * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f * (1 / 30 - f * 5 / 66)))) + below


def expected_log(weights: np.ndarray) -> np.ndarray:
    """Of the shares of a Dirichlet distribution, along the last axis."""
    return digamma(weights) - digamma(weights.sum(axis=-1, keepdims=True))


def _fixed_points(held: np.ndarray, n: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """``held``: texts x terms x topics, ``n``: how often a text holds its terms, 0 beyond its last."""
    def update(g: np.ndarray) -> np.ndarray:
        share = np.exp(expected_log(g))
        norm = np.matmul(held, share[:, :, None])[:, :, 0] + TINY
        return share * np.matmul((n / norm)[:, None, :], held)[:, 0, :] + alpha

    found, left = np.empty((len(n), len(alpha))), np.arange(len(n))
    g = update(np.ones_like(found))
    for rounds in count():
        first = update(g)
        second = update(first)
        done = np.abs(second - first).mean(axis=1) <= CLOSE
        if done.any():
            found[left[done]] = second[done]
            if done.all():
                return found
            on = ~done
            left, held, n, g, first, second = left[on], held[on], n[on], g[on], first[on], second[on]
        if rounds >= ROUNDS:
            g = second
            continue
        r = first - g
        v = second - first - r
        length = np.sqrt((r * r).sum(axis=1) / np.maximum((v * v).sum(axis=1), TINY)).clip(1, LONGEST)[:, None]
        beyond = np.maximum(g + 2 * length * r + length * length * v - alpha, 0)
        total = beyond.sum(axis=1, keepdims=True)
        inside = second - alpha  # the words of the text are shared out in full
        g = alpha + np.where(total > 0, beyond * (inside.sum(axis=1, keepdims=True) / np.where(total > 0, total, 1)), inside)


def topic_weights(begin: np.ndarray, term: np.ndarray, n: np.ndarray, beta: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Topic weights of texts; text ``i`` holds ``n`` of ``term`` from ``begin[i]`` to ``begin[i + 1]``. A text without terms has
    the prior."""
    found = np.tile(alpha, (len(begin) - 1, 1))
    size = np.diff(begin)
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0]
    i = 0
    while i < len(order):
        cells = size[order[i:i + CELLS]] * np.arange(1, len(order[i:i + CELLS]) + 1)
        j = i + max(int(np.searchsorted(cells, CELLS, "right")), 1)
        texts = order[i:j]
        inside = np.arange(size[texts[-1]]) < size[texts, None]
        at = np.where(inside, begin[texts, None] + np.arange(size[texts[-1]]), 0)
        found[texts] = _fixed_points(beta[term[at]], np.where(inside, n[at], 0.0), alpha)
        i = j
    return found


def _statistics(begin: np.ndarray, term: np.ndarray, n: np.ndarray, beta: np.ndarray, share: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` (terms x topics) how often the texts hold a term, shared out among the topics."""
    ends = [*(np.flatnonzero(np.diff(begin[1:] // CELLS)) + 1), len(begin) - 1]
    for i, j in zip([0, *ends], ends):
        part = slice(begin[i], begin[j])
        of_text = np.repeat(share[i:j], np.diff(begin[i:j + 1]), axis=0)
        ratio = n[part] / (np.einsum("ij,ij->i", beta[term[part]], of_text) + TINY)
        for t in range(out.shape[1]):
            out[:, t] += np.bincount(term[part], ratio * of_text[:, t], len(out))


def _counts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    term, n = batch.column(0), batch.column(1)
    lengths = term.value_lengths().to_numpy(zero_copy_only=False)
    begin = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return begin, term.flatten().to_numpy().astype(np.int64), n.flatten().to_numpy().astype(float)


def fit_topics(counts: DataFrame, terms: int, k: int, seed: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the terms in each topic (topics x terms) and the prior of the topics, from a stored table ``term, n``: the
    numbers of the terms of a text and how often it holds them. The table is read ``steps`` times."""
    context = counts.sparkSession.sparkContext
    topics, alpha = np.random.default_rng(seed).gamma(SHAPE, 1 / SHAPE, (k, terms)), np.full(k, 1 / k)
    columns = [f"s{t}" for t in range(k)]
    schema = ", ".join(["term int", *(f"{c} double" for c in columns)])
    for number in range(1, steps + 1):
        beta = np.exp(expected_log(topics)).T.copy()
        sent = context.broadcast((beta, alpha))

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            beta, alpha = sent.value
            found = np.zeros((terms + 2, k))  # the logarithms and the number of texts come last
            for begin, term, n in map(_counts, batches):
                weights = topic_weights(begin, term, n, beta, alpha)
                logs = expected_log(weights)
                _statistics(begin, term, n, beta, np.exp(logs), found[:terms])
                filled = np.diff(begin) > 0
                found[terms] += logs[filled].sum(axis=0)
                found[terms + 1] += filled.sum()
            at = np.flatnonzero(found.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(found[at, t]) for t in range(k))], ["term", *columns])

        added = counts.select("term", "n").mapInArrow(step, schema).groupBy("term").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
        sent.destroy()
        total = np.zeros((terms + 2, k))
        total[added.column("term").to_numpy()] = np.stack([added.column(c).to_numpy() for c in columns], axis=1)
        texts = total[terms + 1, 0]
        if not texts:
            break
        weight = (TAU + number) ** -KAPPA
        topics = (1 - weight) * topics + weight * ((total[:terms] * beta).T + 1 / k)
        alpha = _next_prior(alpha, total[terms] / texts, texts, weight)
    return topics, alpha


def _next_prior(alpha: np.ndarray, logs: np.ndarray, texts: float, weight: float) -> np.ndarray:
    """A weighted Newton step towards the prior under which the mean logarithms are most likely; none that leaves the positive."""
    gradient = texts * (logs - expected_log(alpha))
    c, q = texts * trigamma(alpha.sum()), -texts * trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - weight * (gradient - b) / q
    return moved if (moved > 0).all() else alpha


class Topics:
    """A fitted model that takes texts; the numbers of its terms are made once in a process."""

    def __init__(self, terms: Sequence[str], topics: np.ndarray, alpha: np.ndarray, stop_words: Sequence[str]) -> None:
        self.known, self.stop_words = Vocabulary(terms), pa.array(stop_words, pa.string())
        self.beta, self.alpha = np.exp(expected_log(topics)).T.copy(), alpha

    def _shares(self, texts: pa.Array) -> np.ndarray:
        doc, term, n = self.known.held(texts, self.stop_words)
        begin = np.searchsorted(doc, np.arange(len(texts) + 1))
        weights = topic_weights(begin, term, n.astype(float), self.beta, self.alpha)
        weights[np.diff(begin) == 0] = 0
        return weights / np.maximum(weights.sum(axis=1, keepdims=True), TINY)

    def shares(self, texts: pa.Array) -> pa.Array:
        """The shares of the topics in each cleaned text; zeros where it holds no known term."""
        found = np.concatenate([self._shares(part) for part in _parts(texts)])
        ends = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
