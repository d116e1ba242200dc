"""Toxicity: a lexicon trie walked with Levenshtein automata, and windows of context around the hits.

The lexicon is learnt: whole words and word beginnings that mark toxic documents in a bounded sample of labelled rows
(``fit_rows``, those with the smallest hash of the id; rows held out are never used). A word hits an entry exactly, or
within one edit (insert, delete, replace, swap) of an entry of at least ``fuzzy_from`` letters (``fuzzy_beginnings_from`` for beginnings); a whole word of
``short_from`` letters up to that takes a replaced, swapped or doubled letter. A whole word that gives way to its beginning stays an entry for
near matches only (its name ends with ``~``). The automaton of the word runs down the trie and gives up a branch as soon as no entry below it can be near enough. Entries that are word
beginnings accept when some beginning of the word is near enough. It runs only for words that share a form with an
entry after one letter at most is left out of either, as all words within one edit do.

Hits are weighted by their log-odds and summed over windows of ``window`` words; a hit between quotation marks counts as
quoted, not as abuse. The sums, the densest window and the kind of hits are the inputs of a logistic regression on
the same sample. Label, language, source and id are no inputs.

Rows
    Null and empty text: no hits, the score of a text without hits. Null ids: not held out, no label. Null labels: not
    used. No labelled rows, or labels of one class only: score 0 for all. Repeated rows: a row each. A row with several
    labels is used once for each. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casemill.session import stage


@dataclass(frozen=True)
class Toxicity:
    fit_rows: int = 30_000
    entries: int = 400
    min_documents: int = 4
    min_odds: float = 2.5
    beginnings: tuple[int, ...] = (3, 4, 5, 6, 7)
    longest: int = 14
    fuzzy_from: int = 5
    short_from: int = 4
    fuzzy_beginnings_from: int = 5
    window: int = 12
    threshold: float = 0.3
    cache: int = 300_000


_OUTSIDE = re.compile(r"[^\w]+")
_MARKS = re.compile("[\"“”„«»‘’]")
# Quotation marks that open, with those that close them.
_CLOSED_BY = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’"}
FEATURES = 11


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def plain_words(text: str) -> list[str]:
    """Lower-cased words at white space, without marks at their ends or in them."""
    return [_OUTSIDE.sub("", w) for w in text.lower().split()]


# ---------------------------------------------------------------- lexicon

def learn_lexicon(sample: DataFrame, p: Toxicity) -> list[tuple[str, float]]:
    """Entries with their log-odds; a whole word ends with ``$``. At most ``entries`` of them come to the driver."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            batch = pa.RecordBatch.from_arrays([
                pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64()),
            ], names=["term", "pos", "neg"])
            counts[0].clear()
            counts[1].clear()
            return batch

        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                words = set(plain_words(text or ""))
                terms = {w[:k] for w in words for k in p.beginnings if len(w) >= k}
                terms |= {w + "$" for w in words if 3 <= len(w) <= p.longest}
                counts[1 if toxic else 0].update(terms)
                if len(counts[0]) > 300_000:
                    yield out()
        yield out()

    sums = sample.mapInArrow(task, "term string, pos bigint, neg bigint").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = sample.agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")).first()
    n_pos, n_neg = totals["pos"] or 0, totals["neg"] or 0
    if not n_pos or not n_neg:
        return []
    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    best = (sums.where(F.col("pos") >= max(p.min_documents, n_pos // 250)).withColumn("odds", odds).where(F.col("odds") >= p.min_odds)
            .orderBy(F.desc(F.col("odds") * F.sqrt("pos")), "term").limit(8 * p.entries).collect())
    found = {r["term"]: (r["pos"], r["odds"]) for r in best}
    entries = _distinct(found)[: p.entries]
    return entries + _near_only(found, entries, p)


def _near_only(found: dict[str, tuple[int, float]], entries: list[tuple[str, float]], p: Toxicity) -> list[tuple[str, float]]:
    """Whole words that gave way to a beginning among the entries."""
    have = {t for t, _ in entries}
    words = sorted(t for t in found if t.endswith("$") and t not in have and len(t) > p.short_from)
    return [(t[:-1] + "~", float(found[t][1])) for t in words if any(t[:k] in have for k in range(2, len(t)))]


def _distinct(found: dict[str, tuple[int, float]]) -> list[tuple[str, float]]:
    """Of entries that say the same, the most general whole one: a word before its beginnings, a beginning before longer ones."""
    out = dict(found)
    for t, (pos, odds) in found.items():
        bare = t.rstrip("$")
        for k in range(2, len(bare) + (t != bare)):
            short = bare[:k]
            if short == t or short not in found:
                continue
            if t != bare and pos >= 0.8 * found[short][0]:
                out.pop(short, None)  # the beginning is this word
            elif odds <= found[short][1] + 0.7 and short in out:
                out.pop(t, None)
    order = sorted(out, key=lambda t: (-out[t][1] * out[t][0] ** 0.5, t))
    return [(t, float(out[t][1])) for t in order]


@dataclass
class _Node:
    below: dict[str, _Node] = field(default_factory=dict)
    word: int = -1
    beginning: int = -1


def _without_one(w: str) -> list[str]:
    return [w, *[w[:j] + w[j + 1 :] for j in range(len(w))]]


class Lexicon:
    def __init__(self, entries: list[tuple[str, float]], p: Toxicity):
        self.weights, self.p, self.root = [w for _, w in entries], p, _Node()
        self.exact: dict[str, int] = {}
        self.known: dict[str, tuple[int, bool] | None] = {}
        self.start_lengths = {len(t) for t, _ in entries if t[-1] not in "$~"}
        self.longest = max((len(t.rstrip("$~")) for t, _ in entries), default=0)
        # entries and what is left of them without one letter
        self.around_words: set[str] = set()
        self.around_starts: set[str] = set()
        self.word_lengths: set[int] = set()
        self.beginning_lengths: set[int] = set()
        for i, (term, _) in enumerate(entries):
            bare = term.rstrip("$~")
            if not term.endswith("~"):
                self.exact[term] = i
            if len(bare) < (p.short_from if bare != term else p.fuzzy_beginnings_from):
                continue
            node = self.root
            for c in bare:
                node = node.below.setdefault(c, _Node())
            around, lengths = (self.around_words, self.word_lengths) if bare != term else (self.around_starts, self.beginning_lengths)
            if bare != term:
                node.word = i
            else:
                node.beginning = i
            around.update(_without_one(bare))
            lengths.update((len(bare) - 1, len(bare), len(bare) + 1))

    def _may_be_near(self, w: str) -> bool:
        if len(w) in self.word_lengths and not self.around_words.isdisjoint(_without_one(w)):
            return True
        return any(n <= len(w) and not self.around_starts.isdisjoint(_without_one(w[:n])) for n in self.beginning_lengths)

    def _accepts(self, bare: str, word: str) -> bool:
        """Of a short whole word only a replaced, swapped or doubled letter is near."""
        return (len(bare) >= self.p.fuzzy_from or len(word) == len(bare)
                or any(word[j] == word[j - 1] and word[:j] + word[j + 1 :] == bare for j in range(1, len(word))))

    def hit(self, w: str) -> tuple[int, bool] | None:
        """Entry and whether the word is spelt as the entry."""
        if w in self.known:
            return self.known[w]
        found = None
        i = self.exact.get(w + "$")
        if i is None:
            i = max((j for k in self.start_lengths if (j := self.exact.get(w[:k])) is not None), key=self.weights.__getitem__, default=None)
        if i is not None:
            found = (i, True)
        elif len(w) >= min(self.p.fuzzy_from, self.p.fuzzy_beginnings_from) - 1 and self._may_be_near(w):
            i = self._near(w)
            found = None if i is None else (i, False)
        if len(self.known) > self.p.cache:
            self.known.clear()
        self.known[w] = found
        return found

    def _near(self, word: str) -> int | None:
        """The heaviest entry within one edit: the trie is walked with the states of the word's automaton, the
        distances of all its beginnings; states above one edit are dead."""
        best: int | None = None
        word = word[: self.longest + 2]  # what comes later can not bring it nearer
        stack = [(self.root, "", list(range(len(word) + 1)), None)]
        while stack:
            node, so_far, row, before = stack.pop()
            last = so_far[-1:]
            for e in ([node.word] if row[-1] <= 1 and self._accepts(so_far, word) else []) + ([node.beginning] if min(row) <= 1 else []):
                if e >= 0 and (best is None or self.weights[e] > self.weights[best]):
                    best = e
            for c, below in node.below.items():
                step = [row[0] + 1]
                for j, x in enumerate(word):
                    d = min(step[j] + 1, row[j + 1] + 1, row[j] + (x != c))
                    if before is not None and j and x == last and word[j - 1] == c:
                        d = min(d, before[j - 1] + 1)
                    step.append(d)
                if min(step) <= 1:
                    stack.append((below, so_far + c, step, row))
        return best


# ---------------------------------------------------------------- scores

def quoted_words(text: str) -> set[int]:
    """Numbers of the words between a mark that opens and one that closes it on the same line. A mark between two letters
    is an apostrophe; one that nothing closes quotes nothing."""
    out, n = set(), 0
    for line in text.split("\n"):
        opened, since = "", 0
        for i, w in enumerate(line.split(), n):
            n = i + 1
            for m in _MARKS.finditer(w):
                mark, a, b = m[0], m.start(), m.end()
                if mark in "‘’" and w[a - 1 : a].isalnum() and w[b : b + 1].isalnum():
                    continue
                if opened and mark in _CLOSED_BY[opened]:
                    out.update(range(since, i + 1))
                    opened = ""
                elif mark in _CLOSED_BY and opened in ("", "‘"):
                    opened, since = mark, i
    return out


def features(text: str, lexicon: Lexicon) -> list[float]:
    words = plain_words(text)
    p, weights = lexicon.p, lexicon.weights
    hits = [(i, h) for i, w in enumerate(words) if w and (h := lexicon.hit(w))]
    quoted = quoted_words(text) if hits and _MARKS.search(text) else set()
    abuse = [(i, weights[e] * (1.0 if exact else 0.5)) for i, (e, exact) in hits if i not in quoted]
    densest, low, total = 0.0, 0, 0.0
    for k, (i, v) in enumerate(abuse):
        total += v
        while abuse[low][0] <= i - p.window:
            total -= abuse[low][1]
            low += 1
        densest = max(densest, total)
    exact = {e for i, (e, ok) in hits if ok and i not in quoted}
    fuzzy = {e for i, (e, ok) in hits if not ok and i not in quoted}
    n = len(words)
    strong = sorted((weights[e] for e in exact), reverse=True)[:3] + [0.0] * 3
    return [
        min(len(exact), 6) / 3, min(len(fuzzy), 6) / 3, sum(strong[:3]) / 6, strong[0] / 5,
        np.log1p(sum(weights[e] for e in fuzzy)), densest / 10, np.log1p(sum(v for _, v in abuse)),
        np.log1p(100 * sum(v for _, v in abuse) / max(n, 20)), min(sum(i in quoted for i, _ in hits), 6) / 3,
        np.log1p(n) / 5 if hits else 0.0, 1.0,
    ]


def _scored(docs: DataFrame, lexicon: list[tuple[str, float]], weights: np.ndarray | None, p: Toxicity, extra: str, kind: str) -> DataFrame:
    """``extra`` column with the features (no weights) or the score of each text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon(lexicon, p)
        for batch in batches:
            rows = [features(t.as_py() or "", lex) for t in batch.column("text")]
            keys = batch.column(extra)
            if weights is None:
                yield pa.RecordBatch.from_arrays([keys, pa.array(rows, pa.list_(pa.float64()))], names=[extra, "x"])
            else:
                score = 1 / (1 + np.exp(-np.clip(np.array(rows).reshape(-1, FEATURES) @ weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(score)], names=[extra, "score"])

    return docs.select(extra, "text").mapInArrow(task, f"{extra} {kind}, " + ("x array<double>" if weights is None else "score double"))


def fit(docs: DataFrame, labels: DataFrame, p: Toxicity) -> tuple[list[tuple[str, float]], np.ndarray | None]:
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(p.fit_rows)
    # at most fit_rows ids and labels: bounded, so the texts need no shuffle
    sample = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "toxic-sample")
    lexicon = learn_lexicon(sample, p)
    if not lexicon:
        return [], None
    rows = _scored(sample, lexicon, None, p, "toxic", "int").toPandas()
    x, y = np.array(rows["x"].tolist()), rows["toxic"].to_numpy(np.float64)
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    w = np.zeros(FEATURES)
    for _ in range(30):  # Newton steps
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = 1e-3 * len(x) * np.eye(FEATURES)
        ridge[-1, -1] = 1e-9
        w = w - np.linalg.solve((x * (q * (1 - q) + 1e-9)[:, None]).T @ x + ridge, x.T @ (q - y) + ridge @ w)
    return lexicon, w


def toxicity(docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    lexicon, weights = fit(docs, labels, p)
    if weights is None:
        scored = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:
        scored = _scored(docs, lexicon, weights, p, "doc_id", "bigint")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= p.threshold, 1).otherwise(0).alias("predicted"))
