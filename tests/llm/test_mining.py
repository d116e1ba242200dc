"""Runs, collocations and exact search against brute force on odd rows, on an empty table and with clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from casemill.llm import collocations, runs, topk

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(frame, odd_rows, clashing):
    return clashing(frame(odd_rows)).cache()


# ------------------------------------------------------------ 12

def runs_by_hand(w, p=runs.Runs()):
    out = []
    for q in range(1, len(w) // p.min_periods + 1):
        i = 0
        while i < len(w) - q:
            start = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            n = i - start + q
            if n >= max(p.min_length, p.min_periods * q):
                seg = w[start : start + n]
                if not any(seg[:-d] == seg[d:] for d in range(1, q)):
                    out.append((start, n, q))
            i = max(i, start + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(w):
    gone = set()
    for s, n, q in runs_by_hand(w):
        gone |= set(range(s + q, s + n))
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_texts(rnd, n):
    for _ in range(n):
        w, letters = [], rnd.choice([1, 2, 2, 3, 5, 20])
        for _ in range(rnd.randint(0, 6)):
            if rnd.random() < 0.6:
                base = [str(rnd.randint(0, letters)) for _ in range(rnd.randint(1, 12))]
                w += [base[i % len(base)] for i in range(rnd.randint(1, 9 * len(base)))]
            else:
                w += [str(rnd.randint(0, letters)) for _ in range(rnd.randint(0, 15))]
        yield " ".join(w)


def test_runs_of_chunks():
    rnd = random.Random(3)
    for _ in range(300):
        texts = list(periodic_texts(rnd, rnd.randint(1, 5)))
        _, symbols, doc, edge = runs.word_numbers([t.encode() for t in texts])
        found = runs.runs_of(symbols, doc, edge, runs.Runs())
        want = [(s + edge[d], s + n + edge[d], q) for d, t in enumerate(texts) for s, n, q in runs_by_hand(t.split())]
        assert [tuple(r) for r in found.tolist()] == want


def test_rules_spell_the_text():
    rnd = random.Random(4)
    symbols = np.array([rnd.randint(0, 3) for _ in range(2000)] + [7, 8] * 300)
    nodes, rest = runs.re_pair(symbols, np.zeros(len(symbols), int))
    spelled = defaultdict(set)
    for b, m, e, r in zip(nodes.begin, nodes.middle, nodes.end, nodes.rule):
        assert b < m < e
        spelled[r].add((tuple(symbols[b:e]), m - b))
    assert all(len(x) == 1 for x in spelled.values()) and len(rest) < 700


def test_periodic_runs(docs, odd_rows, frame, clashing):
    rnd = random.Random(9)
    more = [(1000 + i, t, "s") for i, t in enumerate(periodic_texts(rnd, 60))] + [(None, "a b " * 9, "s"), (1000, "z " * 30, None)]
    for df, rows in ((docs, odd_rows), (clashing(frame(more)), more)):
        got = Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in runs.periodic_runs(df).collect())
        words = [(i, SPACE.findall(t or "")) for i, t, _ in rows]
        assert got == Counter((i, len(w), tuple(runs_by_hand(w)), collapsed_by_hand(w)) for i, w in words)
    assert runs.periodic_runs(frame([])).count() == 0


def test_long_run_is_one_run():
    for text, want in (("a " * 100_000, [(0, 100_000, 1)]), ("a b c " * 30_000 + "d", [(0, 90_000, 3)])):
        _, symbols, doc, edge = runs.word_numbers([text.encode()])
        assert [(b, e - b, q) for b, e, q in runs.runs_of(symbols, doc, edge, runs.Runs()).tolist()] == want


# ------------------------------------------------------------ 13

def best_by_hand(rows, k=5, every=50, scale=256):
    usable = [(n, i, [math.floor(scale * x) for x in v]) for n, (i, v) in enumerate(rows)
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for n, i, q in usable:
        if i is None or i % every:
            continue
        hits = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0, m, j) for m, j, v in usable if m != n and len(v) == len(q))
        for rank, (s, _, _, _, j) in enumerate(hits[:k], 1):
            yield i, rank, j, -s


@pytest.mark.parametrize("p", [topk.TopK(), topk.TopK(queries=2, candidates=7, block=3, levels=(1, 2, 5))])
def test_top_k(spark, clashing, p):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [(i, [0.25] * 6) for i in range(200, 215)] + [(200, [0.25] * 6), (None, [9.0] * 6), (250, [1.0, 2.0]), (251, [3.0, 4.0]), (300, []), (301, [])]
    rows += [(350, None), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (450, [float("nan")] * 6), (500, [float("inf")] * 6), (-50, [-1.0] * 6)]
    rows += [(550, [3e5, 1.0, 1.0]), (551, [2e7, 5e6, 1 / 3]), (552, [2e7, 5e6, 1 / 2])]
    df = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4))
    got = Counter(tuple(r) for r in topk.top_k(df, p=p).select("query_id", "rank", "vec_id", "score").collect())
    assert got == Counter(best_by_hand(rows)) and len(got) > 20


def test_top_k_of_nothing(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0
    assert topk.top_k(spark.createDataFrame([(50, [1.0])], schema)).count() == 0


def test_coarse_levels_leave_candidates_out(monkeypatch):
    rng = np.random.default_rng(1)
    smooth = np.floor(256 * np.repeat(rng.normal(size=(2000, 4)), 8, axis=1) + rng.normal(size=(2000, 32)))
    scored = []
    exact = topk._exact
    monkeypatch.setattr(topk, "_exact", lambda x, at, q, sure: scored.append(len(at)) or exact(x, at, q, sure))
    number = np.arange(2000)
    found = topk.search_tile(smooth[:20], number[:20], smooth, number, number, topk.TopK())
    for i in range(20):
        s = smooth @ smooth[i]
        s[i] = -np.inf
        assert [c for q, c, _ in found if q == i] == np.lexsort((number, -s))[:5].tolist()
    assert sum(scored) < 0.25 * 20 * 2000


# ------------------------------------------------------------ 11

def collocations_by_hand(rows, p):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        plain = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, p.longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    for lang, count in f.items():
        often = {g: a for g, a in count.items() if len(g) > 1 and a >= p.least}
        out = []
        for g, a in often.items():
            if any(100 * b >= p.swallow * a for h, b in often.items() if len(h) > len(g)
                   and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))):
                continue
            score, k = min((p.scale * a // (count[g[:k]] + count[g[k:]]), k) for k in range(1, len(g)))
            out.append((-score, -a, " ".join(g).encode(), " ".join(g), count[g[:k]], count[g[k:]]))
        for rank, (s, a, _, phrase, left, right) in enumerate(sorted(out)[: p.first], 1):
            yield lang, rank, phrase, -a, left, right, total[lang], -s


PHRASES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("p", [
    collocations.Collocations(least=3, first=40), collocations.Collocations(least=2, chunk_words=60, segments_per_partition=9),
    collocations.Collocations(least=2, longest=2, chunk_words=500), collocations.Collocations(least=4, longest=3, swallow=50),
])
def test_collocations(spark, clashing, p):
    rnd = random.Random(6)
    vocabulary = ["a", "b", "New", "York", "é", "x\x1cy", "c\x01", "ünter", "d"] + [f"w{i}" for i in range(40)]
    rows = [(None, None), ("en", ""), ("en", " \t\n"), ("de", "a"), ("und", "new york new york"), (None, "New York, new york! NEW YORK"), ("en", "a " * 900),
            ("fr", "a b. " * 200)]
    for _ in range(150):
        text = "".join(rnd.choice(vocabulary[: rnd.choice([5, 9, 49])]) + rnd.choice([" "] * 8 + [", ", ".", "\t", "\n", "  "]) for _ in range(rnd.randint(1, 40)))
        rows.append((rnd.choice(["en", "en", "de", None]), text))
    df = clashing(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    got = Counter(tuple(r) for r in collocations.collocations(df, p).select(*PHRASES).collect())
    assert got == Counter(collocations_by_hand(rows, p)) and len(got) > 5


def test_collocations_of_nothing(frame):
    assert collocations.collocations(frame([])).count() == 0
    assert collocations.collocations(frame([(1, "once only", "s")])).count() == 0
