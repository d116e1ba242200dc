"""Periodic runs of words, found through a grammar, and texts with their repetitions collapsed.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
``max(min_length, min_periods * q)`` long, that no neighbouring word extends. A word is dropped from the collapsed text
if some run contains it after that run's first q words. Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``.

Rows
    Null, empty and blank texts: no words, no runs, empty collapsed text. Repeated rows and null ids are documents of
    their own. A very long text is a chunk of its own. Empty table: no rows. Other columns are ignored.

Method
    * Re-Pair, for all documents of a chunk at once: in each round a pair of symbols that occurs more than once in its
      document becomes a rule, unless a more frequent pair (ties: by a scrambled pair number) overlaps it. All uses of
      a rule are known by their place, so together with the sequence left at the end they are the derivation tree.
    * A run lies in the expansion of the lowest node that holds it and crosses that node's middle. So only runs across
      the middle of each rule are looked for, once per rule, and across the seams of the sequence that is left.
    * Periods: a run across a middle has four periods, so a string of 2^j words (2^j at least q, less than 2q) at
      one of three places about the middle lies in it with a copy q away, and as it holds a whole period, no copy is
      nearer. Names of such strings come by doubling from those that occur three times in the document.
    * Runs found in a rule are copied to all its uses. Pieces with equal period that share q words are one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casemill.llm.textbatch import U, chunks, column_bytes, mix


@dataclass(frozen=True)
class Runs:
    min_length: int = 6
    min_periods: int = 4
    chunk_bytes: int = 1 << 20

    def __post_init__(self) -> None:
        if self.min_periods < 4:
            raise ValueError("periods are found through strings that occur three times: ask for four periods at least")


@dataclass
class Nodes:
    """Places of a derivation: first word, first word of the right half, end, and number of the rule."""

    begin: np.ndarray
    middle: np.ndarray
    end: np.ndarray
    rule: np.ndarray


def word_numbers(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, a number for each (same word of the same document: same number), the document of each word
    and where each document begins (total at the end)."""
    words = [t.split() for t in texts]
    numbers: list[int] = []
    known = 0
    for w in words:
        own = dict(zip(dict.fromkeys(w), count(known)))
        known += len(own)
        numbers.extend(map(own.__getitem__, w))
    edge = np.cumsum([0] + [len(w) for w in words])
    return words, np.array(numbers, np.int64), np.repeat(np.arange(len(words)), np.diff(edge)), edge


def grouped(place: np.ndarray, key: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs at least ``times`` often, by key and place, the group of each (by key) and the groups' sizes.
    ``place`` ascends."""
    bits = int(place[-1]).bit_length()
    if int(key.max()) >> (64 - bits):
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
    else:  # one sort of whole numbers takes a tenth of the time of a sort of positions
        both = np.sort(key << U(bits) | place.astype(U))
        key, place = both >> U(bits), (both & U((1 << bits) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    often = size >= times
    return place[np.repeat(often, size)], np.repeat(np.arange(int(often.sum())), size[often]), size[often]


def _pairs(left: np.ndarray, right: np.ndarray, numbers: int) -> np.ndarray:
    return left.astype(U) << U(max(numbers, 1).bit_length()) | right.astype(U)


def re_pair(symbols: np.ndarray, doc: np.ndarray) -> tuple[Nodes, np.ndarray]:
    """Uses of all rules, and where the symbols of the sequences that are left begin."""
    n = len(symbols)
    symbols, begin = symbols.copy(), np.arange(n)
    live = np.zeros(n, bool)  # the pair that begins here may occur more than once
    live[:-1] = doc[1:] == doc[:-1]
    rules, uses = n, []
    while live.any():
        at = np.flatnonzero(live)
        at, pair, size = grouped(at, _pairs(symbols[at], symbols[at + 1], rules), 2)
        if not len(at):
            break
        rank = np.empty(len(size), np.int64)
        rank[np.lexsort((mix(np.arange(len(size), dtype=U)), size))] = np.arange(len(size))
        order = np.argsort(at)
        at, pair = at[order], pair[order]
        rank = rank[pair]
        # stretches of one pair (as in a a a a): every other place; a stretch gives way to a better one beside it
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (rank[1:] != rank[:-1])
        first = np.flatnonzero(new)
        stretch = np.cumsum(new) - 1
        best, touch = rank[first], at[first[1:]] == at[first[1:] - 1] + 1
        wins = np.ones(len(first), bool)
        wins[1:] &= ~touch | (best[1:] > best[:-1])
        wins[:-1] &= ~touch | (best[:-1] > best[1:])
        chosen = wins[stretch] & ((at - at[first][stretch]) % 2 == 0)
        take = at[chosen]
        names, name = np.unique(pair[chosen], return_inverse=True)
        end = np.append(begin[1:], n)
        uses.append((begin[take], begin[take + 1], end[take + 1], rules + name))
        live[:] = False
        live[at] = True
        symbols[take] = rules + name
        rules += len(names)
        made = np.zeros(len(symbols), bool)
        made[take] = True
        stays = np.ones(len(symbols), bool)
        stays[take + 1] = False
        symbols, begin, doc, live, made = symbols[stays], begin[stays], doc[stays], live[stays], made[stays]
        live |= made
        live[:-1] |= made[1:]
        live[:-1] &= doc[1:] == doc[:-1]
        live[-1] = False
    return Nodes(*[np.concatenate(x) if uses else np.zeros(0, np.int64) for x in (zip(*uses) if uses else [()] * 4)]), begin


def possible_periods(symbols: np.ndarray, end: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, np.ndarray]:
    """Node numbers and periods of all runs that may cross a node's middle. ``end``: of the document, for each word."""
    n, width = len(symbols), 1
    place, key = np.arange(n), symbols.astype(U)
    found = [np.zeros((2, 0), np.int64)]
    while len(place):
        place, name, size = grouped(place, key, 3)
        gap = place[1:] - place[:-1]
        near = np.flatnonzero((name[1:] == name[:-1]) & (2 * gap > width) & (gap <= width))
        if len(near):
            after, before = np.zeros(n, np.int32), np.zeros(n, np.int32)
            after[place[near]] = gap[near]
            before[place[near + 1]] = gap[near]
            large = np.flatnonzero(nodes.end - nodes.begin > 2 * width)  # such a run has 4q > 2 width words
            for back, table, sign in ((0, after, 1), (width, before, -1), (width // 2, after, 1), (width // 2, before, -1)):
                anchor = nodes.middle[large] - back
                hit = table[anchor] > 0  # an anchor before the node may wrap around; it is sorted out below
                node, anchor = large[hit], anchor[hit]
                q = table[anchor].astype(np.int64)
                low, high = np.minimum(anchor, anchor + sign * q), np.maximum(anchor, anchor + sign * q) + width
                inside = (low >= nodes.begin[node]) & (high <= nodes.end[node])
                found.append(np.stack([node[inside], q[inside]]))
        names = np.full(n, -1)
        names[place] = name
        place = np.flatnonzero(names >= 0)
        place = place[place + 2 * width <= end[place]]
        place = place[names[place + width] >= 0]
        key = _pairs(names[place], names[place + width], len(size))
        width *= 2
    node, q = np.unique(np.concatenate(found, axis=1), axis=1)
    return node, q


def _reach(w: np.ndarray, at: int, q: int, low: int, high: int) -> tuple[int, int]:
    """Begin and end of the stretch of i in [low, high) about ``at`` with w[i] = w[i + q]; blocks of doubling size."""
    right, size = at + 1, 32
    while right < high:
        stop = min(right + size, high)
        differ = w[right:stop] != w[right + q : stop + q]
        k = int(differ.argmax())
        if differ[k]:
            right += k
            break
        right, size = stop, size * 2
    left, size = at, 32
    while left > low:
        stop = max(left - size, low)
        differ = (w[stop:left] != w[stop + q : left + q])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            left -= k
            break
        left, size = stop, size * 2
    return left, right


def _primitive(w: np.ndarray) -> bool:
    return not any(len(w) % d == 0 and (w[:-d] == w[d:]).all() for d in range(1, len(w) // 2 + 1))


def runs_of(symbols: np.ndarray, doc: np.ndarray, edge: np.ndarray, p: Runs) -> np.ndarray:
    """Rows of begin, end, period of all runs, by begin and period, counted over the whole chunk."""
    if not len(symbols):
        return np.zeros((0, 3), np.int64)
    nodes, rest = re_pair(symbols, doc)
    rules, sample = np.unique(nodes.rule, return_index=True)
    seam = rest[1:][doc[rest[1:]] == doc[rest[1:] - 1]]
    once = Nodes(*[np.concatenate([x[sample], y]) for x, y in (
        (nodes.begin, edge[doc[seam]]), (nodes.middle, seam), (nodes.end, edge[doc[seam] + 1]), (nodes.rule, np.full(len(seam), -1)))])
    by_rule = np.argsort(nodes.rule, kind="stable")
    use_from, use_to = (np.searchsorted(nodes.rule[by_rule], rules, side=s) for s in ("left", "right"))
    pieces = []
    for k, q in zip(*(x.tolist() for x in possible_periods(symbols, edge[doc + 1], once))):
        low, middle, high = int(once.begin[k]), int(once.middle[k]), int(once.end[k]) - q
        last = -1
        for at in (middle - 1 - q, middle - 1):
            if low <= at < high and at >= last and symbols[at] == symbols[at + q]:
                begin, last = _reach(symbols, at, q, low, high)
                if begin < middle < last + q and last + q - begin >= max(p.min_length, p.min_periods * q):
                    uses = nodes.begin[by_rule[use_from[k] : use_to[k]]] if k < len(rules) else np.array([low])
                    pieces.append(np.stack([uses + begin - low, uses + last + q - low, np.full(len(uses), q)], axis=1))
    if not pieces:
        return np.zeros((0, 3), np.int64)
    x = np.concatenate(pieces)
    x = x[np.lexsort((x[:, 0], x[:, 2]))]
    shift = x[:, 2] * (2 * len(symbols))
    reach = np.maximum.accumulate(x[:, 1] + shift)
    new = np.ones(len(x), bool)
    new[1:] = reach[:-1] - shift[1:] - x[1:, 0] < x[1:, 2]
    first = np.flatnonzero(new)
    out = np.stack([x[first, 0], reach[np.append(first[1:], len(x)) - 1] - shift[first], x[first, 2]], axis=1)
    out = out[[_primitive(symbols[b : b + q]) for b, _, q in out.tolist()]]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


FOUND = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, p: Runs = Runs()) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document; runs by start, then period."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in chunks(batch.column("doc_id").to_pylist(), column_bytes(batch, "text"), p.chunk_bytes):
                words, symbols, doc, edge = word_numbers(texts)
                runs = runs_of(symbols, doc, edge, p)
                of = doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
                change = np.zeros(len(symbols) + 1, np.int64)
                np.add.at(change, runs[:, 0] + runs[:, 2], 1)
                np.add.at(change, runs[:, 1], -1)
                stays = np.cumsum(change[:-1]) == 0
                found: list[list[dict]] = [[] for _ in texts]
                for (begin, end, q), d in zip(runs.tolist(), of.tolist()):
                    found[d].append({"start": begin - int(edge[d]), "length": end - begin, "period": q})
                text = [b" ".join(compress(w, stays[edge[d] : edge[d + 1]].tolist()) if found[d] else w) for d, w in enumerate(words)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(np.diff(edge)), pa.array(found, kind), pa.array(text, pa.binary()).cast(pa.string()),
                ], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(task, FOUND)
