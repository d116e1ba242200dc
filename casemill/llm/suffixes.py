"""Exact byte-substring removal: suffix order, Burrows-Wheeler transform, threshold-bounded interval expansion.

A text is its UTF-8 bytes. Every byte is removed that is covered by a ``length``-byte string which also starts in a
document with a smaller ``doc_id``; strings are judged on the input and do not cross documents.

Rows
    Null and empty text: nothing to remove. Texts shorter than ``length`` stay whole. Rows with one ``doc_id`` do not
    remove from each other (neither id is smaller). Null ids come after all others and do not remove from each other.
    Empty table: no rows. Other columns are ignored.

Method
    1. Each ``length``-byte string has an anchor, the ``gram``-byte string in it with the smallest hash (the first of
       equals), so equal strings have equal anchors. Anchors that occur once in the corpus are set aside.
    2. Strings at the other anchors are gathered by anchor: neighbours with one anchor form a segment, equal segments
       of a block of documents go as one with their smallest ``doc_id``. However often a passage occurs, a group holds
       it once for each block at most.
    3. In a group: suffix order of all distinct segments, Burrows-Wheeler transform, and breadth-first backward
       extension of suffix intervals. Extension by one byte finds the boundaries with the next larger common prefix;
       it stops at ``length``. What has no boundary then has at least ``length`` bytes in common.
    4. Each string learns whether the smallest id of its interval is below that of its segment; documents are cut.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casemill.llm.blocks import (
    KEYS, buckets, by_block, by_bucket, each_block, flat, key_table, lists, marked, merged, repeated,
    with_answers,
)
from casemill.llm.textbatch import BYTE_NAMES, U, chunks, column_bytes, contains, covered, mix, powers

LAST = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass(frozen=True)
class Suffixes:
    length: int = 50
    gram: int = 16


def _sorted_with_place(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``key``, and the sorted keys. Keys of ``bits`` bits that leave room for the position are sorted as one
    number, which is several times faster than sorting positions."""
    place = max(len(key) - 1, 1).bit_length()
    if bits + place <= 64:
        both = np.sort((key.astype(U) << U(place)) | np.arange(len(key), dtype=U))
        return (both & U((1 << place) - 1)).astype(np.int64), both >> U(place)
    order = np.argsort(key, kind="stable")
    return order, key[order]


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by at least the ``depth`` symbols that follow; symbols are 0 to 256. Prefix doubling."""
    n = len(t)
    present = np.bincount(t, minlength=257) > 0
    code = (np.cumsum(present) - present[0]).astype(np.int64)  # 0 stays 0
    bits = int(code[-1]).bit_length() or 1
    width = max(1, (63 - max(n - 1, 1).bit_length()) // bits)
    code = code[t]
    key = np.zeros(n, np.int64)
    for j in range(width):
        key[: n - j] += code[j:] << (bits * (width - 1 - j))
    used = bits * width
    while True:
        order, s = _sorted_with_place(key, used)
        if width >= depth:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (s[1:] != s[:-1])]))
        half = int(rank[order[-1]]).bit_length()
        key = rank << half
        key[: max(n - width, 0)] |= rank[width:]
        used, width = 2 * half, 2 * width


def boundaries(t: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """True at each rank whose suffix has fewer than ``depth`` symbols in common with the one before. ``t`` ends with a
    separator (0); strings with separators are not extended.

    Intervals of equal prefixes are extended to the left, one symbol in each round. An interval whose right end is new
    gives that end the common prefix of the round and is extended further; an end is set once, so the work is bounded.
    """
    n = len(t)
    bwt = t[order - 1]
    by_symbol, _ = _sorted_with_place(bwt.astype(np.int64), 9)
    last_to_first = np.empty(n, np.int64)
    last_to_first[by_symbol] = np.arange(n)
    first = t[order]
    begins = np.ones(n, bool)  # the first suffix with its first symbol
    begins[1:] = first[1:] != first[:-1]
    edge = np.zeros(n + 1, bool)
    edge[0] = edge[n] = True
    lb, rb = np.array([0]), np.array([n])
    for _ in range(depth):
        if not len(lb):
            break
        width = rb - lb
        if int(width.max()) == 1:
            to = last_to_first[lb[bwt[lb] != 0]]
            lb, rb = to, to + 1
        else:
            at = _ranges(lb, width)
            of = np.repeat(np.arange(len(lb)), width)
            keep = bwt[at] != 0
            to, of = last_to_first[at[keep]], of[keep]
            if not len(to):
                break
            if len(to) > n // 6:  # most ranks are hit: lay them out
                owner = np.full(n, -1, np.int64)
                owner[to] = of
                to = np.flatnonzero(owner >= 0)
                of = owner[to]
            else:
                both = np.sort((to << 32) | of)
                to, of = both >> 32, both & 0xFFFFFFFF
            new = np.ones(len(to), bool)
            new[1:] = (to[1:] != to[:-1] + 1) | (of[1:] != of[:-1]) | begins[to[1:]]
            begin = np.flatnonzero(new)
            lb, rb = to[begin], to[np.append(begin[1:], len(to)) - 1] + 1
        fresh = ~edge[rb]
        lb, rb = lb[fresh], rb[fresh]
        edge[rb] = True
    # strings of separators only: every suffix that begins with one stands apart
    zero = first == 0
    edge[:n] |= zero
    edge[1:] |= zero
    return edge[:n]


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - count), count)


@dataclass
class _Anchored:
    """Runs of neighbouring strings with one occurrence of an anchor: the anchor's key, the document, first byte,
    number of strings."""

    buffer: np.ndarray
    key: np.ndarray
    doc: np.ndarray
    begin: np.ndarray
    count: np.ndarray


def _anchored(texts: list[bytes], p: Suffixes) -> _Anchored:
    buffer = np.frombuffer(b"\n".join(texts) + b"\n" * p.length, np.uint8)
    size = np.array([len(t) for t in texts])
    begin = np.cumsum(np.append(0, size[:-1] + 1)) if len(size) else size
    count = np.maximum(size - p.length + 1, 0)
    starts = _ranges(begin, count)
    empty = np.zeros(0, np.int64)
    if not len(starts):
        return _Anchored(buffer, np.zeros(0, U), empty, empty, empty)
    word, step = buffer.astype(U), 1
    while step < 8:
        word = word[:-step] | (word[step:] << U(8 * step))
        step *= 2
    n = len(buffer) - p.gram + 1
    name = mix(word[:n] * U(0xD6E8FEB86659FD93) + word[p.gram - 8 : n + p.gram - 8] * U(0xA0761D6478BD642F))
    low = U((1 << len(buffer).bit_length()) - 1)
    best, have, wanted = (name & ~low) | np.arange(n, dtype=U), 1, p.length - p.gram + 1
    while have * 2 <= wanted:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < wanted:
        best = np.minimum(best[: len(best) - (wanted - have)], best[wanted - have :])
    place = (best[starts] & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    first = starts[at]
    return _Anchored(buffer, mix(name[place[at]]) & ~U(1), np.searchsorted(begin, first, side="right") - 1, first,
                     np.diff(np.append(at, len(starts))))


def _of_block(here: pa.Table, p: Suffixes):
    for ids, texts in chunks(here.column("doc_id").to_pylist(), column_bytes(here, "text")):
        yield ids, texts, _anchored(texts, p)


@dataclass
class _Segments:
    """Distinct segments of a block in the order of their keys, and for each chunk its runs with their segments."""

    key: np.ndarray
    size: np.ndarray
    least: np.ndarray
    text: bytes
    runs: list


def _segments(here: pa.Table, known: np.ndarray, p: Suffixes, text: bool) -> _Segments:
    keys, names, docs, sizes, texts, runs, total = [], [], [], [], [], [], 0
    for ids, whole, a in _of_block(here, p):
        on = contains(known, a.key)
        sums = np.zeros(len(a.buffer) + 1, U)
        np.cumsum(BYTE_NAMES[a.buffer] * powers(_BASE, len(a.buffer)), out=sums[1:])
        begin, size = a.begin[on], a.count[on] + p.length - 1
        keys.append(a.key[on])
        names.append(mix((sums[begin + size] - sums[begin]) * powers(_INVERSE, len(a.buffer))[begin] + size.astype(U)))
        docs.append(np.array([LAST if i is None else i for i in ids], np.int64)[a.doc[on]])
        sizes.append(size)
        data = a.buffer.tobytes() if text else b""
        texts += [data[b : b + s] for b, s in zip(begin.tolist(), size.tolist())] if text else []
        runs.append((ids, whole, a.doc[on], begin, a.count[on], slice(total, total + len(begin))))
        total += len(begin)
    key, name, doc, size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, names, docs, sizes))
    order = np.lexsort((name, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (name[order][1:] != name[order][:-1])
    at = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[order], at) if len(at) else doc
    joined = b"".join([texts[i] for i in order[at].tolist()]) if text else b""
    return _Segments(key[order][at], size[order][at], least, joined, [(*r[:-1], which[r[-1]], doc[r[-1]]) for r in runs])


SEGMENTS = "block int, bucket int, parts binary, sizes array<int>, least array<bigint>, text binary"
BATCH_BYTES = 1 << 20
REPLIES = "block int, bucket int, names array<bigint>, below binary"
OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _smallest(texts: list[bytes], low: np.ndarray, p: Suffixes) -> np.ndarray:
    """For the strings of distinct segments, one segment after another: the smallest document of equal strings."""
    size = np.array([len(x) for x in texts], np.int64)
    t = np.zeros(int(size.sum()) + len(size), np.int16)
    begin = np.cumsum(np.append(0, size[:-1] + 1))
    t[_ranges(begin, size)] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 1
    order = suffix_order(t, p.length)
    edge = boundaries(t, order, p.length)
    strings = size - p.length + 1
    at = _ranges(begin, strings)
    doc = np.full(len(t), LAST)
    doc[at] = np.repeat(low, strings)
    begins = np.flatnonzero(edge)
    least = np.minimum.reduceat(doc[order], begins)
    found = np.empty(len(t), np.int64)
    found[order] = np.repeat(least, np.diff(np.append(begins, len(t))))
    return found[at]


def _settle(group: pa.Table, p: Suffixes) -> pa.Table:
    """Which strings of the segments of one group have a smaller document elsewhere.

    A group is worked off in batches of neighbouring key ranges (``parts``), each of about ``BATCH_BYTES``."""
    sizes, per_row = flat(group.column("sizes").cast(pa.list_(pa.int64())))
    sizes = sizes.view(np.int64)
    least = flat(group.column("least"))[0].view(np.int64)
    part = np.frombuffer(b"".join(group.column("parts").to_pylist()), np.uint8)
    data = b"".join(group.column("text").to_pylist())
    ends = np.cumsum(sizes)
    volume = np.bincount(part, weights=sizes, minlength=256)
    batch_of = (np.cumsum(volume) - volume) // BATCH_BYTES
    batch = batch_of[part]
    count = sizes - p.length + 1
    first = np.append(0, np.cumsum(count))
    below = np.zeros(int(first[-1]), bool)
    order = np.argsort(batch, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], batch[order][1:] != batch[order][:-1]])) if len(order) else np.zeros(0, int)
    for rows in np.split(order, cuts[1:]) if len(order) else []:
        index: dict[bytes, int] = {}
        which = np.array([index.setdefault(data[e - s : e], len(index)) for e, s in zip(ends[rows].tolist(), sizes[rows].tolist())], np.int64)
        low = np.full(len(index), LAST)
        np.minimum.at(low, which, least[rows])
        texts = list(index)
        strings = np.array([len(x) for x in texts]) - p.length + 1
        found = _smallest(texts, low, p)
        at = _ranges((np.cumsum(strings) - strings)[which], count[rows])
        below[_ranges(first[rows], count[rows])] = found[at] < np.repeat(least[rows], count[rows])
    cut = first[np.append(0, np.cumsum(per_row))]
    bits = [np.packbits(below[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:])]
    return pa.table([
        group.column("block").combine_chunks(), group.column("bucket").combine_chunks(),
        pa.nulls(len(bits), pa.list_(pa.int64())), pa.array(bits, pa.binary()),
    ], names=["block", "bucket", "names", "below"])


def remove_earlier(docs: DataFrame, p: Suffixes = Suffixes(), spans: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, and the removed byte ranges as ``spans`` if asked for."""
    n = buckets(docs)
    rows = by_block(docs.select("doc_id", "text"))

    def name_anchors(block: int, here: pa.Table) -> pa.Table:
        return key_table(block, merged([marked(a.key) for _, _, a in _of_block(here, p)]), n)

    def send(block: int, here: pa.Table, there: pa.Table) -> pa.Table:
        s = _segments(here, np.sort(flat(there.column("names"))[0]), p, text=True)
        numbers, begin = by_bucket(s.key, n)
        parts = (((s.key >> U(32)) * U(n)) >> U(24)).astype(np.uint8)  # the range of the key within its bucket
        cut = np.append(0, np.cumsum(s.size))[begin]
        return pa.table([
            pa.array(np.full(len(numbers), block, np.int32)), pa.array(numbers.astype(np.int32)),
            pa.array([parts[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])], pa.binary()),
            pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(s.size.astype(np.int32))),
            lists(s.least.view(U), begin), pa.array([s.text[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
        ], names=["block", "bucket", "parts", "sizes", "least", "text"])

    def cut(block: int, here: pa.Table, there: pa.Table) -> pa.Table:
        bits = there.column("below")
        reply = there.filter(bits.is_valid()).sort_by("bucket")
        known = np.sort(flat(there.filter(bits.is_null()).column("names"))[0])
        s = _segments(here, known, p, text=False)
        count = s.size - p.length + 1
        first = np.append(0, np.cumsum(count))
        _, begin = by_bucket(s.key, n)
        parts = [np.unpackbits(np.frombuffer(x, np.uint8), count=int(first[b] - first[a]))
                 for x, a, b in zip(reply.column("below").to_pylist(), begin[:-1], begin[1:])]
        below = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
        out: list[tuple] = []
        for ids, texts, _, at, many, which, doc in s.runs:
            size = np.array([len(t) for t in texts])
            edge = np.cumsum(np.append(0, size + 1))
            starts = _ranges(at, many)
            gone = below[_ranges(first[which], many)] | np.repeat(doc > s.least[which], many)
            removed = covered(starts[gone], p.length, int(edge[-1]))
            for i, t, b in zip(ids, texts, edge):
                mine = removed[b : b + len(t)]
                change = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                kept = t if not len(change) else np.frombuffer(t, np.uint8)[~mine].tobytes()
                out.append((i, len(t), len(t) - len(kept), len(change) // 2, sha256(kept).hexdigest(),
                            [{"first": int(x), "end": int(y)} for x, y in change.reshape(-1, 2)] if spans else None))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        width = 6 if spans else 5
        return pa.table([pa.array([r[c] for r in out], kinds[c]) for c in range(width)], names=names[:width])

    anchors = repeated(each_block(rows, name_anchors, KEYS))
    segments = with_answers(rows, anchors, send, SEGMENTS)
    replies = segments.groupBy("bucket").applyInArrow(lambda g: _settle(g, p), REPLIES)
    both = replies.unionByName(anchors.select("block", F.lit(0).alias("bucket"), "names", F.lit(None).cast("binary").alias("below")))
    return with_answers(rows, both, cut, OUT + ", spans array<struct<first:bigint,end:bigint>>" * spans)
