"""Exact substring removal: words covered by a window that occurs elsewhere, found by recompression.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``, unchanged. A window is ``window`` consecutive words of
one document. Every word is removed that is covered by a window whose word sequence starts anywhere else too, same
document included. Windows are judged on the input.

Rows
    Null and empty text: no words, ``kept_sha256`` of the empty string. Texts below ``window`` words keep everything.
    Repeated rows are documents of their own (also with one ``doc_id``, or with null). Empty table: no rows. Other
    columns are ignored.

Method
    Recompression of each text in rounds: maximal runs of one symbol get a name, then pairs of a left and a right
    symbol get a name. A name is a hash of what it stands for and its class (left or right) is a bit of that hash, so
    all tasks name alike and equal substrings have equal symbols but for a few at their ends. Which symbols of a
    window can not depend on what stands outside follows from the symbols alone: a first or last run may go on
    outside, a leading right or trailing left symbol may be paired with what is outside; all others are certain. The
    longest certain symbol of the highest round is the window's anchor.
    Equal windows have equal anchors. Round 1 over the corpus finds anchors that occur more than once, round 2
    verifies the windows at those anchors by a 63-bit hash of anchor and words (a false hit among 10^9 candidate
    windows is expected about once in 18 such corpora), round 3 cuts the texts. Texts are dealt once, all rounds use them.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casemill.llm.blocks import (
    KEYS, buckets, by_block, each_block, flat, key_table, marked, merged, repeated, with_answers,
)
from casemill.llm.textbatch import U, Words, chunks, column_bytes, contains, covered, mix, starts_inside, window_hashes, words_of


@dataclass(frozen=True)
class Substrings:
    window: int = 35
    rounds: int = 4


def _largest(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Where the first of the largest of ``values[lo:hi]`` stands, for many ranges, none empty."""
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    tables, width = [np.arange(len(values), dtype=np.int32)], 1
    for _ in range(int(level.max(initial=0))):
        last = tables[-1]
        up = last.copy()
        near, far = last[: len(last) - width], last[width:]
        up[: len(last) - width] = np.where(values[far] > values[near], far, near)
        tables.append(up)
        width *= 2
    stacked = np.stack(tables)
    near, far = stacked[level, lo], stacked[level, hi - (1 << level)]
    return np.where(values[far] > values[near], far, near)


def anchors(names: np.ndarray, starts: np.ndarray, p: Substrings) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of the window at each of ``starts`` (equal words, equal anchor), and which occurrence of it.

    ``names`` may run over several documents, windows do not.
    """
    symbol, length = names, np.ones(len(names), np.int32)
    alive, lo, hi = np.arange(len(starts)), starts.astype(np.int32), (starts + p.window).astype(np.int32)
    # a window without any certain symbol (one word all along) is its own anchor
    out = mix(window_hashes(names, p.window)[starts] ^ U(0xA0761D6478BD642F))
    place = starts.astype(np.int64)
    for level in range(p.rounds):
        if not len(alive):
            break
        run = np.ones(len(symbol), bool)
        run[1:] = symbol[1:] != symbol[:-1]
        begin = np.flatnonzero(run)
        run = (np.cumsum(run) - 1).astype(np.int32)
        times = np.diff(np.append(begin, len(symbol)))
        length = length[begin] * times.astype(np.int32)
        symbol = np.where(times == 1, symbol[begin], mix(symbol[begin] ^ (times.astype(U) * U(0xE7037ED1A0B428DB))))
        lo, hi = run[lo] + 1, run[hi - 1]
        on = lo < hi
        alive, lo, hi = alive[on], lo[on], hi[on]
        right = ((symbol >> U(17 + level)) & U(1)).astype(bool)
        joined = np.zeros(len(symbol), bool)
        joined[1:] = right[1:] & ~right[:-1]
        begin = np.flatnonzero(~joined)
        group = (np.cumsum(~joined) - 1).astype(np.int32)
        lo, hi = group[lo] + right[lo], group[hi - 1] + right[hi - 1]
        pair = np.diff(np.append(begin, len(symbol))) == 2
        after = np.minimum(begin + 1, len(symbol) - 1)
        length = length[begin] + np.where(pair, length[after], 0)
        symbol = np.where(pair, mix(symbol[begin] * U(0x8EBC6AF09C88C6E3) + symbol[after]), symbol[begin])
        on = lo < hi
        alive, lo, hi = alive[on], lo[on], hi[on]
        if len(alive):
            order = (np.minimum(length, 255).astype(U) << U(56)) | (symbol >> U(8))
            at = _largest(order, lo, hi)
            out[alive] = mix(order[at] + U(level + 1))
            place[alive] = at + (level + 1) * len(names)
    return out, place


def _windows(texts: list[bytes], p: Substrings):
    """Words, window starts, their anchors, and which windows share an occurrence of an anchor with the one before."""
    w = words_of(texts)
    starts = starts_inside(w.first, p.window)
    if not len(starts):
        return w, starts, np.zeros(0, U), np.zeros(0, bool)
    anchor, place = anchors(w.names, starts, p)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1])
    return w, starts, anchor & ~U(1), new


def remove_repeats(docs: DataFrame, p: Substrings = Substrings(), text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256``, and the kept words as ``text`` if asked for."""
    n = buckets(docs)
    rows = by_block(docs.select("doc_id", "text"))

    def name_anchors(block: int, here: pa.Table) -> pa.Table:
        found = []
        for _, texts in chunks(here.column("doc_id").to_pylist(), column_bytes(here, "text")):
            _, _, anchor, new = _windows(texts, p)
            found.append(marked(anchor[new]))
        return key_table(block, merged(found), n)

    def name_windows(block: int, here: pa.Table, there: pa.Table) -> pa.Table:
        known, found = np.sort(flat(there.column("names"))[0]), []
        for _, texts in chunks(here.column("doc_id").to_pylist(), column_bytes(here, "text")):
            found.append(marked(_candidates(*_windows(texts, p), known, p)[1]))
        return key_table(block, merged(found), n)

    def cut(block: int, here: pa.Table, anchors_: pa.Table, windows: pa.Table) -> pa.Table:
        known, hits = np.sort(flat(anchors_.column("names"))[0]), np.sort(flat(windows.column("names"))[0])
        out: dict[str, list] = {c: [] for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "text")}
        for ids, texts in chunks(here.column("doc_id").to_pylist(), column_bytes(here, "text")):
            w, starts, anchor, new = _windows(texts, p)
            at, key = _candidates(w, starts, anchor, new, known, p)
            gone = covered(at[contains(hits, key & ~U(1))], p.window, len(w.names))
            for i, t, a, b in zip(ids, texts, w.first[:-1], w.first[1:]):
                kept = b" ".join(compress(t.split(), ~gone[a:b]) if gone[a:b].any() else t.split())
                out["doc_id"].append(i)
                out["n_words"].append(int(b - a))
                out["n_removed"].append(int(gone[a:b].sum()))
                out["kept_sha256"].append(sha256(kept).hexdigest())
                if text:
                    out["text"].append(kept)
        arrays = [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_words"], pa.int64()),
                  pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        return pa.table(arrays + ([pa.array(out["text"], pa.binary()).cast(pa.string())] if text else []), names=names + ["text"] * text)

    anchor_hits = repeated(each_block(rows, name_anchors, KEYS))
    window_hits = repeated(with_answers(rows, anchor_hits, name_windows, KEYS))
    both = anchor_hits.withColumn("kind", F.lit(0)).union(window_hits.withColumn("kind", F.lit(1)))

    def final(block: int, here: pa.Table, there: pa.Table) -> pa.Table:
        kind = there.column("kind").to_numpy()
        return cut(block, here, there.filter(pa.array(kind == 0)), there.filter(pa.array(kind == 1)))

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", text string" * text
    return with_answers(rows, both, final, schema)


def _candidates(w: Words, starts, anchor, new, known, p: Substrings) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows with a repeated anchor, and a hash of anchor and words for each."""
    if not len(starts):
        return starts, np.zeros(0, U)
    on = contains(known, anchor[new])[np.cumsum(new) - 1]
    at = starts[on]
    return at, mix(window_hashes(w.names, p.window)[at] + anchor[on])
