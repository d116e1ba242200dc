"""Secret scan: candidate strings, and a random forest that removes false positives.

A candidate is a run of at least ``shortest`` characters of ``A-Za-z0-9+/_=.-`` that holds a digit or is assigned to
a credential name, or the whole value assigned to such a name: what stands between quotation marks on a line, or an
unbroken run without its last punctuation, of at least ``shortest_assigned`` characters. Candidates may overlap. Of names inside
one unbroken value only the last one counts besides the first. Its features: length, classes of characters, entropy, how usual its character transitions are in the
corpus, how much of it dictionary words of the corpus cover, hashed path, hashed neighbouring words, and the signs next
to it. The forest is fitted on labelled findings, at most ``fit_rows`` of them (smallest hash first).

Transitions are counted over all documents; the dictionary holds the ``dictionary`` most frequent words of all documents.
Labelled findings are a table ``doc_id, first, end, is_secret``; those that are no candidates become some if they lie
in the text. Without one, findings that their surroundings decide are
used: strings of high entropy assigned to a credential name are secrets; parts of mail addresses, digit strings and
strings made of dictionary words are not. Others stay open and are left to the forest.

Offsets are code points, ends exclusive. Result rows: one for each candidate.

Rows
    Null and empty texts have no candidates. Null paths count as an empty path. Repeated rows give their findings again. Null
    ids: findings with a null id, never matched with a given label. Labels of one class only or none: the probability is 1 for
    findings labelled as secrets and else 0. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from casemill.llm.textbatch import column_bytes
from casemill.session import stage


@dataclass(frozen=True)
class Secrets:
    shortest: int = 16
    shortest_assigned: int = 6
    dictionary: int = 20_000
    fit_rows: int = 20_000
    trees: int = 24
    depth: int = 6
    entropy: float = 3.0
    threshold: float = 0.5
    path_slots: int = 8
    word_slots: int = 16


_CANDIDATE = r"[A-Za-z0-9+/_=.\-]{%d,}"
# Names that credentials are assigned to.
_NAMES = r"(?:token|secret|passw(?:or)?d|pwd|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer)"
_ASSIGNED = re.compile(_NAMES + r"[A-Za-z_]*\s*(?:=>|[=:])\s*[\"'`]?$", re.IGNORECASE)
_NAME = re.compile(_NAMES, re.IGNORECASE)
# A whole run is tried once, and nothing in it is given back: the work is linear in the text.
_LEFT_SIDE = re.compile(r"(?<![A-Za-z_-])[A-Za-z_-]++", re.IGNORECASE)
_SIGN = re.compile(r"[\"'`]?\s*+(?:=>|:=|[=:])\s*+(?:(?:bearer|basic)\s++)?", re.IGNORECASE)
_QUOTED = {q: re.compile(rf"(?:\\.|[^{q}\\\n])*+{q}") for q in "\"'`"}
_UNBROKEN = re.compile(r"[^\s\"'`]+")
_MAIL = re.compile(r"[^@\s]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_RUN = re.compile(r"[a-z]+")

_CLASS = np.full(256, 31, np.int64)  # letters, upper case, digits, signs, white space, bytes above 127
_CLASS[97:123] = np.arange(26)
_CLASS[65:91], _CLASS[48:58], _CLASS[128:], _CLASS[[9, 10, 11, 12, 13, 32]] = 26, 27, 28, 29
CLASSES = 32


def transitions(docs: DataFrame) -> np.ndarray:
    """Log-probability of each class of character after another, over all documents."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for text in column_bytes(batch, "text"):
                c = _CLASS[np.frombuffer(text, np.uint8)]
                if len(c) > 1:
                    total += np.bincount(c[:-1] * CLASSES + c[1:], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["pair", "n"])

    rows = docs.select("text").mapInArrow(task, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.ones((CLASSES, CLASSES))
    for r in rows:
        counts[r["pair"] // CLASSES, r["pair"] % CLASSES] += r["n"]
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def dictionary(docs: DataFrame, p: Secrets) -> set[str]:
    """The most frequent words of 4 to 16 small letters."""
    words = docs.where("text is not null").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w"))
    words = words.where(F.length("w").between(4, 16)).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return {r["w"] for r in words.orderBy(F.desc("n"), "w").limit(p.dictionary).collect()}


def covered_by_words(text: str, words: set[str]) -> float:
    """Share of the characters that lie in dictionary words, longest first from the left."""
    hit = 0
    for run in _RUN.findall(text.lower()):
        i = 0
        while i < len(run) - 3:
            size = next((k for k in range(min(16, len(run) - i), 3, -1) if run[i : i + k] in words), 0)
            hit, i = hit + size, i + max(size, 1)
    return hit / max(len(text), 1)


def _slot(text: str, n: int) -> int:
    return xxhash.xxh3_64_intdigest(text) % n


def _features(value: str, before: str, after: str, path: str, logp: np.ndarray, words: set[str], p: Secrets) -> list[float]:
    n = len(value)
    counts = Counter(value)
    entropy = -sum(c / n * np.log2(c / n) for c in counts.values())
    c = _CLASS[np.frombuffer(value.encode(), np.uint8)]
    moves = float(logp[c[:-1], c[1:]].mean()) if n > 1 else 0.0
    kinds = [sum(map(str.isdigit, value)), sum(map(str.isupper, value)), sum(map(str.islower, value)),
             sum(x in "abcdefABCDEF0123456789" for x in value), sum(x in "+/_=.-" for x in value)]
    switches = float((np.minimum(c[1:], 26) // 26 != np.minimum(c[:-1], 26) // 26).mean()) if n > 1 else 0.0
    near = before.split()[-3:]
    slots = [0.0] * (p.path_slots + 2 * p.word_slots)
    slots[_slot(path, p.path_slots)] = 1.0
    for w in near:
        slots[p.path_slots + _slot(w.lower().strip("\"'`=:"), p.word_slots)] = 1.0
    for w in after.split()[:2]:
        slots[p.path_slots + p.word_slots + _slot(w.lower(), p.word_slots)] = 1.0
    signs = [before.rstrip()[-1:] in ("\"", "'", "`"), after[:1] in ("\"", "'", "`"), "=" in before[-4:] or ":" in before[-4:],
             before[-1:] == "@" or after[:1] == "@", bool(re.search(_NAMES, before, re.IGNORECASE)),
             bool(re.search("test|example|sample|doc", path, re.IGNORECASE))]
    return [float(np.log(n)), *[k / n for k in kinds], entropy, moves, switches, covered_by_words(value, words), *map(float, signs), *slots]


def _names_credential(run: str) -> bool:
    """Whether a credential name stands in ``run`` with no hyphen after it."""
    dash = run.rfind("-")
    return any(m.end() > dash for m in _NAME.finditer(run, max(0, dash - len("private"))))


def assignments(text: str) -> Iterator[int]:
    """Where the values assigned to credential names begin."""
    done = 0
    for run in _LEFT_SIDE.finditer(text):
        if run.start() >= done and (sign := _SIGN.match(text, run.end())) and _names_credential(run[0]):
            done = sign.end()
            yield done


def assigned_values(text: str, p: Secrets) -> list[tuple[int, int]]:
    """Begin and end of the values assigned to credential names."""
    out, last = set(), None
    reach = -1  # end of the unbroken value before
    for a in assignments(text):
        if text[a : a + 1] in _QUOTED and (q := _QUOTED[text[a]].match(text, a + 1)):
            out.add((a + 1, q.end() - 1))
        elif a < reach:
            last = (a, reach)
        elif u := _UNBROKEN.match(text, a + (text[a : a + 1] in _QUOTED)):
            out |= {last} if last else set()
            last, reach = None, u.start() + len(u[0].rstrip(".,;)]}"))
            out.add((u.start(), reach))
    out |= {last} if last else set()
    return sorted(x for x in out if x[1] - x[0] >= p.shortest_assigned)


FOUND = "doc_id bigint, first bigint, end bigint, hint int, x array<double>"


def candidates(docs: DataFrame, path: str, logp: np.ndarray, words: set[str], p: Secrets, given: bool = False) -> DataFrame:
    """Candidates with features, or with ``given`` the spans of that column; ``hint`` is 1 or 0 where the surroundings decide, else null."""
    pattern = re.compile(_CANDIDATE % p.shortest)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            given = batch.column("given").to_pylist() if "given" in batch.schema.names else [None] * batch.num_rows
            for doc_id, text, where, marked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "path")), given):
                text = text or ""
                if marked is None:
                    values = set(assigned_values(text, p))
                    spans = sorted(values | {m.span() for m in pattern.finditer(text)})
                else:
                    values = spans = [(s["first"], s["end"]) for s in marked if 0 <= s["first"] < s["end"] <= len(text)]
                for a, b in spans:
                    value, before, after = text[a:b], text[max(0, a - 48) : a], text[b : b + 32]
                    assigned = (a, b) in values or bool(_ASSIGNED.search(before))
                    if not assigned and not any(map(str.isdigit, value)):
                        continue
                    x = _features(value, before, after, where, logp, words, p)
                    entropy, coverage = x[6], x[9]
                    hint = None
                    if before[-1:] == "@" or after[:1] == "@" or coverage >= 0.5 or not any(map(str.isalpha, value)):
                        hint = 0
                    elif (assigned and entropy >= min(p.entropy, 0.85 * np.log2(len(value))) and any(map(str.isdigit, value))
                          and not _MAIL.fullmatch(value)):
                        hint = 1
                    rows.append((doc_id, a, b, hint, x))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                             names=["doc_id", "first", "end", "hint", "x"])

    marked = ["given"] if given else []
    rows = docs.select("doc_id", "text", F.coalesce(F.col(path), F.lit("")).alias("path"), *marked)
    return stage(rows.mapInArrow(task, FOUND), "secret-candidates")


def secret_scan(docs: DataFrame, findings: DataFrame | None = None, path: str = "source", p: Secrets = Secrets()) -> DataFrame:
    """``doc_id, first, end, n_chars, labelled, probability, is_secret`` for each candidate."""
    logp, words = transitions(docs), dictionary(docs, p)
    found = candidates(docs, path, logp, words, p)
    if findings is None:
        found = found.withColumn("labelled", F.col("hint"))
    else:
        given = findings.groupBy("doc_id", "first", "end").agg(F.max(F.col("is_secret").cast("int")).alias("labelled"))
        keys = ["doc_id", "first", "end"]
        more = given.join(found.select(*keys).distinct(), keys, "left_anti").groupBy("doc_id").agg(
            F.collect_list(F.struct(F.col("first").cast("bigint").alias("first"), F.col("end").cast("bigint").alias("end"))).alias("given"))
        texts = docs.select("doc_id", "text", F.col(path).alias("path")).join(more, "doc_id")
        found = found.union(candidates(texts, "path", logp, words, p, True)).join(given, keys, "left")
    found = found.select("doc_id", "first", "end", "labelled", "x")
    known = (found.where("labelled is not null").orderBy(F.xxhash64("doc_id", "first", F.lit(5)), "doc_id", "first").limit(p.fit_rows)
             .select(F.col("labelled").cast("double").alias("label"), array_to_vector("x").alias("features")))
    known = stage(known, "secret-labelled")
    classes = known.groupBy("label").count().count()
    keep = ["doc_id", "first", "end", (F.col("end") - F.col("first")).alias("n_chars"), "labelled"]
    if classes < 2:
        out = found.select(*keep, F.when(F.col("labelled") == 1, 1.0).otherwise(0.0).alias("probability"))
    else:
        forest = RandomForestClassifier(numTrees=p.trees, maxDepth=p.depth, seed=11, featureSubsetStrategy="onethird").fit(known)
        scored = forest.transform(found.withColumn("features", array_to_vector("x")))
        out = scored.select(*keep, vector_to_array("probability")[1].alias("probability"))
    return out.withColumn("is_secret", F.col("probability") >= p.threshold)
