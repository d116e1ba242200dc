"""Quality rules: text counts per document, and lines that too many documents of a host share.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``. A line is normalised by lower-casing A-Z, turning
digits into 0 and joining its words by one blank; lines without words do not count. A line is boilerplate on a host if
more than ``max(min_documents, share * texts of the host)`` different texts of that host hold it. Copies of one text
count once, so a large group of copies does not turn its own lines into boilerplate. A document is depleted, and not
kept, if less than ``remainder`` of its words are left without the boilerplate lines.

Rows
    Null and empty text: all counts 0, ``base_failed`` true. Null host: a host of its own. Repeated rows and null ids
    are documents of their own. A document exactly at a limit passes. Empty table: no rows. Other columns are ignored.
    A verdict follows from host and text alone; it is joined back by id, host and a digest of the text, so rows that
    share an id, or have none, each get their own and come once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from casemill.llm.textbatch import LOWER, U, chunks, column_bytes, covered, mix, starts_inside, window_hashes, words_of
from casemill.session import stage


@dataclass(frozen=True)
class Quality:
    min_words: int = 20
    repeat_window: int = 8
    repeat_percent: int = 30
    min_documents: int = 10
    share: float = 0.1
    remainder: float = 0.3


_NORMAL = bytes(0x30 if 0x30 <= b <= 0x39 else b for b in LOWER)
# The characters that count as symbols.
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURED = (
    "doc_id bigint, host string, content binary, " + ", ".join(f"{c} bigint" for c in COUNTS)
    + ", lines array<struct<line:bigint,words:bigint>>"
)


def content_of(text: Column) -> Column:
    """The ``content`` of ``measure`` as a column: the first half of the SHA-256."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def line_hash(line: bytes) -> int:
    """Hash of a normalised line as a signed 64-bit number."""
    h = xxhash.xxh3_64_intdigest(b" ".join(line.translate(_NORMAL).split()))
    return h - (1 << 64) if h >> 63 else h


def _lines(text: bytes) -> tuple[int, list[dict]]:
    """Number of lines equal to an earlier line, and the words in each distinct normalised line."""
    seen: set[bytes] = set()
    again, words = 0, {}
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            again += line in seen
            seen.add(line)
            h = line_hash(line)
            words[h] = words.get(h, 0) + n
    return again, [{"line": h, "words": n} for h, n in words.items()]


def measure(docs: DataFrame, host: str, p: Quality) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("host").to_pylist()))
            for keys, texts in chunks(rows, column_bytes(batch, "text")):
                w = words_of(texts)
                begin = np.cumsum([0] + [len(t) + 1 for t in texts])
                inside = np.zeros(len(w.buffer) + 1, np.int32)
                np.add.at(inside, w.start, 1)
                np.add.at(inside, w.end, -1)
                letter = np.cumsum(inside[:-1]).astype(bool) & ((w.buffer & 0xC0) != 0x80)
                starts = starts_inside(w.first, p.repeat_window)
                repeated = np.zeros(len(w.names), bool)
                if len(starts):
                    doc = np.searchsorted(w.first, starts, side="right").astype(U)
                    key = mix(window_hashes(w.names, p.repeat_window)[starts] + doc * U(0x9E3779B97F4A7C15))
                    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
                    repeated = covered(starts[count[which] > 1], p.repeat_window, len(w.names))
                lines = [_lines(t) for t in texts]
                sums = lambda x, at: np.diff(np.concatenate([[0], np.cumsum(x)])[at])
                columns = [np.diff(w.first), sums(letter, begin), sums(_SYMBOL[w.buffer], begin),
                           np.array([a for a, _ in lines]), sums(repeated, w.first)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.string()),
                    pa.array([hashlib.sha256(t).digest()[:16] for t in texts], pa.binary()),
                    *[pa.array(c.astype(np.int64)) for c in columns],
                    pa.array([x for _, x in lines], pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))),
                ], names=["doc_id", "host", "content", *COUNTS, "lines"])

    rows = docs.select("doc_id", "text", F.coalesce(F.col(host), F.lit("")).alias("host"))
    measured = rows.mapInArrow(task, MEASURED)
    return stage(measured.withColumn("row", F.monotonically_increasing_id()), "quality-measured")


def boilerplate(measured: DataFrame, p: Quality) -> DataFrame:
    """``host, line`` of the lines above the limit."""
    texts = measured.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    held = measured.select("host", "content", F.explode("lines.line").alias("line")).distinct()
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > p.min_documents)
    return counts.join(texts, "host").where(F.col("n") > p.share * F.col("texts")).select("host", "line")


def quality(docs: DataFrame, host: str = "source", p: Quality = Quality()) -> DataFrame:
    """Counts and verdict of every document, with the words in its boilerplate lines and those lines."""
    measured = measure(docs, host, p)
    lines = measured.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    gone = lines.join(boilerplate(measured, p), ["host", "line"]).groupBy("row").agg(
        F.sum("words").alias("boilerplate_words"), F.collect_set("line").alias("boilerplate_lines"))
    out = measured.drop("lines").join(gone, "row", "left")
    out = out.withColumn("boilerplate_words", F.coalesce("boilerplate_words", F.lit(0).cast("bigint")))
    failed = (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.col("boilerplate_words")
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (left >= p.remainder * F.col("n_words"))).drop("row"))


def without_boilerplate(docs: DataFrame, verdict: DataFrame, host: str = "source") -> DataFrame:
    """The kept documents, without the lines found to be boilerplate. All columns stay; ``n_chars`` follows the text."""
    @F.pandas_udf("string")
    def cut(text, lines):
        def one(t, gone):
            if t is None or gone is None or not len(gone):
                return t
            hit = set(gone.tolist())
            lines = [x.encode() for x in t.split("\n")]
            return b"\n".join(x for x in lines if not x.split() or line_hash(x) not in hit).decode()
        return text.combine(lines, one)

    # the rows of docs travel as one column, so that none of their names can clash
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(doc.alias("doc"), content_of(F.col("text")).alias("own"))
    keys = ["doc_id", "host", "content"]
    found = verdict.where("kept").select(*keys, "boilerplate_lines").dropDuplicates(keys)
    same = (F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.coalesce(F.col("doc").getField(host), F.lit("")) == F.col("host"))
            & (F.col("own") == F.col("content")))
    out = rows.join(found, same)
    text = F.when(F.size("boilerplate_lines") > 0, cut("doc.text", "boilerplate_lines")).otherwise(F.col("doc.text"))
    changed = {"text": text, "n_chars": F.when(F.size("boilerplate_lines") > 0, F.length(text).cast("bigint")).otherwise(F.col("doc.n_chars"))
               if "n_chars" in docs.columns else None}
    return out.select(*[changed[c].alias(c) if c in changed else F.col("doc").getField(c).alias(c) for c in docs.columns])
