"""Token ids in training order: fixed-stride shards over a keyed permutation of all sequences.

Texts are tokenised with a byte-level BPE vocabulary; each text is followed by the end token. The tokens of a task's
texts are cut into sequences of ``length`` ids, the last one filled up with end tokens. Sequences are numbered over all
tasks, and a keyed Feistel network over the next power of four, walked until it falls below the number of sequences,
gives each its slot: a permutation that needs no table and no sort of random numbers. Slots are range-partitioned into
shards of ``slots`` sequences, written in slot order; slots are uniform, so the ranges are known without a sample. Every sequence takes the same number of bytes, so slot s stands
at byte ``(s - first_slot) * stride`` of shard ``s div slots``: a reader starts anywhere and goes on sequentially
(``sequences``), and an interrupted export continues with the shards it lacks (``missing``).

``write_files`` writes each shard as a file of its own with a manifest; ``missing`` compares shards with either.

Ids are little-endian ``uint16``, or ``uint32`` where the vocabulary or the end token needs more than 16 bits.

Rows
    Null and empty texts give no tokens and no end token. Null ids, repeated rows and repeated ids are texts like any
    other. Special-token strings in a text are ordinary text. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.llm.blocks import partitions
from casemill.llm.textbatch import U, mix
from casemill.session import stage

# The pre-split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_WORDS = 200_000


@dataclass(frozen=True)
class TokenShards:
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    end: int = 50_256
    length: int = 1024
    slots: int = 256
    key: int = 20_240_229
    rounds: int = 6


def id_type(ranks: dict[bytes, int], p: TokenShards) -> np.dtype:
    return np.dtype("<u2" if max(*ranks.values(), p.end) < 1 << 16 else "<u4")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Tokenizer:
    """Ids of a text as bytes. Words come back often, so the ids of a word are looked up first."""

    def __init__(self, ranks: dict[bytes, int], kind: np.dtype = np.dtype("<u2")):
        import tiktoken

        self.kind = kind
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    def direct(self, text: str) -> bytes:
        return np.array(self.encode(text), self.kind).tobytes()

    def __call__(self, text: str) -> bytes:
        # A blank after a non-blank always begins a new piece of the pattern, so words are encoded on their own.
        # Only next to other white space may a blank join it.
        words = text.split(" ")
        if "" in words or text[-1:].isspace() or any(w[-1].isspace() or w[0].isspace() for w in words):
            return self.direct(text)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        out = [self.direct(words[0])]
        for w in words[1:]:
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self.direct(" " + w)
            out.append(ids)
        return b"".join(out)


def packed(docs: DataFrame, p: TokenShards) -> DataFrame:
    """``part, at, tokens``: the sequences of each task."""
    ranks = read_ranks(p.vocabulary)
    kind = id_type(ranks, p)
    blob = docs.sparkSession.sparkContext.broadcast(ranks)
    end, stride = np.array([p.end], kind).tobytes(), kind.itemsize * p.length

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part, at, rest = Tokenizer(blob.value, kind), TaskContext.get().partitionId(), 0, b""

        def rows(data: bytes, first: int) -> pa.RecordBatch:
            cut = [data[i : i + stride] for i in range(0, len(data), stride)]
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(cut), part, np.int32)), pa.array(np.arange(first, first + len(cut))), pa.array(cut, pa.binary()),
            ], names=["part", "at", "tokens"])

        for batch in batches:
            data, size = [rest], len(rest)
            for text in batch.column("text"):
                text = text.as_py()
                if text:
                    data += [tokenizer(text), end]
                    size += len(data[-2]) + len(end)
                if size > 8 << 20:
                    whole = b"".join(data)
                    full = len(whole) // stride * stride
                    yield rows(whole[:full], at)
                    at += full // stride
                    data, size = [whole[full:]], len(whole) - full
            rest = b"".join(data)
            full = len(rest) // stride * stride
            if full:
                yield rows(rest[:full], at)
                at, rest = at + full // stride, rest[full:]
        if rest:
            yield rows(rest + end * ((stride - len(rest)) // len(end)), at)

    return docs.select("text").mapInArrow(task, "part int, at bigint, tokens binary")


def permute(x: np.ndarray, n: int, key: int, rounds: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of ``range(n)``: Feistel rounds, walked along the cycle until below n."""
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    mask, shift = U((1 << half) - 1), U(half)
    keys = mix(np.arange(rounds, dtype=U) * U(0x9E3779B97F4A7C15) + mix(np.array([key], np.int64).view(U)))
    keys = keys[::-1] if back else keys
    out = x.astype(U)
    walking = np.ones(len(out), bool)
    while walking.any():
        left, right = out[walking] >> shift, out[walking] & mask
        for k in keys:
            if back:
                left, right = right ^ (mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (mix(right ^ k) & mask)
        out[walking] = (left << shift) | right
        walking[walking] = out[walking] >= U(n)
    return out.astype(np.int64)


def numbered(sequences: DataFrame, p: TokenShards) -> tuple[DataFrame, int]:
    """Sequences with their slot, and how many there are. Only one count per task is ordered in one place."""
    counts = sequences.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(counts.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "token-offsets")
    n = offsets.agg(F.sum("n")).first()[0] or 0
    key, rounds = p.key, p.rounds

    @F.pandas_udf("bigint")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, key, rounds))

    out = sequences.join(offsets.select("part", "offset"), "part")
    return out.select(slot(F.col("offset") + F.col("at")).alias("slot"), "tokens"), n


SHARDS = "shard bigint, first_slot bigint, n_slots bigint, stride bigint, payload_sha256 string, payload binary"


def token_shards(docs: DataFrame, p: TokenShards = TokenShards()) -> DataFrame:
    """One row per shard: its first slot, number of slots, bytes per slot, and the ids of its slots in order."""
    sequences = packed(docs, p)
    path_friendly = stage(sequences, "token-sequences", compression="zstd")
    rows, n = numbered(path_friendly, p)
    rows = rows.withColumn("shard", F.floor(F.col("slot") / p.slots).cast("bigint"))
    tasks, shards = partitions(docs), max(1, -(-n // p.slots))
    ranged = rows.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int")).sortWithinPartitions("slot")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, parts = None, 0, []

        def row() -> pa.RecordBatch:
            payload = b"".join(parts)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int64()), pa.array([first], pa.int64()), pa.array([len(parts)], pa.int64()),
                pa.array([len(parts[0])], pa.int64()), pa.array([sha256(payload).hexdigest()]), pa.array([payload], pa.binary()),
            ], names=["shard", "first_slot", "n_slots", "stride", "payload_sha256", "payload"])

        for batch in batches:
            for s, slot, tokens in zip(batch.column("shard").to_pylist(), batch.column("slot").to_pylist(), batch.column("tokens").to_pylist()):
                if s != shard:
                    if parts:
                        yield row()
                    shard, first, parts = s, slot, []
                parts.append(tokens)
        if parts:
            yield row()

    return ranged.select("shard", "slot", "tokens").mapInArrow(task, SHARDS)


def sequences(shards: DataFrame, from_slot: int | Column = 0) -> DataFrame:
    """``slot, tokens`` from a slot on; earlier shards are not read from a stored table."""
    slots = F.explode(F.sequence(F.lit(0), F.col("n_slots") - 1)).alias("i")
    rows = shards.where(F.col("first_slot") + F.col("n_slots") > from_slot).select("first_slot", "stride", "payload", slots)
    rows = rows.select((F.col("first_slot") + F.col("i")).alias("slot"),
                       F.substring("payload", (F.col("i") * F.col("stride") + 1).cast("int"), F.col("stride").cast("int")).alias("tokens"))
    return rows.where(F.col("slot") >= from_slot)


MANIFEST = "shard bigint, first_slot bigint, n_slots bigint, stride bigint, payload_sha256 string, file string"


def write_files(shards: DataFrame, folder: str) -> DataFrame:
    """One file per shard in a folder that all executors share, and the manifest: ``MANIFEST`` rows, stored as a table beside
    them. A file gets its name only when it is whole, so a task may be repeated, and a reader finds slot s at byte
    ``(s - first_slot) * stride``."""
    folder = folder.rstrip("/")
    columns = [c.split()[0] for c in MANIFEST.split(", ")][:-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        files.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            names = []
            for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload")):
                names.append(f"shard-{shard:010d}.bin")
                with files.open_output_stream(f"{base}/.{names[-1]}.{attempt}") as out:
                    out.write(payload.as_buffer())
                files.move(f"{base}/.{names[-1]}.{attempt}", f"{base}/{names[-1]}")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(names, pa.string())], names=[*columns, "file"])

    written = shards.select(*columns, "payload").mapInArrow(task, MANIFEST)
    written.write.mode("append").parquet(f"{folder}/manifest")
    return shards.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def missing(shards: DataFrame, written: DataFrame) -> DataFrame:
    """The shards an interrupted export still lacks."""
    return shards.join(written.select("shard"), "shard", "left_anti")
