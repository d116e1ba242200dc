"""Find keys that occur more than once over all documents, without a row per occurrence.

Documents are dealt into blocks by a hash of id and text. A block names each of its keys once (bit 0 of the key tells whether
it has the key more than once), so however often a key occurs, no more rows meet than there are blocks. Keys are
dealt into buckets by their top bits. A bucket answers each block with those of its keys that are repeated.
There are two blocks and half a bucket to each of ``spark.sql.shuffle.partitions``, which a user sets in proportion to
the data; every group handled in one task is then about as large as a partition.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casemill.llm.textbatch import U, contains

KEYS = "block int, bucket int, names array<bigint>"
ANSWERS = "block int, names array<bigint>"
BLOCKS_PER_PARTITION = 2


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def buckets(df: DataFrame) -> int:
    return max(1, partitions(df) // 2)


def by_block(docs: DataFrame) -> DataFrame:
    """Rows with their block number. Rows that share an id, or have none, are spread by their texts; equal rows stay together,
    and however many they are, a block names their keys once."""
    n = BLOCKS_PER_PARTITION * partitions(docs)
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))


def marked(keys: np.ndarray) -> np.ndarray:
    """Distinct keys; bit 0 is 1 for those that occur more than once here."""
    found, count = np.unique(keys & ~U(1), return_counts=True)
    return found | (count > 1).astype(U)


def merged(parts: list[np.ndarray]) -> np.ndarray:
    """Marked keys of parts as marked keys of the whole."""
    if len(parts) == 1:
        return parts[0]
    keys = np.concatenate(parts) if parts else np.zeros(0, U)
    once = marked(keys)
    twice = keys[(keys & U(1)).astype(bool)]
    if len(twice):
        once |= contains(np.unique(twice & ~U(1)), once & ~U(1)).astype(U)
    return once


def by_bucket(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers that occur, and where each begins in the sorted ``keys`` (total at the end)."""
    bucket = ((keys >> U(32)) * U(n) >> U(32)).astype(np.int64)
    numbers, begin = np.unique(bucket, return_index=True)
    return numbers, np.append(begin, len(keys))


def lists(values: np.ndarray, begin: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.view(np.int64)))


def key_table(block: int, keys: np.ndarray, n: int) -> pa.Table:
    """``keys`` sorted, as rows of KEYS."""
    numbers, begin = by_bucket(keys, n)
    return pa.table([
        pa.array(np.full(len(numbers), block, np.int32)), pa.array(numbers.astype(np.int32)), lists(keys, begin),
    ], names=["block", "bucket", "names"])


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the number of each row's values."""
    whole = column.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks) if whole.num_chunks else pa.array([], whole.type)
    return whole.flatten().to_numpy(zero_copy_only=False).view(U), whole.value_lengths().to_numpy(zero_copy_only=False)


def repeated(keys: DataFrame) -> DataFrame:
    """For each block its keys (bit 0 cleared) that occur elsewhere too, or more than once in the block."""
    def answer(group: pa.Table) -> pa.Table:
        names, sizes = flat(group.column("names"))
        row = np.repeat(np.arange(len(sizes)), sizes)
        bare = names & ~U(1)
        order = np.argsort(bare, kind="stable")
        s = bare[order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        key = np.cumsum(new) - 1
        twice = (np.bincount(key) > 1) | (np.bincount(key, weights=(names[order] & U(1)).astype(float)) > 0)
        hit = np.zeros(len(s), bool)
        hit[order] = twice[key]
        begin = np.append(0, np.cumsum(np.bincount(row[hit], minlength=len(sizes))))
        answers = pa.table([group.column("block").combine_chunks(), lists(bare[hit], begin)], names=["block", "names"])
        return answers.filter(pa.array(np.diff(begin) > 0))

    return keys.groupBy("bucket").applyInArrow(answer, ANSWERS)


def each_block(docs: DataFrame, fn: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn(block, documents)`` for each block."""
    def one(group: pa.Table) -> pa.Table:
        return fn(group.column("block")[0].as_py(), group)

    return docs.groupBy("block").applyInArrow(one, schema)


def with_answers(
    docs: DataFrame, answers: DataFrame, fn: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str,
) -> DataFrame:
    """``fn(block, documents, answers)`` for each block that has documents."""
    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(left.column("block")[0].as_py(), left, right)

    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(one, schema)
