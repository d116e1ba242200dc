"""Words of Arrow text batches as numpy arrays, and 64-bit hashes that are the same in every task.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_NAMES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept per task and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U)
        while len(have) < n:
            have = np.concatenate([have, have * U(pow(base, len(have), 1 << 64))])
        _powers[base] = have
    return have[:n]


def window_hashes(names: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive names, by doubling: log2(width) passes."""
    if len(names) < width:
        return np.zeros(0, U)
    done, done_len, part, part_len, left = None, 0, names, 1, width
    while left:
        if left & 1:
            if done is None:
                done, done_len = part, part_len
            else:
                n = len(part) - done_len
                done = done[:n] * U(pow(_BASE, part_len, 1 << 64)) + part[done_len : done_len + n]
                done_len += part_len
        left >>= 1
        if left:
            part = part[:-part_len] * U(pow(_BASE, part_len, 1 << 64)) + part[part_len:]
            part_len *= 2
    return mix(done[: len(names) - width + 1])


@dataclass
class Words:
    """Words of consecutive documents: ``buffer[start:end]`` of each, the number of the first word of each document
    (with the total at the end) and a hash of each."""

    buffer: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    names: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    data = b"\n".join(texts) + b"\n"
    buffer = np.frombuffer(data, np.uint8)
    space = _SPACE[buffer]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(start, starts)
    sums = np.zeros(len(buffer) + 1, U)
    np.cumsum(BYTE_NAMES[buffer] * powers(_BASE, len(buffer)), out=sums[1:])
    names = (sums[end] - sums[start]) * powers(_INVERSE, len(buffer))[start]
    return Words(buffer, start, end, first, mix(names ^ (end - start).astype(U)))


def chunks(ids: list, texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Split documents into lists of about ``limit`` bytes; a longer document is a list of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield ids[begin:i], texts[begin:i]
            begin, size = i, 0
        size += len(t) + 1
    if begin < len(texts):
        yield ids[begin:], texts[begin:]


def column_bytes(batch: pa.RecordBatch | pa.Table, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def starts_inside(first: np.ndarray, width: int) -> np.ndarray:
    """All positions where a window of ``width`` fits into its document; ``first`` as in ``Words``."""
    count = np.maximum(np.diff(first) - width + 1, 0)
    total = int(count.sum())
    begin = np.repeat(first[:-1] - (np.cumsum(count) - count), count)
    return begin + np.arange(total)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``width`` that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1) if len(starts) < 1000 else change.__iadd__(np.bincount(starts, minlength=n + 1).astype(np.int32))
    ends = starts + width
    change -= np.bincount(ends, minlength=n + 1)[: n + 1].astype(np.int32)
    return np.cumsum(change[:n]) > 0


def contains(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Membership of ``keys`` in a sorted array."""
    if not len(table):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return table[at] == keys
