"""Exact top-k search by inner product: bounds from segment means and deviations, coarse to fine.

Components become whole numbers ``floor(scale * x)``. Every vector whose id is divisible by ``every`` is a query; the
others and all other queries are its candidates. The score is the inner product of the whole numbers, which is half of
``|q|^2 + |v|^2 - distance^2``, so a lower bound of the distance is an upper bound of the score.

Rows
    Vectors that are null or hold null or non-finite components take no part. Vectors without id are candidates, come
    after all others of equal score and have a null ``vec_id`` in the result; they are no queries. Rows that share an id
    are vectors of their own (a query row leaves out itself only). Vectors of another length than the query's are no
    candidates for it; an empty vector scores 0 with other empty ones. Scores beyond 64 bits raise an error. Empty
    table, or no candidates: no rows. Other columns are ignored.

Method
    * A level cuts a vector into segments. With mean m and deviation s of a segment of n components, Cauchy-Schwarz
      gives ``sum(q v) <= n (m_q m_v + s_q s_v)``; in terms of distances this is the bound by segment means and
      deviations. Levels of 1, 4, 16 segments are tried in turn on the candidates that the one before left.
    * On each level the candidates with the highest bounds get their exact scores; then those are left out whose bound,
      plus a margin for rounding, lies below the k-th best exact score. What survives all levels is scored exactly.
      Vectors without structure along their components keep most candidates; results are the same, the work is not less.
    * Queries and candidates are cut into tiles of bounded numbers of rows; a task handles one pair of tiles and hands
      on k rows per query at most. The k best of each query are then chosen over all tiles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from casemill.llm.blocks import partitions
from casemill.session import stage


@dataclass(frozen=True)
class TopK:
    k: int = 5
    every: int = 50
    scale: int = 256
    levels: tuple[int, ...] = (1, 4, 16)
    queries: int = 1024
    candidates: int = 8192
    block: int = 64


def usable(vectors: DataFrame, vector: str, id_: str) -> DataFrame:
    """``row, id, size, v`` of the vectors that take part, all components finite doubles."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(f"`{id_}`").cast("bigint").alias("id"), v.alias("v")).where(F.col("v").isNotNull())
            .where(finite).withColumn("size", F.size("v")).withColumn("row", F.monotonically_increasing_id()))


def _matrix(column: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return np.floor(scale * flat.flatten().to_numpy(zero_copy_only=False)).reshape(len(flat), width)


def _level(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """For each segment: mean times, and deviation times, the root of its length."""
    edge = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    size = np.diff(edge)
    mean = np.add.reduceat(x, edge[:-1], axis=1) / size
    centred = x - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(centred * centred, edge[:-1], axis=1))


def _dot(x: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``x[at] @ q``; where most rows are asked for, without copying them."""
    return (x @ q)[at] if 2 * len(at) > len(x) else x[at] @ q


def _exact(x: np.ndarray, at: np.ndarray, q: np.ndarray, sure: bool) -> np.ndarray:
    """Inner products; by whole numbers of any size where doubles could round."""
    if sure:
        return _dot(x, at, q)
    own = [int(c) for c in q]
    return np.array([sum(int(a) * b for a, b in zip(row, own)) for row in x[at].tolist()] + [None], dtype=object)[:-1]


def _best(number: np.ndarray, score: np.ndarray, more: np.ndarray, scores: np.ndarray, v_id: np.ndarray, v_row: np.ndarray, k: int,
          ) -> tuple[np.ndarray, np.ndarray]:
    """The k best of both lists, best first, ties by id and row."""
    if len(number) == k:
        near = scores >= score[-1]
        more, scores = more[near], scores[near]
    number, score = np.concatenate([number, more]), np.concatenate([score, scores])
    order = sorted(range(len(number)), key=lambda j: (-score[j], v_id[number[j]], v_row[number[j]])) if len(number) < 256 or score.dtype == object else (
        np.lexsort((v_row[number], v_id[number], -score)))
    order = np.array(order[:k], np.int64)
    return number[order], score[order]


def search_tile(q: np.ndarray, q_row: np.ndarray, v: np.ndarray, v_row: np.ndarray, v_id: np.ndarray, p: TopK) -> list[tuple[int, int, int]]:
    """``(number of the query, number of the candidate, score)`` of the k best of each query. ``v_id``: order of ties."""
    if not q.shape[1]:
        order = np.lexsort((v_row, v_id))
        return [(i, int(j), 0) for i in range(len(q)) for j in order[v_row[order] != q_row[i]][: p.k]]
    levels = [(_level(q, s), _level(v, s)) for s in p.levels]
    q_norm, v_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    sure = float(q_norm.max() * v_norm.max()) < 2.0**52
    out = []
    for i in range(len(q)):
        at = np.flatnonzero(v_row != q_row[i])
        number, score = at[:0], np.zeros(0, object if not sure else float)
        for (qm, qs), (vm, vs) in levels:
            bound = _dot(vm, at, qm[i]) + _dot(vs, at, qs[i]) + 1e-9 * q_norm[i] * v_norm[at] + 1e-9
            for last in (False, True):
                if len(number) == p.k:
                    left = bound >= float(score[-1])
                    at, bound = at[left], bound[left]
                if not last:  # the most promising ones give a good k-th score
                    first = np.argpartition(-bound, p.block)[: p.block] if len(at) > p.block else np.arange(len(at))
                    number, score = _best(number, score, at[first], _exact(v, at[first], q[i], sure), v_id, v_row, p.k)
                    rest = np.ones(len(at), bool)
                    rest[first] = False
                    at, bound = at[rest], bound[rest]
        number, score = _best(number, score, at, _exact(v, at, q[i], sure), v_id, v_row, p.k)
        out += [(i, int(c), int(s)) for c, s in zip(number, score)]
    return out


FOUND = "query_row bigint, query_id bigint, vec_id bigint, vec_row bigint, score bigint"


def top_k(vectors: DataFrame, vector: str = "embedding", id_: str = "vec_id", p: TopK = TopK()) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best of each query, ties to the smaller id."""
    rows = stage(usable(vectors, vector, id_), "search-vectors")
    asks = (F.col("id") % p.every == 0)
    n, m = rows.agg(F.count(F.lit(1)), F.count(F.when(asks, 1))).first()
    few = partitions(rows)
    tiles, query_tiles = max(-(-n // p.candidates), min(few, n), 1), max(-(-m // p.queries), 1)
    deal = lambda count: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = rows.withColumn("tile", deal(tiles)).withColumn("query_tile", every(query_tiles))
    # names of its own for each column: both sides come from one table, and a cogroup must not take them for the same
    queries = rows.where(asks).select(*[F.col(c).alias(f"q_{c}") for c in rows.columns], deal(query_tiles).alias("q_query_tile"), every(tiles).alias("q_tile"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        left = left.rename_columns([c.removeprefix("q_") for c in left.column_names])
        sizes = set(left.column("size").to_pylist()) & set(right.column("size").to_pylist()) if left.num_rows and right.num_rows else ()
        for size in sorted(sizes):
            a, b = (t.filter(pc.equal(t.column("size"), size)) for t in (left, right))
            ids, rows_ = b.column("id").to_pylist(), b.column("row").to_numpy()
            last = (1 << 63) - 1
            order = np.array([last if x is None else x for x in ids], np.int64)
            hits = search_tile(_matrix(a.column("v"), size, p.scale), a.column("row").to_numpy(), _matrix(b.column("v"), size, p.scale), rows_, order, p)
            q_ids, q_rows = a.column("id").to_pylist(), a.column("row").to_pylist()
            found += [(q_rows[i], q_ids[i], ids[c], int(rows_[c]), s) for i, c, s in hits]
        names = ["query_row", "query_id", "vec_id", "vec_row", "score"]
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in range(5)], names=names)

    found = queries.groupBy("q_query_tile", "q_tile").cogroup(candidates.groupBy("query_tile", "tile")).applyInArrow(compare, FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
