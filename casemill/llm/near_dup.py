"""Near duplicates: b-bit MinHash signatures, a multi-index Hamming join, links confirmed on the full sets.

A document's set holds its distinct five-word shingles, lower-cased A-Z only (the whole sequence if it is shorter,
nothing without words). Two documents are linked if ``100 * |A n B| >= 85 * |A u B|``; a result row is one document
with the smallest ``doc_id`` it can reach.

Rows
    Null text and text without words: empty set, linked with nothing, its own component. Rows without ``doc_id`` are linked
    with nothing: their component is null, and they are kept. Repeated rows give a result row each. Rows of one ``doc_id`` with
    different texts: each text reaches what its own set reaches. Empty table: no rows. Other columns are ignored.

Method
    * ``symbols`` minhashes of 8 bits each. Documents at the limit differ in 15 % of the symbols on average; ``errors``
      lies 5.5 standard deviations above that (chance of passing over such a pair: about 1 in 10 million).
    * The signature is split into chunks so few that two signatures with at most ``errors`` different symbols have a
      chunk with one different symbol at most (pigeonhole). The allowed error is enumerated: a key for each chunk and
      each symbol left out. Documents that share a key are candidates; signatures and set sizes are compared next.
    * Documents with equal sets (two digests of 64 bits) are one representative from the start. In a bucket every member
      first meets the members that lie in the largest buckets (the originals of a group of copies) and is compared with the few
      of them that it meets most often, so the pairs grow with the members only; confirmed links are joined into components.
    * Where a bucket then still holds several components, its members are compared in tiles of bounded size, by a longer
      signature with the same margin. A tile hands on no pairs, only which components may belong together, as a forest.
    * Components that may belong together are a family. The full sets of a family meet once, in tiles of bounded size;
      a tile counts common shingles through its own index, joins confirmed links at once and hands on a forest of them. So no
      step sends more links than it has members, and every pair that a bucket holds is confirmed or refuted on full sets.
    * Sets of representatives that share a bucket are computed once more from the texts and stored. The joins on the way to
      the texts are never broadcast, so the plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casemill.llm.components import components
from casemill.llm.blocks import flat, partitions
from casemill.llm.textbatch import LOWER, U, chunks, column_bytes, contains, mix, words_of
from casemill.session import stage


@dataclass(frozen=True)
class NearDup:
    shingle: int = 5
    percent: int = 85
    symbols: int = 65
    long_symbols: int = 384
    centres: int = 3
    tile: int = 2048
    tile_shingles: int = 1_000_000

    def allowed(self, symbols: int) -> int:
        p = 1 - self.percent / 100
        return int(symbols * p + 5.5 * (symbols * p * (1 - p)) ** 0.5)

    @property
    def errors(self) -> int:
        return self.allowed(self.symbols)

    @property
    def chunks(self) -> list[tuple[int, int]]:
        """Begin and end of each chunk; (errors + 1) / 2 of them, rounded up."""
        n = -(-(self.errors + 1) // 2)
        edge = np.linspace(0, self.symbols, n + 1).round().astype(int)
        return list(zip(edge[:-1].tolist(), edge[1:].tolist()))


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all documents one after another, and where each document begins."""
    w = words_of([t.translate(LOWER) for t in texts])
    sets = []
    full = np.zeros(0, U)
    if len(w.names) >= width:
        full = np.zeros(len(w.names) - width + 1, U)
        for j in range(width):
            full = mix(full + w.names[j : len(full) + j] * U(2 * j + 1))
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= width:
            sets.append(np.unique(full[a : b - width + 1]))
        elif b > a:
            short = np.zeros(1, U)
            for j in range(b - a):
                short = mix(short + w.names[a + j : a + j + 1] * U(2 * j + 1))
            sets.append(mix(short + U(b - a)))
        else:
            sets.append(full[:0])
    begin = np.cumsum([0] + [len(s) for s in sets])
    return (np.concatenate(sets) if sets else full[:0]), begin


def _digests(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set; none of the sets is empty."""
    a = mix(np.add.reduceat(values, edges[:-1]) + np.diff(edges).astype(U))
    return a, mix(np.add.reduceat(mix(values ^ U(0x5851F42D4C957F2D)), edges[:-1]))


def _signatures(values: np.ndarray, begin: np.ndarray, k: int, skip: int = 0) -> np.ndarray:
    """Low bytes of k minhashes for documents with sets that are not empty."""
    factors = mix(np.arange(skip + 1, skip + k + 1, dtype=U) * U(0xD1342543DE82EF95)) | U(1)
    out = np.empty((len(begin) - 1, k), np.uint8)
    for j, f in enumerate(factors):
        out[:, j] = (mix(np.minimum.reduceat(values * f ^ (values >> U(29)), begin[:-1])) & U(255)).astype(np.uint8)
    return out


SIGNED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature binary"


def signatures(docs: DataFrame, p: NearDup) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in chunks(batch.column("doc_id").to_pylist(), column_bytes(batch, "text")):
                values, begin = shingle_sets(texts, p.shingle)
                n = np.diff(begin)
                has = np.flatnonzero(n)
                a, b = np.zeros(len(n), U), np.zeros(len(n), U)
                sig: list[bytes | None] = [None] * len(n)
                if len(has):
                    edges = np.append(begin[:-1][has], begin[-1])
                    a[has], b[has] = _digests(values, edges)
                    for row, s in zip(has, _signatures(values, edges, p.symbols)):
                        sig[row] = s.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)), pa.array(sig, pa.binary()),
                ], names=["doc_id", "n_shingles", "set_a", "set_b", "signature"])

    return docs.select("doc_id", "text").mapInArrow(task, SIGNED)


def _chunk_keys(sig: np.ndarray, p: NearDup) -> np.ndarray:
    """A key for each document (row), chunk and left-out symbol."""
    weights = mix(np.arange(1, p.symbols + 1, dtype=U)) | U(1)
    part = mix((sig.astype(U) + U(1)) * weights)
    out = np.empty(sig.shape, U)
    for c, (a, b) in enumerate(p.chunks):
        whole = part[:, a:b].sum(axis=1, dtype=U)
        for j in range(a, b):
            out[:, j] = mix(whole - part[:, j] + U((c << 16) + j))
    return out


def bucket_keys(reps: DataFrame, p: NearDup) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                sig = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8).reshape(-1, p.symbols)
                ids = part.column("rep").to_numpy()
                yield pa.RecordBatch.from_arrays([
                    pa.array(_chunk_keys(sig, p).view(np.int64).ravel()), pa.array(np.repeat(ids, p.symbols)),
                    pa.array(np.tile(np.arange(p.symbols, dtype=np.int16), len(ids))),
                ], names=["key", "rep", "left_out"])

    return reps.select("rep", "signature").mapInArrow(task, "key bigint, rep bigint, left_out smallint")


def shared_buckets(reps: DataFrame, p: NearDup) -> DataFrame:
    """``key, rep, left_out, size`` of every bucket with two members or more.

    Nearly all keys occur once, so a count per task would hold them all and save nothing: keys are made once, go to their
    bucket and are counted there. The representatives are dealt evenly first, as each gives ``symbols`` rows.
    """
    dealt = reps.select("rep", "signature").repartition(partitions(reps), "rep")
    size = F.count(F.lit(1)).over(Window.partitionBy("key"))
    return bucket_keys(dealt, p).withColumn("size", size).where("size > 1")


def _different(p: NearDup, a: str, b: str) -> F.Column:
    """Number of different symbols of two signatures."""
    x, y = F.hex(a), F.hex(b)
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(p.symbols - 1)), lambda i: F.substr(x, i * 2 + 1, F.lit(2)) != F.substr(y, i * 2 + 1, F.lit(2))))


SETS = "set_a bigint, set_b bigint, values array<bigint>, long binary"


def stored_sets(docs: DataFrame, reps: DataFrame, p: NearDup) -> DataFrame:
    """Sets and long signatures of the representatives ``reps(rep, id, set_a, set_b)``, with a block number."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column("doc_id").to_pylist(), column_bytes(batch, "text")):
                values, begin = shingle_sets(texts, p.shingle)
                edges = np.append(begin[:-1][np.diff(begin) > 0], begin[-1])
                if len(edges) < 2:
                    continue
                long = [x.tobytes() for x in _signatures(values, edges, p.long_symbols, skip=p.symbols)]
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(x.view(np.int64)) for x in _digests(values, edges)],
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values.view(np.int64))), pa.array(long, pa.binary()),
                ], names=["set_a", "set_b", "values", "long"])

    ids = reps.select(F.col("id").alias("doc_id")).distinct()
    rows = docs.where("doc_id is not null").select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")
    found = rows.mapInArrow(task, SETS)
    # texts that share an id, and repeated rows, give sets that are not asked for, or twice
    named = found.join(reps.select("rep", "set_a", "set_b").hint("merge"), ["set_a", "set_b"]).dropDuplicates(["rep"])
    return stage(named.select("rep", "values", "long").withColumn("block", _block(F.col("rep"), docs)), "near-sets")


def _block(rep: F.Column, docs: DataFrame) -> F.Column:
    return F.pmod(F.hash(rep), F.lit(partitions(docs))).cast("int")


def confirm(sets: DataFrame, wanted: DataFrame, p: NearDup) -> DataFrame:
    """Links among ``wanted(a, others array<bigint>)``, on the full sets."""
    wanted = stage(wanted, "near-wanted")
    others = wanted.select("a", F.explode("others").alias("other"))
    sent = others.groupBy("a", _block(F.col("other"), sets).alias("block")).agg(F.collect_set("other").alias("others"))
    lefts = sets.select(F.col("rep").alias("a"), F.col("values").alias("sent"))
    sent = sent.hint("merge").join(lefts, "a").select("block", "a", "others", "sent")
    here = sets.select("block", "rep", "values").join(others.select(F.col("other").alias("rep")).distinct().hint("merge"), "rep", "left_semi")

    def check(here: pa.Table, there: pa.Table) -> pa.Table:
        own: dict[int, list[np.ndarray]] = {}
        for i, v in zip(here.column("rep").to_pylist(), here.column("values")):
            own.setdefault(i, []).append(v.values.to_numpy().view(U))
        links = []
        for a, many, v in zip(there.column("a").to_pylist(), there.column("others").to_pylist(), there.column("sent")):
            left = v.values.to_numpy().view(U)
            for b in many:
                for right in own.get(b, ())[:1]:
                    common = int(contains(left, right).sum())
                    if 100 * common >= p.percent * (len(left) + len(right) - common):
                        links.append((a, b))
        return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return here.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(check, "a bigint, b bigint")


class Joined:
    """Labels that are merged by and by; ``pairs`` keeps one link for each merge."""

    def __init__(self, labels: np.ndarray) -> None:
        self.label = labels.copy()
        self.pairs: list[tuple[int, int]] = []

    def merge(self, i: int, j: int, a: int, b: int) -> None:
        x, y = self.label[i], self.label[j]
        if x != y:
            self.label[self.label == y] = x
            self.pairs.append((a, b))

    def table(self) -> pa.Table:
        return pa.table([pa.array([x[k] for x in self.pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _tiled(rows: DataFrame, tiles: F.Column) -> DataFrame:
    """Every row once for each pair of tiles that its own tile belongs to."""
    rows = rows.withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other", "tiles")


def families(members: DataFrame, p: NearDup) -> DataFrame:
    """``a, b``: components that similar signatures in one bucket connect, as a forest of each tile."""
    rows = _tiled(members, F.ceil(F.col("size") / p.tile).cast("int")).select(
        "key", "low", "high", "own", "rep", "left_out", "component", "n_shingles", "signature", "long")
    edges = np.array([a for a, _ in p.chunks])
    allowed = p.allowed(p.long_symbols)

    def compare(group: pa.Table) -> pa.Table:
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        reps, own, comp, size = (group.column(c).to_numpy() for c in ("rep", "own", "component", "n_shingles"))
        sig, long = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.uint8).reshape(len(reps), -1) for c in ("signature", "long"))
        at = group.column("left_out")[0].as_py()
        chunk = int(np.searchsorted(edges, at, side="right") - 1)
        a0, b0 = p.chunks[chunk]
        joined = Joined(comp)
        right = np.flatnonzero(own == high)
        for i in np.flatnonzero(own == low):
            j = right[(joined.label[right] != joined.label[i]) & (size[right] * 100 >= size[i] * p.percent) & (size[i] * 100 >= size[right] * p.percent)]
            if low == high:
                j = j[reps[j] > reps[i]]
            if not len(j):
                continue
            # each pair once: with the first different symbol of the chunk (or its first symbol) left out ...
            differ = sig[j] != sig[i]
            inside = differ[:, a0:b0]
            on = (np.where(inside.any(axis=1), np.argmax(inside, axis=1), 0) + a0 == at) & (differ.sum(axis=1) <= p.errors)
            j, differ = j[on], differ[on]
            # ... and in the first chunk with one error at most
            if chunk and len(j):
                earlier = np.add.reduceat(differ[:, :a0].astype(np.uint8), edges[:chunk], axis=1)
                j = j[(earlier > 1).all(axis=1)]
            if len(j):
                j = j[(long[j] != long[i]).sum(axis=1) <= allowed]
            for k in j:
                joined.merge(i, k, int(comp[i]), int(comp[k]))
        return joined.table()

    return rows.groupBy("key", "low", "high").applyInArrow(compare, "a bigint, b bigint")


def links_in_families(members: DataFrame, p: NearDup) -> DataFrame:
    """``a, b``: confirmed links between members ``(family, rep, component, values)`` of different components, as a
    forest of each tile."""
    sizes = members.groupBy("family").agg(F.sum(F.size("values")).alias("shingles"))
    rows = members.join(sizes, "family").select("family", "rep", "component", "values", "shingles")
    rows = _tiled(rows, F.ceil(F.col("shingles") / p.tile_shingles).cast("int"))

    def confirm_all(group: pa.Table) -> pa.Table:
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        reps, own, comp = (group.column(c).to_numpy() for c in ("rep", "own", "component"))
        values, n = flat(group.column("values"))
        begin = np.concatenate([[0], np.cumsum(n)])
        _, name, times = np.unique(values, return_inverse=True, return_counts=True)
        holders = np.repeat(np.arange(len(n)), n)[np.argsort(name, kind="stable")]
        first = np.cumsum(times) - times
        joined = Joined(comp)
        # every pair has an end outside the largest component
        known, many = np.unique(comp, return_counts=True)
        for i in np.flatnonzero(comp != known[many.argmax()]):
            mates = joined.label != joined.label[i]
            mates &= (own == low if own[i] == high else own == high)
            if not mates.any():
                continue
            shingles = name[begin[i] : begin[i + 1]]
            size = times[shingles]
            at = np.repeat(first[shingles] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            common = np.bincount(holders[at], minlength=len(n))
            for j in np.flatnonzero(mates & (100 * common >= p.percent * (n + n[i] - common))):
                joined.merge(i, j, int(reps[i]), int(reps[j]))
        return joined.table()

    return rows.groupBy("family", "low", "high").applyInArrow(confirm_all, "a bigint, b bigint")


def first_pairs(met: DataFrame, p: NearDup) -> DataFrame:
    """``a, b``: for each member ``rep`` the ``centres`` representatives ``a`` that it meets in the most buckets."""
    pairs = met.where("rep <> a").groupBy("a", F.col("rep").alias("b")).agg(F.count(F.lit(1)).alias("shared"), F.max("weight").alias("weight"))
    nearest = Window.partitionBy("b").orderBy(F.desc("shared"), F.desc("weight"), F.desc("a"))
    return pairs.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= p.centres).select("a", "b")


def near_duplicates(docs: DataFrame, p: NearDup = NearDup()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document."""
    signed = stage(signatures(docs, p), "near-signatures")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    reps = stage(filled.groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("id"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature"),
    ).withColumn("rep", F.monotonically_increasing_id()), "near-representatives")
    members = stage(shared_buckets(reps, p), "near-buckets")
    weight = members.groupBy("rep").agg(F.sum("size").alias("weight"))
    # the members of each bucket that lie in the largest buckets; a task hands on no more than these of a bucket
    order = Window.partitionBy("key").orderBy(F.desc("weight"), F.desc("rep"))
    best = members.join(weight, "rep").select("key", "weight", "rep").withColumn("place", F.row_number().over(order)).where(F.col("place") <= p.centres)
    stars = first_pairs(members.join(best.select("key", F.col("rep").alias("a"), "weight"), "key"), p)
    facts = reps.select("rep", "n_shingles", "signature")
    left, right = (facts.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}"))
                   for c in "ab")
    close = (stars.join(left, "a").join(right, "b")
             .where(f"n_a * 100 >= n_b * {p.percent} and n_b * 100 >= n_a * {p.percent}")
             .where(_different(p, "s_a", "s_b") <= p.errors))
    sets = stored_sets(docs, reps.join(members.select("rep").distinct(), "rep", "left_semi"), p)
    first = stage(confirm(sets, close.groupBy("a").agg(F.collect_set("b").alias("others")), p), "near-links")
    found = components(first, "near-first")
    labelled = members.join(found.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    open_ = stage(labelled.join(mixed.select("key"), "key", "left_semi"), "near-open")
    # stored: the links are read in both directions, the tiles are compared once
    related = stage(families(open_.join(facts, "rep").join(sets.select("rep", "long"), "rep"), p), "near-related")
    family = components(related, "near-families").select(F.col("id").alias("component"), F.col("component").alias("family"))
    asked = open_.select("rep", "component").distinct().join(family, "component").join(sets.select("rep", "values"), "rep")
    rest = stage(links_in_families(asked, p), "near-links")
    joined = components(first.union(rest), "near-all").withColumnRenamed("id", "rep")
    # components of representatives are named by their smallest document
    whole = reps.select("rep", "set_a", "set_b", "id").join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    names = whole.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = whole.join(names, "component").select("set_a", "set_b", "component_id")
    named = F.col("n_shingles") > 0
    shared = signed.where(named & F.col("doc_id").isNotNull()).join(classes, ["set_a", "set_b"]).select("doc_id", "n_shingles", "component_id")
    alone = signed.where(~named | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return shared.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
