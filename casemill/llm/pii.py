"""Personal data: patterns, and the terms that give them away. Columns only.

Patterns (``email ip card phone``) are found leftmost and without overlap per kind; matches that fail the kind's rule
(ip parts at most 255, 16 to 19 card digits that pass Luhn, 8 to 15 phone digits) are dropped. The patterns are written
so that a long run of one character class is read once.

Information-theoretic sanitisation: the protected entities are the values found. A term is a lower-cased run of at
least ``term_letters`` letters, anywhere in a document. With documents as the events,

    disclosure(term, entity) = log(n_both * N / (n_term * n_entity)) / log(N / n_entity)

tells how much of the entity's information content the term gives away (1: whoever knows the term knows the entity).
All counts are of whole documents. A term with a disclosure of at least ``disclosure`` that shares at least ``support``
different texts with the entity is a span of kind ``term`` wherever it stands in a document that holds the entity, unless
it lies inside a span of the patterns. As ``n_both`` is at most ``n_entity``, a term in more than
``N ** (1 - disclosure) * n_entity ** disclosure`` documents can not tell the entity: such pairs are never made.

Offsets are code points, ends exclusive.

Rows
    Null text: empty. No spans: counts 0, empty ``spans`` and the hash of the empty string. Repeated rows and null ids
    are documents of their own. An entity in all documents has no information to give away. Empty table: no rows. Other columns are
    ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from casemill.session import stage

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
# The patterns. A match of an email may begin in a run only where the last match ended.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}


@dataclass(frozen=True)
class Pii:
    term_letters: int = 4
    support: int = 2
    disclosure: float = 0.8


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    """Digit sum with every second digit from the right doubled is a multiple of 10."""
    digits = F.transform(F.split(F.reverse(_digits(c)), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    value = F.transform(digits, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(value, F.lit(0), lambda s, v: s + v) % 10 == 0


def valid(kind: Column, hit: Column) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda x: F.regexp_replace(x, "^0+", ""))
    small = F.forall(parts, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255")))
    n = F.length(_digits(hit))
    return (F.when(kind == "ip", small).when(kind == "card", n.between(16, 19) & _luhn(hit))
            .when(kind == "phone", n.between(8, 15)).otherwise(F.lit(True)))


def _found(text: Column, name: str, pattern: str) -> Column:
    """Matches in order, each with the number of characters between it and the match before."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(hits, lambda h, i: F.struct(
        F.lit(name).alias("kind"), i.alias("i"), F.get(gaps, i).alias("gap"), h.alias("hit")))


def _placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``keys``, ``i``, ``gap``, ``hit`` with ``first`` and ``end``."""
    before = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("bigint") + F.length("hit")).over(before)
    return rows.withColumn("end", end).withColumn("first", F.col("end") - F.length("hit"))


def _base(docs: DataFrame) -> DataFrame:
    """Every document with its matches; the text stays only where there are some."""
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,hit:string>>")
    digit = text.rlike("[0-9]")
    kinds = []
    for kind, pattern in PATTERNS.items():
        may = digit if _NEEDS[kind] is None else text.contains(_NEEDS[kind]) & (F.lit(True) if kind == "email" else digit)
        kinds.append(F.when(may, _found(text, kind, pattern)).otherwise(none))
    rows = docs.select("doc_id", text.alias("text"), F.concat(*kinds).alias("found"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("content", F.xxhash64("text"))
    return stage(rows.withColumn("text", F.when(F.size("found") > 0, F.col("text"))), "pii-found")


def entities(base: DataFrame) -> DataFrame:
    hits = base.where(F.size("found") > 0).select("row", F.inline("found"))
    return _placed(hits, ["row", "kind"]).where(valid(F.col("kind"), F.col("hit"))).select("row", "kind", "first", "end", "hit")


def _term(p: Pii) -> str:
    return rf"\p{{L}}{{{p.term_letters},}}"


def _distinct_terms(text: Column, p: Pii) -> Column:
    long = F.filter(F.split(text, r"[^\p{L}]+"), lambda w: F.length(w) >= p.term_letters)
    return F.array_distinct(F.transform(long, lambda w: F.lower(w)))


def _entity() -> Column:
    return F.concat_ws(":", "kind", F.lower("hit")).alias("entity")


def telling_terms(docs: DataFrame, base: DataFrame, found: DataFrame, p: Pii) -> DataFrame:
    """``entity, term`` of the pairs with enough support and disclosure. Copies of a text are counted through one of them."""
    n = float(docs.count())
    texts = base.where("text is not null").groupBy("content").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("n"))
    held = found.select("row", _entity()).join(texts, "row").select("content", "row", "n", "entity").distinct()
    having = held.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("texts"))
    having = having.where((F.col("texts") >= p.support) & (F.col("n_entity") < n)).drop("texts")
    held = stage(held.join(having, "entity"), "pii-held")
    # a term in more documents tells none of the entities of its text; the margin is for rounding
    most = F.pow(F.lit(n), F.lit(1 - p.disclosure)) * F.pow(F.col("n_entity"), F.lit(p.disclosure)) * 1.000001
    open_ = held.groupBy("row", "content").agg(F.max(most).alias("most"))
    words = open_.join(base.select("row", "text"), "row").select("content", "most", F.explode(_distinct_terms(F.col("text"), p)).alias("term"))
    every = docs.where("text is not null").select(F.explode(_distinct_terms(F.col("text"), p)).alias("term"))
    n_term = every.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")).where(F.col("n_term") >= p.support)
    words = words.join(n_term, "term").where(F.col("n_term") <= F.col("most")).select("content", "term", "n_term")
    pairs = held.select("content", "n", "entity", "n_entity").join(words, "content").where(F.col("n_term") <= most)
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("texts"),
                                                F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity"))
    gain = F.log(F.col("n_both") * n / (F.col("n_term") * F.col("n_entity"))) / F.log(F.lit(n) / F.col("n_entity"))
    return pairs.where((F.col("texts") >= p.support) & (gain >= p.disclosure)).select("entity", "term")


def occurrences(base: DataFrame, found: DataFrame, telling: DataFrame, p: Pii) -> DataFrame:
    """``row, kind, first, end`` of the telling terms in the documents that hold their entity."""
    by_entity = telling.groupBy("entity").agg(F.collect_list("term").alias("terms"))
    wanted = stage(found.select("row", _entity()).distinct().join(by_entity, "entity").select("row", F.explode("terms").alias("term")).distinct(),
                   "pii-wanted")
    texts = base.select("row", "text").join(wanted.select("row").distinct(), "row")
    placed = _placed(texts.select("row", F.inline(_found(F.col("text"), "term", _term(p)))), ["row"])
    placed = placed.withColumn("term", F.lower("hit")).join(wanted, ["row", "term"]).select("row", F.lit("term").alias("kind"), "first", "end")
    # those inside a span of the patterns are generalised with it
    both = placed.union(found.join(wanted.select("row").distinct(), "row", "left_semi").select("row", "kind", "first", "end"))
    before = Window.partitionBy("row").orderBy("first", F.col("kind") == "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("kind") != "term", F.col("end"))).over(before)
    return both.withColumn("covered", covered).where("kind = 'term' and (covered is null or end > covered)").drop("covered")


def personal_data(docs: DataFrame, p: Pii = Pii()) -> DataFrame:
    """Counts and spans of every document."""
    base = _base(docs)
    found = stage(entities(base), "pii-entities")
    extra = occurrences(base, found, stage(telling_terms(docs, base, found, p), "pii-telling"), p)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("order")
    spans = found.select("row", "kind", "first", "end").union(extra).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct(order, "first", "end", "kind"))).alias("all"))
    named = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")
    out = base.select("row", "doc_id").join(spans, "row", "left")
    out = out.withColumn("all", F.coalesce("all", F.array().cast("array<struct<order:bigint,first:bigint,end:bigint,kind:string>>")))

    def count(kind: str) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return out.select("doc_id", *[count(k) for k in PATTERNS], F.sha2(named(F.filter("all", lambda s: s["kind"] != "term")), 256).alias("base_sha256"),
                      named(F.col("all")).alias("spans"), count("term"))


def sanitised(docs: DataFrame, p: Pii = Pii()) -> DataFrame:
    """``doc_id, text`` with entities generalised to their kind and telling terms removed. Where spans overlap, the one
    that begins first is replaced and the rest of the others is removed. Rows that share an id and a text are one row."""
    spans = personal_data(docs, p).select("doc_id", "spans").where("doc_id is not null").distinct()
    parts = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.struct(
        F.split(s, ":")[1].cast("int").alias("first"), F.split(s, ":")[2].cast("int").alias("end"), F.split(s, ":")[0].alias("kind")))
    text = F.coalesce("text", F.lit(""))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        keep = F.substring(F.col("t"), state["at"] + 1, F.greatest(F.lit(0), s["first"] - state["at"]))
        name = F.when((s["kind"] == "term") | (s["first"] < state["at"]), "").otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        return F.struct(F.concat(state["done"], keep, name).alias("done"), F.greatest(state["at"], s["end"]).alias("at"))

    rows = docs.select("doc_id", text.alias("t")).distinct().join(spans, "doc_id")
    end = F.aggregate(F.sort_array(parts), start, step)
    rows = rows.withColumn("state", end)
    return rows.select("doc_id", F.concat("state.done", F.expr("substring(t, state.at + 1)")).alias("text"))
