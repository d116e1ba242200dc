"""Periodic runs, collocations and exact search as named queries, and the same answers as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill.functions.arrays import let
from casemill.llm.collocations import collocations
from casemill.llm.runs import periodic_runs
from casemill.llm.topk import top_k

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """One document in ten, by the CRC-32 of its number, repeats a stretch of its words to its end."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        word = lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")).otherwise(text)

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, let(words, repeated)).otherwise(text)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text")))
    rank = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(rank)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), (-best["l"]).alias("length"),
        best["period"].alias("period"), F.floor(1000 * -best["l"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


ORACLE["op12_periodic_runs"] = r"""
WITH crc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, y: CASE WHEN y >= 0 THEN xor(c, y) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h FROM documents),
parts AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a,
    1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p FROM crc),
words AS MATERIALIZED (SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM parts)),
equal AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y USING (doc_id, word)
    WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isles AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM equal),
periodic AS MATERIALIZED (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM isles GROUP BY doc_id, q, isle
    HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT * FROM periodic r WHERE NOT EXISTS (SELECT 1 FROM periodic o
    WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.s <= r.s AND o.s + o.len >= r.s + r.len)),
longest AS (SELECT doc_id, count(*) AS n_runs, min((-len, s, q)) AS best,
    string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[2] AS start, -best[1] AS length, best[3] AS period,
    CAST(1000 * -best[1] // best[3] AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(coalesce(kept.text, '')) AS collapsed_sha256, n AS n_words
FROM parts LEFT JOIN longest USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op13_top_k"] = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_collocations"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang),
grams AS (SELECT lang, k, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM lists, range(1, 5) AS t(k) WHERE len(w) >= k)),
counts AS MATERIALIZED (SELECT lang, k, g, array_to_string(g, ' ') AS phrase, count(*) AS a FROM grams GROUP BY lang, k, g HAVING count(*) >= 30),
cuts AS (SELECT c.lang, c.g, c.phrase, c.a, l.a AS l, r.a AS r, j,
    CAST(2000000 * CAST(c.a AS HUGEINT) // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM counts WHERE k > 1) c
    JOIN counts l ON l.lang = c.lang AND l.g = c.g[1:j] JOIN counts r ON r.lang = c.lang AND r.g = c.g[j + 1:]),
best AS (SELECT lang, g, any_value(phrase) AS phrase, any_value(a) AS a, min((score, j)) AS least FROM cuts GROUP BY lang, g),
inner_parts AS (SELECT lang, a AS longer, unnest(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2),
    lambda i: g[i:i + m - 1]))) AS parts FROM counts WHERE k > 2),
inside AS (SELECT lang, unnest(parts) AS g, longer FROM inner_parts),
swallowed AS (SELECT DISTINCT lang, g FROM inside JOIN counts USING (lang, g) WHERE 100 * CAST(longer AS HUGEINT) >= 80 * CAST(a AS HUGEINT)),
ranked AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.least[1] DESC, b.a DESC, encode(b.phrase)) AS rank,
    b.phrase, b.a, c.l, c.r, b.least[1] AS score FROM best b JOIN cuts c ON c.lang = b.lang AND c.g = b.g AND c.j = b.least[2]
    ANTI JOIN swallowed s ON s.lang = b.lang AND s.g = b.g)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
