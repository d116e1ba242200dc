"""The operators as named queries over whole tables, and the same answers as SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casemill.llm.decontaminate import overlaps
from casemill.llm.mixing import mixing_rates
from casemill.llm.near_dup import near_duplicates
from casemill.llm.pii import personal_data
from casemill.llm.quality import COUNTS, quality
from casemill.llm.queries_mining import ORACLE as MINING_ORACLE, QUERIES as MINING_QUERIES
from casemill.llm.secrets import secret_scan
from casemill.llm.substrings import remove_repeats
from casemill.llm.suffixes import remove_earlier
from casemill.llm.token_shards import token_shards
from casemill.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {**MINING_QUERIES}
ORACLE: dict[str, str] = {**MINING_ORACLE}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier(table(spark, sf_dir, "documents"))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = quality(table(spark, sf_dir, "documents"))
    return verdict.select("doc_id", *COUNTS, "base_failed", "kept", "boilerplate_words")


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


WORD_LISTS = r"""
docs AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
"""

ORACLE["op7_quality_lines"] = rf"""
WITH {WORD_LISTS},
lines AS (SELECT doc_id, coalesce(source, '') AS host, text, unnest(string_split(text, chr(10))) AS raw FROM docs),
normal AS (SELECT doc_id, host, text, raw,
    len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS words,
    array_to_string(regexp_extract_all(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[^\x20\x09-\x0D]+'), ' ') AS line
    FROM lines WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
again AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n_dup_lines FROM normal GROUP BY doc_id),
texts AS (SELECT coalesce(source, '') AS host, count(DISTINCT text) AS texts FROM docs GROUP BY 1),
frequent AS (SELECT host, line FROM normal JOIN texts USING (host) GROUP BY host, line, texts
    HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.1 * texts),
gone AS (SELECT doc_id, sum(words) AS boilerplate_words FROM normal JOIN frequent USING (host, line) GROUP BY doc_id),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8)),
twice AS (SELECT doc_id, k FROM wins GROUP BY doc_id, k HAVING count(*) > 1),
cover AS (SELECT DISTINCT doc_id, i + o AS at FROM wins JOIN twice USING (doc_id, k), range(8) AS t(o)),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM cover GROUP BY doc_id),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(boilerplate_words, 0) AS BIGINT) AS boilerplate_words
    FROM docs LEFT JOIN again USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_words - boilerplate_words >= 0.3 * n_words AS kept FROM failed
"""

ORACLE["op3_substring_dedup"] = rf"""
WITH {WORD_LISTS},
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
twice AS (SELECT k FROM wins GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS pos FROM wins JOIN twice USING (k), range(35) AS t(o)),
words AS (SELECT doc_id, w[i] AS word, i AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

ORACLE["op10_near_dup"] = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM sets a JOIN sets b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reach JOIN links ON a = other)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""

ORACLE["op4_suffix_dedup"] = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
wins AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 100)) AS k, md5_number_lower(substr(h, 2 * i + 1, 100)) AS k2
    FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM docs WHERE n >= 50)),
least_ids AS (SELECT k, k2, min(doc_id) AS m FROM wins GROUP BY k, k2 HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS pos FROM wins JOIN least_ids USING (k, k2), range(50) AS t(o) WHERE m < doc_id),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE lag_pos IS NULL OR lag_pos < pos - 1) AS n_spans
    FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS lag_pos FROM gone) GROUP BY doc_id),
bytes AS (SELECT doc_id, i AS pos, substr(h, 2 * i + 1, 2) AS b
    FROM (SELECT doc_id, h, unnest(range(n)) AS i FROM docs JOIN runs USING (doc_id))),
kept AS (SELECT doc_id, string_agg(b, '' ORDER BY pos) AS h FROM bytes ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT docs.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(CASE WHEN n_removed IS NULL THEN docs.h ELSE coalesce(kept.h, '') END)) AS kept_sha256
FROM docs LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
