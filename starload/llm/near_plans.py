"""Queries of the duplicate operators: repeated passages (1), near copies (7), vectors (9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm.common import table
from starload.llm.near_dup import near_duplicates
from starload.llm.registry import query
from starload.llm.substring_dedup import remove_repeats
from starload.llm.vector_dup import near_vectors

#: Words are runs of bytes other than space and tab to carriage return.
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_OP1_SQL = f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS ws FROM documents),
word AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
win AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
mark AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n FROM word ANTI JOIN mark USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)"""

#: Components of a table ``link`` (a, b), given both ways, by the least id that a walk can reach.
_REACH = """reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

_ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP7_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("text", _ASCII_LOWER)} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')))
                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
pair AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common, any_value(p.n) AS m, any_value(q.n) AS n FROM e p JOIN e q USING (x) WHERE p.doc_id <> q.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair WHERE 100 * common >= 85 * (m + n - common)),
{_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low.b, doc_id)) AS component_id, doc_id <= coalesce(low.b, doc_id) AS kept
FROM s LEFT JOIN low ON doc_id = low.a"""

_OP9_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND list_cosine_similarity(p.e, q.e) >= 0.9),
{_REACH}
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
       vec_id <= coalesce(low.b, vec_id) AS kept
FROM v LEFT JOIN low ON vec_id = low.a"""


@query("op7_near_dup", _OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("text_hash", "group")


@query("op1_substring_dedup", _OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False).drop("text_hash", "removed")


@query("op9_vector_dup", _OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)
