"""The conversation prefix trie (13) as a query, and its SQL: every prefix as a list, nodes by grouping, subtrees along owners' paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm.common import table
from starload.llm.prefix_trie import prefix_trie
from starload.llm.registry import query

#: CRC-32 of a decimal number, bit by bit: a byte comes in, then eight steps (-1).
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
    lambda x: list_concat([CAST(ord(x) AS BIGINT)], list_transform(range(8), lambda y: CAST(-1 AS BIGINT)))))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END))"""

_OP13_SQL = rf"""
WITH o AS (SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, turns, CAST({_CRC} % 4 AS BIGINT) AS h FROM o),
r AS (SELECT h.c, list_concat(list_slice(coalesce(o.turns, []), 1, h), list_slice(h.turns, h + 1, len(h.turns))) AS turns FROM h LEFT JOIN o ON o.c = h.c - h.c % 20),
p AS (SELECT c, d, sha256(CAST(to_json(turns[1:d]) AS VARCHAR)) AS node, len(turns) = d AS ends,
             CASE WHEN d = 0 THEN 0 ELSE len(list_filter(regexp_split_to_array(turns[d].text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS words
      FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ids FROM p GROUP BY node, d),
up AS (SELECT n.node, q.node AS parent FROM n JOIN p q ON q.c = n.conv_id AND q.d = n.d - 1),
k AS (SELECT parent AS node, count(*) AS n_children FROM up GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
s AS (SELECT q.node, count(*) FILTER (m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.words) AS saved FROM m JOIN p q ON q.c = m.conv_id AND q.d <= m.d GROUP BY q.node)
SELECT m.conv_id, m.d AS depth, a.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(m.ids) AS ends_sha256
FROM m JOIN s USING (node) LEFT JOIN up USING (node) LEFT JOIN n a ON a.node = up.parent"""


@query("op13_prefix_trie", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("x1", "x2")
