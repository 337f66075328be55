"""The filter interaction audit (11) as a query, and its SQL: each document against each order, without combinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm.common import table
from starload.llm.filter_audit import audit
from starload.llm.registry import query

_OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
f AS (SELECT doc_id, part,
             [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
              100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text),
              regexp_matches(text, '[#$%&*|]'),
              coalesce(EXISTS (SELECT 1 FROM d AS e WHERE e.text = w.text AND e.doc_id < w.doc_id), false)] AS fails FROM w),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT f.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM f LEFT JOIN l USING (doc_id)),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM o),
e AS (SELECT part, o, step, o[step] AS this, fails, good, toxic, fails[o[step]] AS hit,
             len(list_filter(o[1:step - 1], lambda i: fails[i])) > 0 AS gone FROM (SELECT part, fails, good, toxic FROM m), s),
t AS (SELECT part, o, step, any_value(this) AS this, count(*) FILTER (NOT hit AND NOT gone) AS kept, count(*) FILTER (hit AND NOT gone) AS removed,
             count(*) FILTER (hit AND gone) AS redundant, count(*) FILTER (hit AND len(list_filter(fails, lambda y: y)) = 1) AS unique_fails,
             count(*) FILTER (hit AND NOT gone AND good) AS good_lost, count(*) FILTER (hit AND NOT gone AND toxic) AS toxic_lost
      FROM e GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant,
       unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, this) AS BIGINT) AS shapley FROM t"""


@query("op11_filter_audit", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
