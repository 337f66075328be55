"""Queries of the filtering operators: quality (4), benchmark passages (10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm.common import table
from starload.llm.decontamination import leaks
from starload.llm.quality import fit, score
from starload.llm.registry import query


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


_LOWER_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_SHINGLES = "SELECT r, p, array_to_string(list_slice(ws, p + 1, p + 5), ' ') AS k FROM (SELECT r, ws, unnest(range(0, len(ws) - 4)) AS p FROM {})"

#: For items of five words and more: places where a shingle is shared, and two words to either side, compared in full.
_OP10_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_LOWER_WORDS} AS ws FROM documents),
i AS (SELECT item_id, row_number() OVER () AS r, {_LOWER_WORDS} AS ws FROM benchmark),
ds AS ({_SHINGLES.format("d")}), iq AS ({_SHINGLES.format("i")}),
item AS (SELECT r, k, sum(strlen(k) - 4) AS w FROM iq GROUP BY r, k),
place AS (SELECT DISTINCT ds.r AS r, iq.r AS q, ds.p - iq.p + unnest([-2, -1, 0, 1, 2]) AS begin_at FROM ds JOIN iq USING (k)),
span AS (SELECT DISTINCT place.r, q, greatest(begin_at, 0) AS a, least(begin_at + len(i.ws), len(d.ws)) AS b FROM place JOIN i ON q = i.r JOIN d ON place.r = d.r),
text AS (SELECT span.r, q, a, b, k, sum(strlen(k) - 4) AS w FROM span JOIN ds ON span.r = ds.r AND p BETWEEN a AND b - 5 GROUP BY ALL),
same AS (SELECT text.r, q, a, b, sum(least(text.w, item.w)) AS w FROM text JOIN item ON q = item.r AND text.k = item.k GROUP BY ALL),
size AS (SELECT r, q, a, b, sum(w) AS w FROM text GROUP BY ALL),
likeness AS (SELECT same.r, same.q, same.a, CAST(same.w AS DOUBLE) / (size.w + (SELECT sum(w) FROM item WHERE item.r = same.q) - same.w) AS similarity
             FROM same JOIN size USING (r, q, a, b))
SELECT doc_id, item_id, similarity, CAST(a AS BIGINT) AS start, CAST(least(len(i.ws), len(d.ws) - a) AS BIGINT) AS n_words
FROM (SELECT *, row_number() OVER (PARTITION BY r, q ORDER BY similarity DESC, a) AS n FROM likeness WHERE similarity >= 0.8) l
JOIN d ON l.r = d.r JOIN i ON q = i.r WHERE n = 1"""


@query("op10_decontamination", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
