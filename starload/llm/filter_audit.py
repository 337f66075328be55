"""Filter interaction audit: which of five filters fail each document, and what each order of the filters would remove.

1. A scan gives every row its failures of A to D as bits, and a hash of its text. No text leaves the scan.
2. E is an existential self-join: a row fails it if there is a row with the same hash and exactly the same text under a
   smaller ``doc_id``. Asked of a text's least ``doc_id`` it is the same question, so the other side is pre-aggregated to
   one row per text, however many copies there are, and rows meet it in a left-semi join.
3. The ids that fail E are united with the rows' other failures, and the bits are combined per id, text and part.
4. Documents, good and toxic ones are counted per part and combination of bits. These are 32 combinations a part at
   most; all 120 orders are read off them. An order's step removes the combinations that hold its filter and none of
   the filters before it. Of the 120 orders, a combination of k filters meets each of them first in 120 / k.

Defined results: a null text is empty; rows repeated under one id count as rows of their own and do not fail E because
of one another; a null ``doc_id`` is smaller than none, fails no E and has no label; an id with several label rows is
good (toxic) if one of them says so; a part without documents has no rows, and neither has an empty table; other
columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepare, staged

FILTERS = "ABCDE"
#: Fixed values of the filters: least words, least distinct words and most capitals in a hundred, characters of markup.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKUP = 200, 50, 3, "[#$%&*|]"
_BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
_SPACE = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> Column:
    """A to D as bits. Arrays of words live inside the expression only."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = {
        "A": n < LEAST_WORDS,
        "B": 100 * distinct < LEAST_DISTINCT * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(text),
        "D": text.rlike(MARKUP),
    }
    return sum((F.when(f, _BIT[name]).otherwise(0) for name, f in fails.items()), F.lit(0))


def failed_filters(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``failed`` (bits of A to E) and ``rows`` (how many such rows there are)."""
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("hash"))
    own = staged(rows.select("doc_id", "part", "hash", failures(F.col("text")).alias("failed")), "failures")
    copies = copies_of_smaller_ids(rows, own).groupBy("doc_id", "part", "hash").agg(F.lit(_BIT["E"]).alias("failed"), F.lit(0).alias("rows"))
    united = own.select("doc_id", "part", "hash", "failed", F.lit(1).alias("rows")).unionByName(copies)
    return united.groupBy("doc_id", "part", "hash").agg(F.bit_or("failed").alias("failed"), F.sum("rows").alias("rows")).drop("hash")


def copies_of_smaller_ids(rows: DataFrame, own: DataFrame) -> DataFrame:
    """E: ``rows`` whose text some smaller ``doc_id`` has too. ``own`` holds their ids and hashes without texts.

    Only rows whose hash is met under several ids bring their texts along, once; what is grouped or joined on a text is
    a table of its own, so that a text with very many copies is combined before its shuffle and split in the join.
    """
    met = staged(own.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("hash"), "met-again")
    found = staged(rows.join(met, "hash", "left_semi"), "same-hash")
    least = staged(found.groupBy("hash", "text").agg(F.min("doc_id").alias("least")), "least-ids")
    d, e = found.alias("d"), least.alias("e")
    return d.join(e, (F.col("d.hash") == F.col("e.hash")) & (F.col("d.text") == F.col("e.text")) & (F.col("e.least") < F.col("d.doc_id")), "left_semi")


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones per part and combination of failures."""
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"), F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")
    )
    known = failed.join(marked, "doc_id", "left")
    count = lambda flag: F.sum(F.col("rows") * F.coalesce(F.col(flag), F.lit(0))).alias(flag)
    return known.groupBy("part", "failed").agg(F.sum("rows").alias("docs"), count("good"), count("toxic"))


def orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step. Every combination of a part goes to all steps of all orders: 19,200 rows a part at most."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            steps.append(F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(step).alias("step"), F.lit(before).alias("before"), F.lit(_BIT[name]).alias("this")))
            before |= _BIT[name]
    each = counts.withColumn("share", F.floor(F.lit(120) / F.greatest(F.bit_count("failed"), F.lit(1))))
    each = each.select("*", F.inline(F.array(*steps)))
    fails, earlier = F.col("failed").bitwiseAND(F.col("this")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0
    total = lambda when, what, name: F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long").alias(name)
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier, "docs", "kept"),
        total(fails & ~earlier, "docs", "removed"),
        total(fails & earlier, "docs", "redundant"),
        total(F.col("failed") == F.col("this"), "docs", "unique_fails"),
        total(fails & ~earlier, "good", "good_lost"),
        total(fails & ~earlier, "toxic", "toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.col("docs") * F.col("share"))), F.lit(0)).cast("long").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return orders(staged(combinations(failed_filters(docs), labels), "combinations"))
