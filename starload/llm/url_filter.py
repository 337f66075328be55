"""URL filtering: fixed host and path rules, and association rules mined by FP-growth from labelled URLs. JVM only.

A URL becomes tokens (host labels and their words, path segments, query keys). FP-growth over labelled URLs gives token
combinations; those that imply the bad label with ``MIN_SUPPORT`` and ``MIN_CONFIDENCE``, and on ``LEAST`` bad URLs at least, are
rules, unless some of their tokens alone are one. A rule stands in an inverted index under its rarest token; a URL looks its
tokens up and is blocked if it has all tokens of a rule found there. URLs are judged once per distinct URL, so a very frequent
one costs one look-up.

Combinations grow with two to the power of the tokens that go together, so the mining is given less to combine, by rules that
hold at every size: tokens on fewer than ``LEAST`` bad URLs can be in no rule and go; of tokens that are on just the same
URLs one stands for all. What is left is combined whole. If some URL has more than ``TOKENS`` tokens left, FP-growth, which lists
every frequent combination, could list too many; the same rules are then found size by size (``_by_size``): a combination that
is a rule, or is on just the URLs of a smaller one, is not grown further, for what it grows into is no least rule.

Defined results: a null url, or one without ``://``, has an empty host and path and is allowed unless a rule says else;
repeated rows and null ids keep their rows; with fewer than ``LEAST`` bad URLs nothing is mined; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepare, staged

#: (verdict, host, path)
Rule = tuple[str, str, str]
#: Share of all labelled URLs that have the tokens and the label; share of those with the tokens that have the label.
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
#: Fewest bad URLs that a rule rests on, and the most tokens of a labelled URL with which FP-growth lists all combinations.
LEAST, TOKENS = 20, 12
BAD = "label=bad"


def host_and_path(url: str = "url") -> tuple[F.Column, F.Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(rules: list[Rule]) -> F.Column:
    """struct(rule, verdict) of the longest rule that fits columns host and path; null without one. Of equally long ones the least text."""
    fits = [
        F.when(((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path), F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule: string, verdict: string>")


def tokens() -> F.Column:
    """Distinct tokens of columns url, host and path; numbers in the path are one token."""
    labels = F.split(F.regexp_replace("host", ":[0-9]*$", ""), r"\.")
    words = F.array_except(F.split("host", "[^a-z0-9]+"), labels)  # parts of a label that is not one word
    segments = F.transform(F.split("path", "/"), lambda s: F.concat(F.lit("path="), F.regexp_replace(s, "[0-9]+", "#")))
    query = F.split(F.regexp_extract("url", r"\?([^#]*)", 1), "&")
    keyed = lambda name, array: F.transform(F.filter(array, lambda x: x != ""), lambda x: F.concat(F.lit(name + "="), x))
    return F.array_distinct(F.concat(keyed("host", labels), keyed("word", words), F.filter(segments, lambda s: s != "path="), keyed("query", query)))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, least: int = LEAST) -> DataFrame:
    """(antecedent, key, confidence, support) of the rules ``tokens -> bad``. ``labelled``: (url, bad boolean)."""
    host, path = host_and_path()
    rows = labelled.where("url is not null and bad is not null").select("url", host.alias("host"), path.alias("path"), "bad")
    urls = staged(rows.select(F.monotonically_increasing_id().alias("row"), "bad", tokens().alias("tokens")), "labelled-urls")
    n = urls.count()
    needed = max(least, min_support * n)
    if urls.where("bad").count() < needed:
        return labelled.sparkSession.createDataFrame([], "antecedent array<string>, key string, confidence double, support double")
    told, single = _telling(urls, needed)
    widest = told.groupBy("row").count().agg(F.max("count").alias("w")).first().w
    if (widest or 0) > TOKENS:
        rules = _by_size(told, n, needed, min_confidence)
    else:
        model = FPGrowth(itemsCol="items", minSupport=needed / n, minConfidence=min_confidence).fit(_transactions(urls, told))
        rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select("antecedent", "confidence", "support")
    each = rules.withColumn("key", F.explode("antecedent")).join(single, "key")
    keyed = each.groupBy("antecedent").agg(F.min(F.struct("freq", "key")).alias("rarest"), F.max("confidence").alias("confidence"), F.max("support").alias("support"))
    found = staged(keyed.select("antecedent", F.col("rarest.key").alias("key"), "confidence", "support"), "url-rules-found")
    return staged(_least_of(found), "url-rules")


def _telling(urls: DataFrame, needed: float) -> tuple[DataFrame, DataFrame]:
    """(row, bad, token) of the tokens that may be in a rule, one for those on just the same URLs; and (key, freq) of each."""
    each = urls.select("row", "bad", F.explode("tokens").alias("token"))
    on = [F.bit_xor(F.xxhash64("row")), F.bit_xor(F.xxhash64(F.lit("row"), "row"))]
    counts = each.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("n_bad"), *[x.alias(f"on{i}") for i, x in enumerate(on)])
    one = counts.where(F.col("n_bad") >= needed).groupBy("n", "n_bad", "on0", "on1").agg(F.min("token").alias("token"))
    one = staged(one, "telling-tokens")
    return staged(each.join(one.select("token"), "token"), "told"), one.select(F.col("token").alias("key"), F.col("n").alias("freq"))


def _transactions(urls: DataFrame, told: DataFrame) -> DataFrame:
    """Items of each labelled URL: its telling tokens, and the label if it is bad. URLs without either count too."""
    has = told.groupBy("row").agg(F.collect_list("token").alias("has"))
    nothing = F.array().cast("array<string>")
    # items are sorted, so that the mined rules do not depend on the order in which rows are met
    items = F.array_sort(F.concat(F.coalesce("has", nothing), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(nothing)))
    return staged(urls.drop("tokens").join(has, "row", "left").select(items.alias("items")), "transactions")


def _by_size(told: DataFrame, n: int, needed: float, min_confidence: float) -> DataFrame:
    """(antecedent, confidence, support) of the least rules. Each size is counted over the URLs that hold a combination one smaller which
    is frequent among bad ones, no rule, and on fewer URLs than its parts; all parts of a larger one must be such."""
    rows = told.groupBy("row", "bad").agg(F.sort_array(F.collect_list("token")).alias("items"))
    alike = rows.groupBy("items").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("n_bad"))
    grown = alike.select("items", "n", "n_bad", F.explode("items").alias("token")).withColumn("antecedent", F.array("token")).drop("token")
    rules, live, size = None, None, 1
    while True:
        grown = staged(grown, "grown")
        counts = grown.groupBy("antecedent").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad")).where(F.col("n_bad") >= needed)
        if live is not None:
            part = F.explode(F.transform("antecedent", lambda x: F.array_remove("antecedent", x)))
            parts = counts.select("antecedent", "n", "n_bad", part.alias("part")).join(live.select(F.col("antecedent").alias("part"), F.col("n").alias("n_part")), "part")
            counts = parts.where("n < n_part").groupBy("antecedent", "n", "n_bad").agg(F.count("*").alias("parts")).where(F.col("parts") == size).drop("parts")
        counts = staged(counts.withColumn("confidence", F.col("n_bad") / F.col("n")), "combinations")
        here = counts.where(F.col("confidence") >= min_confidence).select("antecedent", "confidence", (F.col("n_bad") / F.lit(n)).alias("support"))
        rules = here if rules is None else rules.unionByName(here)
        live = counts.where(F.col("confidence") < min_confidence)
        if live.isEmpty():
            return rules
        more = F.explode(F.filter("items", lambda x: x > F.element_at("antecedent", -1)))
        held = grown.join(live.select("antecedent"), "antecedent").select("items", "n", "n_bad", "antecedent", more.alias("token"))
        grown = held.select("items", "n", "n_bad", F.concat("antecedent", F.array("token")).alias("antecedent"))
        size += 1


def _least_of(rules: DataFrame) -> DataFrame:
    """Rules of whose tokens no part is a rule: such a part blocks all that the rule does. Parts are found by their rarest token."""
    parts = rules.select("key", F.col("antecedent").alias("part"))
    met = rules.select("antecedent", F.explode("antecedent").alias("key")).join(parts, "key")
    covered = met.where((F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0)).select("antecedent")
    return rules.join(covered, "antecedent", "left_anti")


def judge(pages: DataFrame, rules: list[Rule], mined: DataFrame) -> DataFrame:
    """One row per page: id, host, path, the fixed rule that decides (or null) and the verdict."""
    prepare(pages.sparkSession)
    host, path = host_and_path()
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    urls = rows.where("url is not null").groupBy("url").agg(F.first("host").alias("host"), F.first("path").alias("path")).select("url", tokens().alias("tokens"))
    looked = urls.select("url", "tokens", F.explode("tokens").alias("key")).join(mined.select("key", "antecedent"), "key")
    bad = looked.where(F.size(F.array_except("antecedent", "tokens")) == 0).select("url").distinct().withColumn("bad", F.lit(True))
    judged = rows.withColumn("fixed", longest_rule(rules)).join(bad, "url", "left")
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"))
