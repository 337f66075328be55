import datetime as dt

from pyspark.sql import functions as F

from starload.functions import text
from starload.functions.nested import map_all_strings
from starload.functions.parse import lenient_timestamp, strict_timestamp, to_int_guarded


def _one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first().o


def test_strip_matches_python(spark):
    s = " \t Ana Gil 　\n"
    assert _one(spark, text.strip_ws("v"), s) == s.strip()


def test_sanitize_order(spark):
    s = " \x07<script type='x'>alert(1)</script>Hi JavaScript:go VBSCRIPT:x "
    assert _one(spark, text.sanitize_text("v"), s) == "Hi go x"
    long = "a" * 9990 + "<script>x</script>"
    # the cap comes first, so a script block cut by it stays
    assert _one(spark, text.sanitize_text("v"), long).endswith("<script>x<")


def test_shorten_hash_patterns_format(spark):
    assert _one(spark, text.shorten("v"), "x" * 101) == "x" * 100 + "..."
    assert _one(spark, text.shorten("v"), "x" * 100) == "x" * 100
    assert _one(spark, text.hash_column("v"), "k") == "8254c329a92850f6d539dd376f4816ee2764517da5e0235514af433164480d7a"
    assert _one(spark, text.matches_any("v"), "Mozilla Googlebot/2.1") is True
    assert _one(spark, text.matches_any("v"), "Mozilla/5.0") is False
    assert _one(spark, text.format_error(F.lit("ValueError"), F.col("v"), F.lit("load")), "bad") == "[load] ValueError: bad"
    assert _one(spark, text.severity("v"), "VALIDATION_ERROR") == "ERROR"
    assert _one(spark, text.severity("v"), "UNKNOWN_TABLE") == "WARNING"


def test_json_record_cleans(spark):
    df = spark.createDataFrame([(float("nan"), dt.datetime(2024, 1, 2, 3, 4, 5))], "x double, ts timestamp_ntz")
    out = df.select(text.nan_to_null(F.col("x")).alias("x"), "ts").select(text.json_record("x", "ts").alias("j")).first().j
    assert out == '{"x":null,"ts":"2024-01-02T03:04:05.000000"}'


def test_parsers(spark):
    assert _one(spark, to_int_guarded("v"), "1.9") == 1
    assert _one(spark, to_int_guarded("v"), "12d") is None
    assert _one(spark, to_int_guarded("v"), "3000000000") is None
    assert _one(spark, lenient_timestamp("v"), "2021-11-07T02:48:42Z") == dt.datetime(2021, 11, 7, 2, 48, 42)
    assert _one(spark, strict_timestamp("v"), "2021-11-07T02:48:42Z") is None
    assert _one(spark, strict_timestamp("v"), "2021-2-30 00:00:00") is None
    assert _one(spark, strict_timestamp("v"), "2021-2-3 4:05:06") == dt.datetime(2021, 2, 3, 4, 5, 6)


def test_nested_sanitise(spark):
    df = spark.createDataFrame([(("  a<script>x</script>", ["  b "]), {" k ": " v "})], "s struct<x:string,y:array<string>>, m map<string,string>")
    r = map_all_strings(df, text.sanitize_text).first()
    assert r.s.x == "a" and r.s.y == ["b"] and r.m == {" k ": "v"}
