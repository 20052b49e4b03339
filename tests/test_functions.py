from pyspark.sql import functions as F

from driftlog.functions.json import is_json_object, to_json_doc
from driftlog.functions.text import highlight, matches_any, query_tokens, tokens
from driftlog.functions.url import decode_args, query_string


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first().o


def test_highlight_whole_tokens_any_case_unicode(spark):
    text = "Red, RED redder; ÉCOLE école x-red red2 red"
    out = _one(spark, highlight(F.col("v"), ["red", "école"]), text)
    assert out == ("<em>Red</em>, <em>RED</em> redder; <em>ÉCOLE</em> <em>école</em> "
                   "x-<em>red</em> red2 <em>red</em>")


def test_match_is_token_based(spark):
    assert _one(spark, matches_any(F.col("v"), ["red"]), "Redemption") is False
    assert _one(spark, matches_any(F.col("v"), ["red"]), "a RED car") is True
    assert _one(spark, matches_any(F.col("v"), ["red"]), None) is False
    assert _one(spark, matches_any(F.col("v"), []), "red") is False


def test_tokens(spark):
    assert _one(spark, tokens(F.col("v")), "Hello, wörld 42!") == ["hello", "wörld", "42"]


def test_query_tokens_unicode_and_dupes():
    assert query_tokens("École  école, 2024") == ["école", "2024"]


def test_query_string_and_decode(spark):
    assert _one(spark, query_string(F.col("v")), "https://a.example.com/p?x=1&y=a+b#frag") == "x=1&y=a+b"
    assert _one(spark, query_string(F.col("v")), "https://a.example.com/p") is None
    assert _one(spark, decode_args(F.col("v")), "params=%7B%22a%22%3A%22b+c%22%7D") == '{"a":"b c"}'
    assert _one(spark, decode_args(F.col("v")), "params=%zz") is None


def test_is_json_object_null_and_empty(spark):
    assert _one(spark, is_json_object(F.col("v")), None) is False
    assert _one(spark, is_json_object(F.col("v")), "") is False
    assert _one(spark, is_json_object(F.col("v")), "{}") is True


def test_to_json_doc(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(to_json_doc().alias("j")).first().j == '{"a":1,"b":null}'
    assert df.select(to_json_doc(["a"], keep_nulls=False).alias("j")).first().j == '{"a":1}'


def test_kafka_records_without_connector_says_so(spark):
    import pytest
    from driftlog.sources.kafka import kafka_records

    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka_records(spark, "broker.example.com:9092", "logs")
