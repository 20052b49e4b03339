import json

from pyspark.sql import functions as F

from driftlog import schemas as S
from driftlog.operators.project import (decode_fact, project_doc, project_visitor, rows_to_json,
                                        with_doc_id, with_event_day)
from helpers import PAYLOAD, args_of, envelope, line, records_df


def test_project_doc_order(spark):
    fact = decode_fact(records_df(spark, [envelope(line(args_of(PAYLOAD)))]))
    doc = project_doc(fact)
    assert doc.columns == S.DOC6_COLUMNS
    [r] = doc.collect()
    assert r.oid == "o1" and r.catId == "cat1" and r.en == "fav"


def test_doc_id_from_position_is_deterministic(spark):
    df = records_df(spark, [envelope(line(args_of(PAYLOAD)))] * 2)
    ids = [r.doc_id for r in with_doc_id(df).orderBy("offset").collect()]
    assert ids == ["t-0-0", "t-0-1"]
    again = [r.doc_id for r in with_doc_id(df).orderBy("offset").collect()]
    assert ids == again


def test_doc_id_falls_back_to_value_hash(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "value string")
    ids = [r.doc_id for r in with_doc_id(df).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64


def test_event_day_from_millis_in_utc_and_other_zone(spark):
    # 2020-07-18T01:58:30Z = 1595037510000 ms
    df = spark.createDataFrame([(1595037510000,), (1595111999999,)], "ts long")
    utc = [(r.dt, r.hr) for r in with_event_day(df).collect()]
    assert utc == [("2020-07-18", "01"), ("2020-07-18", "22")]
    sh = [(r.dt, r.hr) for r in with_event_day(df, tz="Asia/Shanghai").collect()]
    assert sh == [("2020-07-18", "09"), ("2020-07-19", "06")]


def test_event_day_ignores_session_zone(spark):
    df = spark.createDataFrame([(1595037510000,)], "ts long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        [r] = with_event_day(df).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.dt, r.hr) == ("2020-07-18", "01")


def test_event_day_from_timestamp_columns(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 23:30:00' AS w")
    [r] = with_event_day(df, "w", millis=False).collect()
    assert (r.dt, r.hr) == ("2024-01-01", "23")
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 23:30:00+00:00' AS i")
    [r] = with_event_day(df, "i", tz="Asia/Shanghai", millis=False).collect()
    assert (r.dt, r.hr) == ("2024-01-02", "07")


def test_project_visitor(spark):
    ev = spark.createDataFrame(
        [(1595037510000, ("m1", "u1", "ar1", "ch1", "v1"))],
        S.VISITOR_EVENT)
    [r] = project_visitor(with_event_day(ev)).collect()
    assert list(r.asDict()) == S.VISITOR_COLUMNS
    assert tuple(r) == ("m1", "u1", "ar1", "ch1", "v1", "2020-07-18", "01", "00", 1595037510000)


def test_rows_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "a", None, 2.5)], "k long, s string, n string, x double")
    [r] = rows_to_json(df, key_cols=("k",)).collect()
    assert r.k == 1
    assert json.loads(r.json) == {"k": 1, "s": "a", "n": None, "x": 2.5}
    [r] = rows_to_json(df, keep_nulls=False).collect()
    assert json.loads(r.json) == {"k": 1, "s": "a", "x": 2.5}


def test_rows_to_json_is_narrow(spark, tmp_dir):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    plan = rows_to_json(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
