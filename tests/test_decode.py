import json

import pytest
from pyspark.errors import PySparkException

from driftlog import schemas as S
from driftlog.operators.decode import decode_records, quarantined, split_valid
from driftlog.operators.project import decode_fact, project_fact
from helpers import PAYLOAD, args_of, envelope, line, records_df


def _fact(spark, values, **kw):
    return [r.asDict() for r in decode_fact(records_df(spark, values), keep=("offset",), **kw)
            .orderBy("offset").collect()]


def _reasons(spark, values):
    dec = decode_records(records_df(spark, values))
    return [r.reason for r in dec.select("offset", "reason").orderBy("offset").collect()]


def test_full_record_all_columns(spark):
    """Every fact column filled from the right place; dropped d.* fields absent."""
    [row] = _fact(spark, [envelope(line(args_of(PAYLOAD)))])
    assert list(row)[1:] == S.FACT_COLUMNS
    for k in S.PAYLOAD_TOP_FIELDS:
        assert row[k] == PAYLOAD[k]
    for k in S.PAYLOAD_D_FIELDS:
        assert row[k] == PAYLOAD["d"][k]
    assert row["timestamp"] == "2020-07-18T09:58:30+08:00"
    assert row["ref"] == ""  # empty stays empty


def test_percent20_and_plus_decode_to_space(spark):
    """E2, E3."""
    a = "params=" + json.dumps({"b": "x y", "d": {}}).replace(" ", "%20")
    b = args_of({"b": "x y", "d": {}})
    assert "+" in b
    rows = _fact(spark, [envelope(line(a)), envelope(line(b))])
    assert [r["b"] for r in rows] == ["x y", "x y"]


def test_missing_d_gives_null_d_columns(spark):
    """Permissive mode keeps the record, the eight d columns are null."""
    p = {k: v for k, v in PAYLOAD.items() if k != "d"}
    [row] = _fact(spark, [envelope(line(args_of(p)))])
    assert row["b"] == "shop"
    assert all(row[k] is None for k in S.PAYLOAD_D_FIELDS)


def test_reasons(spark):
    """Each broken level gets its reason, in check order."""
    values = [
        envelope(line(args_of(PAYLOAD))),           # good
        envelope(line("params=%zz")),               # E5 bad escape
        envelope(line(None)),                       # E6 no args
        "not json", '{"a":1', "", None,             # E7
        '{"x":1}',                                  # E8 no message
        envelope(line("params=notjson")),           # payload text not JSON
        json.dumps({"message": "{'a': 1}"}),        # message not strict JSON
    ]
    assert _reasons(spark, values) == [
        None, "bad_payload", "missing_args",
        "bad_envelope", "bad_envelope", "bad_envelope", "bad_envelope",
        "bad_message", "bad_payload", "bad_message"]


def test_valid_plus_quarantine_is_input(spark):
    values = [envelope(line(args_of(PAYLOAD))), "junk", envelope(line(None)), None]
    dec = decode_records(records_df(spark, values)).cache()
    good_n = project_fact(dec).count()
    bad = quarantined(dec, keep=["offset", "value", "reason"]).collect()
    assert good_n + len(bad) == len(values)
    assert sorted(r.offset for r in bad) == [1, 2, 3]


def test_non_string_values_become_text(spark):
    """numbers/booleans/objects as text, 1.50 -> 1.5, JSON null -> null."""
    p = '{"b": 7, "s": true, "en": {"q": 1}, "et": 1.50, "cu": null, "d": {"oid": 12}}'
    from urllib.parse import quote_plus
    [row] = _fact(spark, [envelope(line("params=" + quote_plus(p)))])
    assert (row["b"], row["s"], row["en"], row["et"], row["cu"], row["oid"]) == \
        ("7", "true", '{"q":1}', "1.5", None, "12")


def test_duplicate_key_keeps_last(spark):
    """E12."""
    from urllib.parse import quote_plus
    p = '{"b": "first", "b": "last", "d": {}}'
    [row] = _fact(spark, [envelope(line("params=" + quote_plus(p)))])
    assert row["b"] == "last"


def test_trailing_content_and_single_quotes_rejected(spark):
    """The strict check rejects what a plain parse would accept."""
    good = envelope(line(args_of(PAYLOAD)))
    values = [good + " trailing}", good + "," + good, "{'a':1}", "{a:1}", "[1]",
              '{"a":1,}']
    assert _reasons(spark, values) == ["bad_envelope"] * len(values)


def test_message_as_object_decodes_like_text(spark):
    """E15."""
    ln = line(args_of(PAYLOAD))
    rows = _fact(spark, [envelope(ln, as_text=True), envelope(ln, as_text=False)])
    a, b = ({k: v for k, v in r.items() if k != "offset"} for r in rows)
    assert a == b


def test_every_params_prefix_removed(spark):
    """replaceAll semantics, before decoding."""
    # a tracker that leaves '=' unencoded: the literal text is stripped too
    args = 'params=params={"b":"aparams=b","d":{"oid":"1"}}'
    [row] = _fact(spark, [envelope(line(args))])
    assert (row["b"], row["oid"]) == ("ab", "1")


def test_failfast_raises_on_bad_record(spark):
    df = records_df(spark, [envelope(line(args_of(PAYLOAD))), "junk"])
    with pytest.raises(PySparkException):
        decode_fact(df, mode="failfast").collect()


def test_failfast_raises_on_missing_d(spark):
    p = {k: v for k, v in PAYLOAD.items() if k != "d"}
    with pytest.raises(PySparkException):
        decode_fact(records_df(spark, [envelope(line(args_of(p)))]), mode="failfast").collect()


def test_failfast_passes_good_records(spark):
    rows = decode_fact(records_df(spark, [envelope(line(args_of(PAYLOAD)))]), mode="failfast").collect()
    assert len(rows) == 1


def test_split_valid_table(spark):
    """FLT-1 on the survey's edge rows, plus texts closing the array count early."""
    cases = [('{"a":1}', True), ('{"a":1} trailing}', False), ('{"a":1},{"b":2}', False),
             ("{'a':1}", False), ("[1]", False), ("{a:1}", False), ('{"a":1,}', False),
             ('{"a":1', False), ("", False), (None, False), ('{"a":"1","a":"2"}', True),
             ("{} ] [ {}", False), ("{},{}] {}", False), ("{} ] ] {}", False),
             ('{"a":"x]"} ]{}', False), ('{"a":[1,2],"b":"]"}', True), ('{"a":{"b":[{}]}}', True)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id int, t string")
    valid, bad = split_valid(df, "t")
    got_valid = {r.id for r in valid.collect()}
    got_bad = {r.id for r in bad.collect()}
    assert got_valid == {i for i, (_, ok) in enumerate(cases) if ok}
    assert got_bad == {i for i, (_, ok) in enumerate(cases) if not ok}
    assert {r.reason for r in bad.collect()} == {"not_json_object"}


def test_decode_is_one_stage_without_shuffle(spark):
    df = decode_fact(records_df(spark, [envelope(line(args_of(PAYLOAD)))]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # each JSON level parsed once; a payload whose d is text (only such a row) twice, and its d
    assert plan.count("from_json(") == 5


def test_decode_prunes_envelope_schema(spark):
    """Only `message` of the envelope is parsed into a column."""
    df = decode_fact(records_df(spark, [envelope(line(args_of(PAYLOAD)))]))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "@metadata" not in plan


def test_visitor_events_from_object_or_text_message(spark):
    from driftlog.operators.decode import decode_visitor_events

    ev = {"ts": 1595037510000, "common": {"mid": "m1", "uid": "u1", "ar": "a", "ch": "c",
                                          "vc": "1.0"}}
    values = [json.dumps({"message": ev}), json.dumps({"message": json.dumps(ev)}),
              json.dumps({"message": "not an object"}), "{broken", json.dumps({"other": 1})]
    out = decode_visitor_events(records_df(spark, values), keep=["offset"]).collect()
    assert [r.offset for r in out] == [0, 1]
    assert all(r.ts == 1595037510000 and r.common.mid == "m1" and r.common.vc == "1.0" for r in out)


def test_only_wanted_fields_are_parsed(spark):
    """A projection names its fact columns; the payload parse holds these alone."""
    recs = records_df(spark, [envelope(line(args_of(PAYLOAD)))])
    df = decode_fact(recs, columns=["oid", "b"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(oid" in plan and "StructField(cu" not in plan and "StructField(chl" not in plan
    [row] = df.collect()
    [whole] = decode_fact(recs).collect()
    assert row.asDict() == {"oid": whole.oid, "b": whole.b}
    assert decode_fact(recs, keep=["offset"], columns=[]).count() == 1


def test_nested_object_as_text_decodes_like_an_object(spark):
    """``d`` may come as the text of an object; other text leaves the payload malformed."""
    as_text = dict(PAYLOAD, d=json.dumps(PAYLOAD["d"]))
    a, b = (_fact(spark, [envelope(line(args_of(p)))])[0] for p in (PAYLOAD, as_text))
    assert a == b
    bad = [envelope(line(args_of(dict(PAYLOAD, d=d)))) for d in ("no object", "[1]", "{broken", '{"oid": 1} x')]
    assert _reasons(spark, bad) == ["bad_payload"] * 4
    none = _fact(spark, [envelope(line(args_of(dict(PAYLOAD, d=None))))])[0]
    assert none["oid"] is None and none["b"] == a["b"]


def test_visitor_reasons(spark):
    from driftlog.operators.decode import decode_visitor_events, decode_visitors

    common = {"mid": "m", "uid": "u"}
    messages = [{"ts": 1, "common": common}, {"common": common}, {"ts": 1}, {"ts": 1, "common": {"uid": "u"}}]
    recs = records_df(spark, [json.dumps({"message": m}) for m in messages] + [None])
    got = [r.reason for r in decode_visitors(recs).orderBy("offset").collect()]
    assert got == [None, "missing_ts", "missing_mid", "missing_mid", "bad_envelope"]
    assert decode_visitor_events(recs).count() == 1
