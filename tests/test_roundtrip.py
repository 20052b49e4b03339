"""Round trip: table rows -> bus records -> decode gives the rows back."""

import datetime as dt
import random

from pyspark.sql import functions as F

from driftlog.operators.project import decode_fact
from driftlog.sources.records import records_from_events

ALPHABET = list("abcXYZ 019%+=&?#\"'\\/{}[]:,\n\t") + ["é", "ß", "中", "😀", "params=", "%zz",
                                                       "%20", "+", " "]


def _text(rng):
    if rng.random() < 0.05:
        return None
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30)))


def test_random_rows_round_trip(spark):
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(microseconds=rng.randint(0, 10**12)), rng.randint(0, 99),
             _text(rng), round(rng.uniform(0, 500), 2), _text(rng)) for i in range(400)]
    ev = spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    fact = decode_fact(records_from_events(ev))
    got = {int(r.oid): (r.en, r.et, r.gs, r.uid) for r in fact.collect()}
    want = {r[0]: (r[3], r[3], r[5], str(r[2])) for r in rows}
    assert got == want


def test_timestamps_round_trip_to_the_microsecond(spark):
    ev = spark.sql("""
      SELECT 1L AS event_id, TIMESTAMP_NTZ'2024-01-02 03:04:05.000006' AS ts, 5L AS user_id,
             'x' AS event_type, 1.0D AS value, '{}' AS props""")
    [r] = decode_fact(records_from_events(ev)).select(
        "timestamp", F.to_timestamp("timestamp").alias("t")).collect()
    assert r.timestamp == "2024-01-02T03:04:05.000006+00:00"
