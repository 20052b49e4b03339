"""TOP-2 by keyset, SRC-7/8 splits found in the database, SNK-4 replays dropped."""

import random

import pytest
from pyspark.sql import functions as F

from driftlog import schemas as S
from driftlog.operators.search import page_key, search
from driftlog.sources.jdbc import split_predicates
from driftlog.sources.kafka import HEADERS, drop_replays, header_columns, kafka_frame, kafka_options
from driftlog.streaming.sinks import publish_batch


# --- TOP-2 ---

@pytest.mark.parametrize("sort,descending", [("n", True), ("n", False), (None, True), ("x", True), ("x", False)])
def test_pages_in_a_row_are_the_whole_order(spark, sort, descending):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1, 2, 2, 3, 50]), rng.choice([None, 0.5, float("nan"), -1.0]), "tok") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, n int, x double, text string").repartition(3)
    whole = search(df, "text", "tok", sort=sort, descending=descending, id_col="id", size=1000, highlight=False).collect()
    got, after = [], None
    while True:
        page = search(df, "text", "tok", sort=sort, descending=descending, id_col="id", size=7, highlight=False, after=after)
        rows = page.collect()
        if not rows:
            break
        got += rows
        after = page_key(page, sort, "id", descending)
    assert [r.id for r in got] == [r.id for r in whole] and len(got) == 60
    assert page_key(page, sort, "id", descending) is None


def test_the_range_of_a_page_reaches_the_scan(spark, tmp_dir):
    spark.createDataFrame([(1, 5, "a")], "id int, n int, text string").write.parquet(tmp_dir + "/d")
    page = search(spark.read.parquet(tmp_dir + "/d"), "text", "a", sort="n", id_col="id", after=(7, 3), highlight=False)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(n,7)" in plan and "TakeOrderedAndProject" in plan
    with pytest.raises(ValueError):
        search(page, "text", "a", id_col="id", after=(1, 1), offset=3)
    with pytest.raises(ValueError):
        search(page, "text", "a", after=(1, 1))


# --- SRC-7, SRC-8 ---

def _split(spark, rows, parts, **options):
    spark.createDataFrame(rows, "k bigint, other bigint").createOrReplaceTempView("split_source")
    asked = []

    def run(sql):
        found = spark.sql(sql).collect()
        asked.append(len(found))
        return found

    predicates = split_predicates(run, "SELECT * FROM split_source WHERE other >= -1000 OR other IS NULL", "k", parts, **options)
    df = spark.table("split_source")
    hits = df.select(sum(F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in predicates).alias("n")).collect()
    assert all(r.n == 1 for r in hits)          # each row in exactly one read
    return [df.where(p).count() for p in predicates], asked


def test_uneven_column_is_dealt_evenly(spark):
    rng = random.Random(4)
    keys = [int(rng.paretovariate(0.4)) for _ in range(3000)] + [-rng.randrange(10 ** 12) for _ in range(300)]
    counts, asked = _split(spark, [(k, i) for i, k in enumerate(keys)], 20)
    ones = sum(k == 1 for k in keys)
    assert max(c for c in counts if c < ones) <= 2.3 * len(keys) / 20 and len(counts) <= 40
    assert max(asked) <= 256


def test_a_hot_value_is_dealt_by_a_second_column(spark):
    rows = [(5, i) for i in range(1000)] + [(i, -i) for i in range(1000)] + [(5, None), (None, 3), (None, None)]
    counts, _ = _split(spark, rows, 10, second="other")
    assert max(counts) <= 2.3 * len(rows) / 10
    counts, _ = _split(spark, rows, 10)
    assert max(counts) >= 1000       # one value stays one read without it


def test_small_and_empty_sources(spark):
    assert _split(spark, [(None, 1)], 4)[0] == [1]
    assert _split(spark, [(7, 1)], 4)[0] == [1]
    assert _split(spark, [(1, 1), (10 ** 18, 1), (-10 ** 18, 1)], 4)[0] == [1, 1, 1]
    empty = spark.createDataFrame([], "k bigint")
    empty.createOrReplaceTempView("split_empty")
    assert split_predicates(lambda q: spark.sql(q).collect(), "SELECT k FROM split_empty", "k", 3) == ["1 = 1"]
    with pytest.raises(ValueError):
        split_predicates(lambda q: [], "x", "k", 0)


# --- SNK-4 ---

def _topic(frames):
    """Written frames as the topic's records, in order."""
    out = None
    for n, frame in enumerate(frames):
        part = frame.withColumns({"topic": F.lit("t"), "partition": F.lit(n), "offset": F.monotonically_increasing_id()})
        out = part if out is None else out.unionByName(part)
    return out


def _rows(spark, offsets):
    return spark.createDataFrame([("src", 2, o, f"v{o}") for o in offsets], "topic string, partition int, offset long, v string")


def test_frames_carry_their_position(spark):
    frame = kafka_frame(_rows(spark, [4]), ["v"], "v", run=3, batch_id=9)
    [r] = header_columns(frame).collect()
    assert tuple(r) == ("v4", '{"v":"v4"}', 3, 9, "src", 2, 4)
    assert kafka_frame(_rows(spark, [4]), ["v"]).columns == ["key", "value"]
    assert kafka_options("h", "t", headers=True)["includeHeaders"] == "true" and "includeHeaders" not in kafka_options("h", "t")


def test_a_batch_written_twice_is_read_once(spark):
    first, again = (kafka_frame(_rows(spark, [1, 2, 3]), ["v"], run=1, batch_id=0) for _ in range(2))
    other_batch = kafka_frame(_rows(spark, [4]), ["v"], run=1, batch_id=1)
    other_run = kafka_frame(_rows(spark, [1]), ["v"], run=2, batch_id=0)
    foreign = first.withColumn("headers", F.filter("headers", lambda h: h["key"] != "run"))
    got = drop_replays(_topic([first, again, other_batch, other_run, foreign, foreign]))
    ours = got.where("run is not null")
    assert sorted((r.run, r.batch_id, r.source_offset, r.partition) for r in ours.collect()) == \
        [(1, 0, 1, 0), (1, 0, 2, 0), (1, 0, 3, 0), (1, 1, 4, 2), (2, 0, 1, 3)]
    assert got.where("run is null").count() == 6         # of writers without headers nothing is dropped
    assert set(HEADERS) <= set(got.columns)


def test_replays_on_a_stream(spark, tmp_dir):
    frame = kafka_frame(_rows(spark, [1, 2, 3]), ["v"], run=1, batch_id=0)
    topic = _topic([frame, frame]).withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000)))
    topic.write.parquet(f"{tmp_dir}/topic")
    stream = spark.readStream.schema(topic.schema).parquet(f"{tmp_dir}/topic")
    with pytest.raises(ValueError):
        drop_replays(stream)
    (drop_replays(stream, ("timestamp", "1 hour")).writeStream.format("parquet").option("path", f"{tmp_dir}/out")
     .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start().awaitTermination())
    assert sorted(r.source_offset for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == [1, 2, 3]


def test_published_batches(spark, monkeypatch):
    """``publish_batch`` hands the connector key, value and headers, without the source position in the value."""
    from pyspark.sql import readwriter

    sent = []
    monkeypatch.setattr(readwriter.DataFrameWriter, "save", lambda self, *a, **k: sent.append(self._df))
    for _ in range(2):
        publish_batch(_rows(spark, [1, 2]), 5, "h:9092", "out", run=4, fmt="noop")
    assert sent[0].columns == ["key", "value", "headers"]
    assert sorted(r.value for r in sent[0].collect()) == ['{"v":"v1"}', '{"v":"v2"}']
    assert drop_replays(_topic(sent)).count() == 2
