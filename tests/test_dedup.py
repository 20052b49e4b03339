from pyspark.sql import functions as F

from driftlog.operators.dedup import daily_first_seen, latest_documents, pick_per_key

H = 3_600_000


def _ev(spark, rows):
    return spark.createDataFrame(rows, "mid string, ts long, seq long, ch string")


def test_first_per_day_and_across_midnight(spark):
    """One row per visitor and day; a visit across midnight counts twice."""
    day = 1704067200000  # 2024-01-01T00:00:00Z
    rows = [("a", day + 10 * H, 1, "x"), ("a", day + 2 * H, 2, "first"),
            ("a", day + 23 * H, 3, "y"), ("a", day + 25 * H, 4, "next-day"),
            ("b", day + 5 * H, 5, "b1")]
    out = daily_first_seen(_ev(spark, rows), "mid", "ts", tie_col="seq").collect()
    got = sorted((r.dt, r.mid, r.ch, r.hr) for r in out)
    assert got == [("2024-01-01", "a", "first", "02"), ("2024-01-01", "b", "b1", "05"),
                   ("2024-01-02", "a", "next-day", "01")]


def test_tie_on_time_broken_by_tie_column(spark):
    day = 1704067200000
    rows = [("a", day, 9, "later-seq"), ("a", day, 3, "earlier-seq")]
    [r] = daily_first_seen(_ev(spark, rows), "mid", "ts", tie_col="seq").collect()
    assert r.ch == "earlier-seq"


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A key holding most rows leaves every map task as one row (partial aggregate)."""
    day = 1704067200000
    hot = spark.range(0, 20000, numPartitions=4).select(
        F.lit("hot").alias("mid"), (F.lit(day) + F.col("id")).alias("ts"),
        F.col("id").alias("seq"), F.lit("c").alias("ch"))
    cold = spark.range(0, 100, numPartitions=2).select(
        F.col("id").cast("string").alias("mid"), F.lit(day).alias("ts"),
        F.col("id").alias("seq"), F.lit("c").alias("ch"))
    df = daily_first_seen(hot.unionByName(cold), "mid", "ts", tie_col="seq")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    rows = df.collect()
    assert len(rows) == 101
    assert [r.seq for r in rows if r.mid == "hot"] == [0]


def test_pick_per_key_keeps_columns_and_order(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (2, "c", 1)], "k int, v string, o int")
    out = pick_per_key(df, ["k"], ["o"], last=True)
    assert out.columns == ["k", "v", "o"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "b", 7), (2, "c", 1)]


def test_latest_documents_batch_then_offset(spark):
    docs = spark.createDataFrame(
        [("d1", 1, 10, "old"), ("d1", 2, 3, "new-batch"), ("d1", 2, 1, "same-batch-earlier"),
         ("d2", 1, 5, "only")],
        "doc_id string, batch_id long, offset long, body string")
    out = {r.doc_id: r.body for r in latest_documents(docs, "doc_id").collect()}
    assert out == {"d1": "new-batch", "d2": "only"}
