from driftlog.functions.text import query_tokens
from driftlog.operators.search import search


SHIP = "id string, title string, crew array<struct<name: string>>, rating double"


def _ships(spark):
    rows = [
        ("1", "Harbour Red Tide", [("ada moss",), ("bo lind",)], 8.3),
        ("2", "Red Keel", [("cy hart",)], 7.9),
        ("3", "Harbour Delta", [("ada moss",)], 8.0),
        ("4", "Harbour: red-buoy", [("ada moss",)], None),
        ("5", "Redwing", [("ada moss",)], 9.7),
        ("6", "HARBOUR blue", [("ada moss",)], 8.0),
    ]
    return spark.createDataFrame(rows, SHIP)


def test_match_term_filter_sort_page_highlight(spark):
    """QRY-1: must-match + keyword filter in an array of structs + sort + page + highlight."""
    df = _ships(spark)
    out = search(df, "title", "red", filters={"crew.name": "ada moss"},
                 sort="rating", id_col="id", size=20, highlight=True,
                 highlight_col="title_hl").collect()
    # "Redwing" holds "red" only inside a word: no match; "2" fails the filter
    assert [r.id for r in out] == ["1", "4"]  # 8.3 first, null score last
    assert out[0].title_hl == "Harbour <em>Red</em> Tide"
    assert out[1].title_hl == "Harbour: <em>red</em>-buoy"


def test_any_token_matches_and_ties_break_on_id(spark):
    df = _ships(spark)
    out = search(df, "title", "harbour delta", sort="rating", id_col="id",
                 size=3, highlight=False).collect()
    assert [r.id for r in out] == ["1", "3", "6"]  # 8.3, then 8.0 tie -> id order


def test_offset_page(spark):
    df = _ships(spark)
    out = search(df, "title", "harbour", sort="rating", id_col="id", size=2, offset=1,
                 highlight=False).collect()
    assert [r.id for r in out] == ["3", "6"]


def test_plan_is_top_k_not_full_sort(spark):
    df = _ships(spark)
    res = search(df, "title", "red", sort="rating", id_col="id", size=20)
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_scalar_filter_pushed_to_parquet(spark, tmp_dir):
    _ships(spark).select("id", "title", "rating").write.parquet(f"{tmp_dir}/m")
    df = spark.read.parquet(f"{tmp_dir}/m")
    res = search(df, "title", "red", filters={"id": "1"}, sort="rating", id_col="id")
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,1)]" in plan
    assert [r.id for r in res.collect()] == ["1"]


def test_query_tokens():
    assert query_tokens("Red, red  SEA!") == ["red", "sea"]


def test_term_filters_run_before_the_text_match(spark, tmp_dir):
    """QRY-1: whole texts are scanned only where the cheap filters hold."""
    _ships(spark).select("id", "title", "rating").write.parquet(f"{tmp_dir}/f")
    res = search(spark.read.parquet(f"{tmp_dir}/f"), "title", "red", filters={"id": "1"}, sort="rating", id_col="id")
    line = next(x for x in res._jdf.queryExecution().executedPlan().toString().splitlines() if "RLIKE" in x)
    assert line.index("= 1") < line.index("RLIKE")
