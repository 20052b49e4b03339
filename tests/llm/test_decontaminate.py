import random

from driftlog.llm.decontaminate import contaminated, contaminated_pairs, indexed_blocks
from pyspark.sql import functions as F

from .conftest import EDGE, words


def clean(text):
    return [w for w in (x.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for x in words((text or "").lower())) if w]


def smith_waterman(a, b, penalty=0.5):
    """Best local alignment of two word lists, cell by cell."""
    row, best = [0.0] * (len(b) + 1), 0.0
    for x in a:
        new = [0.0]
        for j, y in enumerate(b):
            new.append(max(0.0, row[j] + (1.0 if x == y else -penalty), row[j + 1] - penalty, new[j] - penalty))
        row = new
        best = max(best, *row)
    return best / len(a)


def made(spark, n=40, seed=3):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 3000}"
    items = [(i, " ".join(word() for _ in range(rng.choice([8, 25, 60])))) for i in range(n)]
    docs, truth = [], {}
    for d in range(300):
        text = [word() for _ in range(rng.choice([0, 30, 400]))]
        if d % 3 == 0:
            i, t = items[d // 3 % n]
            t = t.split()
            for _ in range(rng.randrange(0, max(1, len(t) // 5))):
                j = rng.randrange(len(t))
                t[j:j + 1] = rng.choice([[], [word()], [t[j], word()]])
            at = rng.randrange(len(text) + 1)
            text[at:at] = [x.upper() if rng.random() < 0.1 else x + rng.choice(["", "", ","]) for x in t]
            truth[d] = i
        docs.append((d, " ".join(text)))
    return docs, items, truth


def test_edited_copies_are_found_with_the_score_of_brute_force(spark):
    docs, items, truth = made(spark)
    got = {(r.doc_id, r.item_id): r.score for r in contaminated_pairs(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    by_doc, by_item = {d: clean(t) for d, t in docs}, {i: clean(t) for i, t in items}
    for pair, score in got.items():
        assert 0.5 <= score <= smith_waterman(by_item[pair[1]], by_doc[pair[0]]) + 1e-9
    full = {(d, i): smith_waterman(by_item[i], by_doc[d]) for d, i in truth.items()}
    assert all(p in got for p, s in full.items() if s >= 0.6)
    assert all(abs(got[p] - s) < 1e-9 for p, s in full.items() if p in got and s > 0.7)


def test_every_pair_that_brute_force_scores_half_or_more_is_found(spark):
    rng = random.Random(5)
    common = lambda: f"w{int(rng.paretovariate(0.7)) % 3000}"
    items = [(i, " ".join(common() if rng.random() < 0.4 else f"i{i}x{j}" for j in range(n)))
             for i, n in enumerate([36, 36, 20, 59, 41, 9, 4, 30, 25, 33])]
    edits = [lambda j, w: [w] if j % 4 else [f"n{j}"],                # every fourth word replaced
             lambda j, w: [w] if j % 3 != 2 else [f"n{j}"],           # every third
             lambda j, w: [w, f"n{j}"] if j % 2 else [w],             # a word put in after every second
             lambda j, w: [w, f"n{j}"],                               # after every one
             lambda j, w: [w] if j % 5 else [],                       # every fifth left out
             lambda j, w: [w]]
    docs = []
    for _, t in items:
        for edit in edits:
            noise = [[common() for _ in range(rng.randrange(60))] for _ in range(2)]
            docs.append((len(docs), " ".join(noise[0] + [x for j, w in enumerate(t.split()) for x in edit(j, w)] + noise[1])))
    got = {(r.doc_id, r.item_id): r.score for r in contaminated_pairs(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    full = {(d, i): smith_waterman(clean(t), clean(x)) for d, x in docs for i, t in items}
    want = {p: s for p, s in full.items() if s >= 0.5}
    assert len(want) >= 50 and set(got) == set(want) and all(abs(got[p] - s) < 1e-9 for p, s in want.items())


def test_blocks_change_nothing(spark):
    docs, items, _ = made(spark, seed=4)
    docs, items = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    pairs = lambda **x: sorted((r.doc_id, r.item_id, r.score) for r in contaminated_pairs(docs, items, **x).collect())
    assert len(indexed_blocks(docs, items, block_words=500)) > 3
    assert pairs() == pairs(block_words=500)


def test_a_leak_in_every_document_is_found(spark):
    item = " ".join(f"leak{i}" for i in range(30))
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("some "), "id", F.lit(f" {item} end")).alias("text"))
    items = spark.createDataFrame([(1, item), (2, "quite other words that are never seen")], "item_id bigint, text string")
    got = contaminated_pairs(docs, items).collect()
    assert len(got) == 500 and all(r.item_id == 1 and r.score == 1 for r in got)


def test_passages_of_the_given_benchmark(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in contaminated_pairs(docs, items).collect()}
    texts = {r.doc_id: " ".join(clean(r.text)) for r in docs.collect()}
    whole = {(d, r.item_id) for r in items.collect() for d, t in texts.items() if f" {' '.join(clean(r.text))} " in f" {t} "}
    assert whole and whole <= got and len(got - whole) < 0.2 * len(whole) + 1


def test_edge_rows(spark, edge, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "the dog sat on the log"), (4, "the dog sat on the log"),
                                   (None, "the dog sat on the log"), (5, "two words")], "item_id bigint, text string")
    got = sorted((str(r.doc_id), str(r.item_id)) for r in contaminated_pairs(edge, items).collect())
    want = [(str(i), j) for i, t in EDGE for j in ("4", "None") if t and "sat on the log" in t]
    assert got == sorted(want + [("5", "3"), ("6", "5")])
    assert contaminated_pairs(none, items).collect() == []
    assert contaminated_pairs(edge, items.limit(0)).collect() == []
    flags = edge.select("doc_id", contaminated(edge, indexed_blocks(edge, items))(F.col("text")).alias("f")).collect()
    assert {r.doc_id for r in flags if r.f} == {1, 10, 5, 6}
