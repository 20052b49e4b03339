"""The operators as catalog queries: ``(spark, sf_dir) -> DataFrame`` over whole tables, and their DuckDB SQL.

Operators without SQL are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.llm import (
    decontaminate,
    hard_negatives,
    jaccard,
    kd_shards,
    licences,
    line_rules,
    periodic_runs,
    sample_pieces,
    suffix_tree,
    super_kmers,
    token_counts,
    toxicity,
    warc_zip,
)
from driftlog.llm.ship import shipped


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, folds: int, one: int) -> Column:
    """Whether crc32 of the id as text falls into one of some folds (a null id: never)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == one, F.lit(False))


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = suffix_tree.score_documents(docs, ~fold("doc_id", 5, 1))
    return scored.select("doc_id", fold("doc_id", 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op2_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_documents(docs, labels, training=~fold("id", 4, 2), threshold=0.3)
    return scored.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op4_similar_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge_lines(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "n_lines", "n_removed_lines", "removed_words")


def op7_sample_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces.sampled_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), k=2)


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.archive_and_read(spark, table(spark, sf_dir, "pages"))
    return records.select(F.col("record_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=1024)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _planted_runs(docs: DataFrame) -> Column:
    """The text, for a tenth of the ids with a period planted: from word ``a`` on, the words repeat ``p`` of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def plant(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        whole = F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), (n - a).cast("int")))
        return F.when(n > 0, F.array_join(whole, " ")).otherwise("")

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    planted = F.transform(F.array(words), plant)[0]      # the words are split once and named
    return F.when(h % 10 == 0, planted).otherwise(F.col("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs, text=_planted_runs(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"),
                                                              (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256)
        .alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")


def op12_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = super_kmers.without_repeats(table(spark, sf_dir, "documents"), size=20)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_tree, op2_licence_rules, op3_toxicity, op4_similar_groups, op5_kd_shards, op6_line_rules,
        op7_sample_pieces, op8_warc_zip, op9_token_counts, op10_decontaminate, op11_periodic_runs,
        op12_super_kmers, op13_hard_negatives)}

SQL: dict[str, str] = {
    "op2_licence_rules": licences.licence_sql(),
    "op8_warc_zip": """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h, encode(coalesce(html, '')) AS b FROM pages),
    k AS (SELECT page_id, octet_length(b) AS n, sha1(h) AS d,
        max(page_id) OVER (PARTITION BY h) AS keeper, count(*) OVER (PARTITION BY h) AS same FROM p),
    r AS (SELECT *, n >= 1000 AND same > 1 AND page_id IS DISTINCT FROM keeper AS again FROM k)
    SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
      CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN again THEN keeper END AS refers_to
    FROM r""",
    "op13_hard_negatives": """
    WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other, a.label = o.label AS same,
        list_inner_product(a.v, o.v)::BIGINT AS score
      FROM r a JOIN r o ON a.vec_id % 50 = 0 AND a.vec_id <> o.vec_id),
    p AS (SELECT * FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT p.anchor_id, p.other AS positive_id,
      row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other)::INTEGER AS rank,
      n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
      AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
    QUALIFY rank <= 3""",
}
