"""A training-corpus pipeline over ``documents``, of the operators in ``driftlog.llm``.

Stages, each a ``(spark, docs, sf_dir) -> DataFrame`` whose result is written
as Parquet and read again as the next one's ``docs``:

1. toxicity: documents scored 0.3 or more go;
2. quality rules: failed lines go from the text, and documents that the base rules fail or that lose too much go;
3. near duplicates (5-word shingles, similarity 0.8 or more): of each group one row stays, of the smallest id;
4. benchmark decontamination: documents that align with a test item go;
5. sampled segmentations: two a document, with their pieces.

All but the last return the columns of ``documents``; other columns of the
input pass through. Groups are of rows: rows that share an id but whose texts
are in different groups all stay, and rows without an id take part, coming
after all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.llm import decontaminate, jaccard, line_rules, sample_pieces, toxicity
from driftlog.llm.queries import table, tokenizer_path
from driftlog.llm.scratch import written
from driftlog.llm.ship import shipped

#: documents of an Arrow batch
BATCH_DOCUMENTS = 2000


def unused(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` has not."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def small_batches(spark: SparkSession) -> None:
    """Texts go to the workers in batches of a bounded number of documents: their memory follows the batch."""
    shipped(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_DOCUMENTS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity_score(model)(F.col("text")) < 0.3)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    verdict = line_rules.line_verdict(with_text=True).asNondeterministic()    # evaluated once a row
    name = unused("verdict", docs)
    judged = docs.select("*", verdict(F.col("text")).alias(name)).where(F.col(f"{name}.kept"))
    return judged.withColumns({"text": F.col(f"{name}.clean_text"),
                               "n_chars": F.length(f"{name}.clean_text").cast("bigint")}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    row = unused("row", docs)
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")     # ids may repeat or be missing
    groups = written(jaccard.similar_groups(rows, k=5, num=80, den=100, id_column=row), "groups")
    named = groups.select(row, F.col("component_id").alias("of")).join(rows.select(row, F.col("doc_id").alias("id")), row)
    first = named.groupBy("of").agg(F.min(F.struct(F.col("id").isNull(), "id", row)).alias("first")).select(f"first.{row}")
    return rows.join(first, row, "left_semi").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    blocks = decontaminate.indexed_blocks(docs, table(spark, sf_dir, "benchmark"))
    return docs.where(~decontaminate.contaminated(docs, blocks)(F.col("text")))


def sampled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return sample_pieces.sampled_pieces(docs, tokenizer_path("piece_bpe_32k.model"), k=2, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", clean_lines),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("sampled segmentations", sampled),
]

#: the scorer, the line hashes and the sampler are beyond SQL; tests/llm holds run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
