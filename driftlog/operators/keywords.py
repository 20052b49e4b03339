"""A document store whose keyword filters skip data.

``write_keyword_store`` promotes keyword fields when documents are written:

* ``documents``: the rows, by ``cluster`` (a hash of the id) and sorted by the
  scalar keywords, with Parquet bloom filters on those. A term filter on a
  scalar keyword is a pushed equality: row groups whose filter or range
  excludes the term are skipped.
* ``postings``: for each keyword inside an array of objects a row per distinct
  (term, document), sorted by term, with bloom filters. A term filter reads
  the postings of its term and joins the documents on cluster and id: the
  clusters found prune the documents' folders while the query runs (dynamic
  partition pruning), where an ``exists`` over the array would read them all.

A term that very many documents share makes many postings; they are spread
over the clusters, and the join is a plain one that Spark may split.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

_TERM = "_term"
CLUSTER = "cluster"


def _array_fields(df: DataFrame, fields: list[str]) -> list[str]:
    """Those of ``fields`` that name a field inside an array of objects."""
    out = []
    for field in fields:
        head, _, rest = field.partition(".")
        if rest and isinstance(df.schema[head].dataType, T.ArrayType):
            out.append(field)
    return out


def write_keyword_store(docs: DataFrame, path: str, id_col: str, keywords: list[str], clusters: int = 64,
                        block_bytes: int | None = None) -> None:
    """Write documents with their keyword fields promoted (``head.name``: field of an array of objects).

    ``clusters``: folders of documents; size it so that one holds a few files.
    ``block_bytes``: row-group size, Parquet's default unless given.
    """
    arrays = _array_fields(docs, keywords)
    scalars = [k for k in keywords if k not in arrays]
    dotted = [k for k in scalars if "." in k]
    if dotted:
        raise ValueError(f"keywords are plain columns or fields of arrays of objects: {dotted}")
    placed = docs.withColumn(CLUSTER, F.pmod(F.xxhash64(id_col), F.lit(clusters)).cast("int"))
    order = [CLUSTER, *scalars, id_col]
    writer = placed.repartition(CLUSTER).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(CLUSTER)
    for column in [*scalars, id_col]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(f"{path}/documents")
    for field in arrays:
        head, _, name = field.partition(".")
        terms = F.array_distinct(F.transform(F.col(head), lambda e: e[name]))
        post = placed.select(F.explode(terms).alias(_TERM), CLUSTER, F.col(id_col).alias("id")).where(f"{_TERM} is not null")
        writer = (post.repartitionByRange(_TERM, CLUSTER, "id").sortWithinPartitions(_TERM, CLUSTER, "id").write
                  .mode("overwrite").option(f"parquet.bloom.filter.enabled#{_TERM}", "true"))
        if block_bytes:
            writer = writer.option("parquet.block.size", block_bytes)
        writer.parquet(f"{path}/postings/{field}")


def read_keyword_store(spark: SparkSession, path: str, schema: T.StructType, id_col: str,
                       filters: dict[str, Any] | None = None) -> DataFrame:
    """Documents that meet every term filter; ``schema`` is that of the documents written."""
    docs = spark.read.schema(T.StructType([*schema.fields, T.StructField(CLUSTER, T.IntegerType())])) \
        .parquet(f"{path}/documents")
    filters = filters or {}
    arrays = _array_fields(docs, list(filters))
    docs = reduce(lambda d, k: d.where(F.col(k) == F.lit(filters[k])), [k for k in filters if k not in arrays], docs)
    for field in arrays:
        id_type = schema[id_col].dataType.simpleString()
        posts = (spark.read.schema(f"{_TERM} string, {CLUSTER} int, id {id_type}").parquet(f"{path}/postings/{field}")
                 .where(F.col(_TERM) == F.lit(filters[field])).select(F.col(CLUSTER).alias("_cluster"), F.col("id").alias("_id")))
        docs = docs.join(posts, (docs[CLUSTER] == posts["_cluster"]) & (docs[id_col] == posts["_id"]), "left_semi")
    return docs.select(*[f.name for f in schema.fields])
