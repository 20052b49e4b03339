"""Reading the parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; the scan is pruned and filtered by whatever the caller selects."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_if_present(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is no such path; any other failure raises."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
