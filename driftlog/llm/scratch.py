"""Tables written to the shared folder, to cut lineage.

The folder is the session's ``spark.checkpoint.dir``; it lies on storage
that every executor and the driver reach. Every call uses a new sub-folder,
so a retried or repeated query never meets another one's files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from driftlog.session import checkpoint_root


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a Parquet table in the shared folder, read back."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
