"""Parallelism for inputs that arrive in too few partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None, cut: bool = False) -> DataFrame:
    """Round-robin ``df`` over at least ``min_partitions`` tasks when it has fewer.

    A small table stored as one parquet row group is read by one task; the
    CPU-heavy JSON and text work after it would then use one core. When the
    input already has enough partitions (any large input: many files or
    row groups) this is a no-op and adds no shuffle. Default target: the
    cluster's default parallelism. Streaming frames are returned unchanged
    (their parallelism is the source's, e.g. Kafka ``minPartitions``).

    A file is cut by bytes, but a row group is read by one task: a table of
    few files may have enough partitions and most of them empty. With ``cut``
    a frame of fewer files than ``min_partitions`` is dealt in any case.
    """
    if df.isStreaming:
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a remote session): leave as is
        return df
    if current < target:
        return df.repartition(target)
    return df.repartition(current) if cut and len(df.inputFiles()) < target else df
