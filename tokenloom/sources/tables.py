"""Reading document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a table that has fewer scan tasks than the cluster has cores.

    Text work is bound by CPU, and a small file of one row group would keep a single core busy. Tables
    with enough tasks, anything large, are left as they are: there the shuffle would only cost.
    ``keys`` identify a row, so that rows spread evenly and land in the same place on a retry.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def read_documents(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    return spread(spark.read.parquet(path), *keys)
