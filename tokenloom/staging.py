"""Tables that cut lineage: written once to the cluster's shared checkpoint folder, then read back.

A written table outlives any executor, so a lost node costs a re-read and not a recomputation of the
whole plan, and later jobs all see the same rows in the same layout. The application owns what it stages:
its paths are removed when it ends, and `discard` removes one as soon as nothing reads it any more.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the warehouse, which a cluster shares as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


# Paths made inside the `scratch` blocks that a thread has open, innermost last.
_blocks = threading.local()


def _open() -> list[list[str]]:
    if not hasattr(_blocks, "paths"):
        _blocks.paths = []
    return _blocks.paths


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block when it ends, for steps whose result doesn't read it."""
    _open().append([])
    try:
        yield
    finally:
        for path in _open().pop():
            discard(spark, path)


def _on_store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used, removed with the application."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder, store = _on_store(spark, path)
    store.deleteOnExit(folder)
    if _open():
        _open()[-1].append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    folder, store = _on_store(spark, path)
    store.delete(folder, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One file, in whatever store Spark reaches at ``path``; its folder is made, an old file is replaced."""
    file, store = _on_store(spark, path)
    out = store.create(file, True)
    try:
        out.write(data)
    finally:
        out.close()


def stage(
    df: DataFrame, name: str, path: str | None = None, partition_by: tuple[str, ...] = (), compression: str | None = None
) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the written table."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    schema = df.schema
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(schema).parquet(path)
