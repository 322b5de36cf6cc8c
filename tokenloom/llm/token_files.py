"""Token ids as Parquet files with list columns.

Layout under a path: ``tokens`` holds one row per document, in ascending order of its id over all files:
``doc_id, part, part_start, n_tokens, ids``. Ids are dictionary-encoded (delta-packed where a dictionary
grows too large), row groups and pages are small and have page indexes, so that a reader can fetch the
counts without the ids, or the ids of a few documents without the rest. ``parts`` says for each written
part how many ids lie in the parts before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.byte_bpe import encoded_rows, id_lists
from tokenloom.llm.common import col, text_of, text_slices

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 512
_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def _encoded(ranks: str, vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for rows, ids, offsets in encoded_rows(batches, text_slices, ranks, vocabulary, end_id):
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(np.full(len(offsets) - 1, part, np.int32)),
                    pa.array(offsets[:-1] + before),
                    pa.array(np.diff(offsets)),
                    id_lists(ids, offsets),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            before += int(offsets[-1])

    return run


def write_tokens(
    docs: DataFrame, path: str, ranks: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every whole text, append ``end_id``, and write the files in ascending order of ``id_col`` (long).

    The text is moved once, to its place in the order. A null or empty text has the end id alone, null ids
    come first, rows with equal ids stand in either order, and an empty table gives empty files. Other
    columns are not written.
    """
    picked = docs.select(col(docs, id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    ordered = picked.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    (
        ordered.mapInArrow(_encoded(ranks, vocabulary, end_id), _SCHEMA)
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("compression", "zstd")
        .parquet(f"{path}/tokens")
    )
    spark = docs.sparkSession
    sizes = token_rows(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written part
    sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).coalesce(1).write.parquet(f"{path}/parts")


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{path}/tokens")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; columns that a query leaves out are not read."""
    parts = spark.read.schema("part int, before long").parquet(f"{path}/parts")
    rows = token_rows(spark, path).join(parts, "part")
    return rows.select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        at = batch.schema.get_field_index("ids")
        yield batch.set_column(at, "ids_crc32", pa.array(sums, pa.int64()))


def with_crc32(rows: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers."""
    schema = ", ".join("ids_crc32 long" if c == "ids" else f"`{c}` {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(_checksums, schema)
