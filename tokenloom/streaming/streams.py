"""Structured Streaming forms of cleaning, encoding and packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tokenloom.config import CleaningConfig
from tokenloom.operators.cleaning import clean_lines
from tokenloom.operators.encoding import encode_documents
from tokenloom.operators.packing import append_eos, pack_ids
from tokenloom.operators.vocabulary import Tokenizer
from tokenloom.sources.lines import ORDER, file_lines, number_file_lines
from tokenloom.staging import discard, scratch

BLOCK_SCHEMA = "shard int, block long, input_ids array<int>, n int"


def stream_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    files_per_trigger: int | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Parquet files of documents as they arrive.

    ``spread_by`` names the row key to repartition on, for files of so few row groups that reading them
    would keep few cores busy. ``spark.sql.shuffle.partitions`` says into how many parts, as for any other shuffle: one part
    per core would grow with the input.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    docs = reader.parquet(path)
    return docs.repartition(F.col(spread_by)) if spread_by else docs


FILE_SCHEMA = "file string, doc_id long, lines long"


def stream_text(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as they arrive: ``file, block, text``. :func:`numbered` gives them numbers."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return file_lines(reader.text(path))


def numbered(path: str, then: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
    """A preparation of micro-batches of :func:`stream_text`: number the lines, then do ``then`` on ``file, doc_id, line_no, text``.

    ``line_no`` is a line's place in its file, from 0, also where several tasks read the file. ``doc_id`` counts the files
    in order of arrival, those of a batch by name. It goes on from the register ``path/files``, a table per batch of the files
    and numbers given out so far by it; a batch that is run again after a failure overwrites its own entry and so
    gives the same numbers. A file is expected to be complete when it appears, as Spark's file source is.
    """

    def prepare(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        earlier = _registered(spark, path, batch_id - 1)
        first = (earlier.agg(F.max("doc_id")).first()[0] + 1) if earlier is not None else 0
        lines, files = number_file_lines(batch, first)
        # A row without a file carries the last number on past a batch without lines.
        last = spark.createDataFrame([(None, first - 1, 0)], FILE_SCHEMA)
        files.unionByName(last).coalesce(1).write.mode("overwrite").parquet(f"{path}/files/batch={batch_id}")
        return then(lines)

    return prepare


def _registered(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    return spark.read.schema(FILE_SCHEMA).parquet(f"{path}/files/batch={batch_id}") if batch_id >= 0 else None


def numbered_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, doc_id, lines`` of all files that a stream under ``path`` has numbered so far."""
    return spark.read.schema(f"{FILE_SCHEMA}, batch long").parquet(f"{path}/files").filter("file IS NOT NULL").drop("batch")


def stream_clean_encode(
    lines: DataFrame, tokenizer: Tokenizer, cleaning: CleaningConfig = CleaningConfig()
) -> DataFrame:
    """Clean and encode. Stateless: the batch operators themselves, on a streaming line table."""
    cleaned = clean_lines(lines, cleaning)
    return encode_documents(cleaned, tokenizer, "clean", ascii_only=cleaning.remove_special_chars)


def stream_pack(
    encoded: DataFrame,
    max_length: int,
    path: str,
    eos: int | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataStreamWriter:
    """Pack arriving ``shard, doc_id, line_no, input_ids`` into whole blocks under ``path/blocks``.

    ``prepare`` makes such rows of a micro-batch and its number, for what a streaming plan can't do (:func:`numbered`).

    Each micro-batch is packed by the batch operator, so neither a large batch nor a hot shard passes
    through one task. What is carried from batch to batch is each shard's unfinished block (fewer than
    ``max_length`` ids) and its next block number, kept as a table per batch: a batch that is run
    again after a failure reads the same state and overwrites its own output. Lines of a batch are taken
    in corpus order, batches in order of arrival.
    """

    def pack_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            with scratch(spark):
                if prepare is not None:
                    batch = prepare(batch, batch_id)
                # The ordering sort samples its input: without this the batch would be cleaned and encoded twice.
                batch.persist()
                write_batch(spark, batch, batch_id)
            # The state before the last one serves a repetition of the last batch; older ones serve nothing.
            if batch_id >= 2:
                discard(spark, f"{path}/state/batch={batch_id - 2}")
        finally:
            batch.unpersist()

    def write_batch(spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        before = _state(spark, path, batch_id - 1)
        held = before.select("shard", F.lit(0).alias("late"), *_no_line(), F.col("input_ids"))
        arrived = batch.select(
            "shard", F.lit(1).alias("late"), *ORDER, append_eos(F.col("input_ids"), eos).alias("input_ids")
        )
        packed = pack_ids(held.unionByName(arrived), max_length, order=("late", *ORDER))
        # One row per shard on the state's side.
        shifted = (
            packed.join(F.broadcast(before.select("shard", F.col("block").alias("_done"))), "shard", "left")
            .withColumn("block", F.col("block") + F.coalesce("_done", F.lit(0)))
            .select("shard", "block", "input_ids", "n")
        )
        whole = shifted.filter(F.col("n") == max_length)
        whole.write.mode("overwrite").parquet(f"{path}/blocks/batch={batch_id}")
        rest = shifted.filter(F.col("n") < max_length)
        ends = shifted.groupBy("shard").agg(F.max(F.col("block") + (F.col("n") == max_length).cast("int")).alias("block"))
        seen = ends.unionByName(before.select("shard", "block")).groupBy("shard").agg(F.max("block").alias("block"))
        empty = F.array().cast("array<int>")
        after = seen.join(rest.select("shard", "input_ids"), "shard", "left").select(
            "shard", "block", F.coalesce("input_ids", empty).alias("input_ids"), F.size(F.coalesce("input_ids", empty)).alias("n")
        )
        after.coalesce(1).write.mode("overwrite").parquet(f"{path}/state/batch={batch_id}")

    return encoded.writeStream.foreachBatch(pack_batch).option("checkpointLocation", f"{path}/checkpoint")


def _no_line():
    return [F.lit(0).cast(t).alias(c) for c, t in zip(ORDER, ("long", "int"))]


def _state(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    if batch_id < 0:
        return spark.createDataFrame([], BLOCK_SCHEMA)
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/state/batch={batch_id}")


def packed_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The whole blocks a packing stream has written so far."""
    return spark.read.schema(f"{BLOCK_SCHEMA}, batch long").parquet(f"{path}/blocks").drop("batch")


def flush_remainder(spark: SparkSession, path: str) -> DataFrame:
    """The short last block of each shard, once the input has ended."""
    try:
        states = spark.read.schema(f"{BLOCK_SCHEMA}, batch long").parquet(f"{path}/state")
    except AnalysisException:
        return spark.createDataFrame([], BLOCK_SCHEMA)
    last = states.agg(F.max("batch")).first()[0]
    return states.filter((F.col("batch") == last) & (F.col("n") > 0)).drop("batch")
