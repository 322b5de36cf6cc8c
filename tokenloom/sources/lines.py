"""Text lines in, text lines out, and the assembly of named splits.

Every line carries ``(doc_id, line_no)``: Spark tables have no row order, so the order is data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import strip_text, with_computed
from tokenloom.staging import stage

ORDER = ("doc_id", "line_no")


def split_lines(text: Column) -> Column:
    """Lines of a text as reading it as a file would give them: any newline style, no empty last line."""
    parts = F.split(text, r"\r\n?|\n")
    ends_with_newline = F.substring(text, -1, 1).isin("\n", "\r")
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(ends_with_newline, F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts)
    )


def doc_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per line of each document: ``doc_id, line_no, text``. A narrow, shuffle-free generate."""
    return df.select(
        F.col(id_col).alias("doc_id"),
        *keep,
        F.posexplode(split_lines(F.col(text_col))).alias("line_no", "text"),
    )


def nonblank_lines(lines: DataFrame, text_col: str = "text") -> DataFrame:
    return with_computed(lines, text_col, strip_text(F.col(text_col))).filter(F.col(text_col) != "")


def drop_heading_lines(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """Stripped lines that are neither empty nor article markers (``= Title =``)."""
    return nonblank_lines(lines, text_col).filter(~F.startswith(F.col(text_col), F.lit("=")))


def file_lines(reader: DataFrame) -> DataFrame:
    """``file, block, text`` of a text source, batch or stream: the lines, and the file block that a task reads them from."""
    return reader.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("text"),
    )


def number_file_lines(raw: DataFrame, first_doc: int = 0) -> tuple[DataFrame, DataFrame]:
    """Number the rows of :func:`file_lines`: ``file, doc_id, line_no, text``, and a written ``file, doc_id, lines`` of the files.

    Tasks see whole file blocks in order, so a line's number is its place within its block plus the
    lines of the file's earlier blocks. The place comes from one read that is staged, since ids given
    by position in a task must not be recomputed; only one row per block is summed over. ``doc_id``
    is the rank of the file by name, from ``first_doc``, so that the order of the lines does not depend on where the
    folder lies.
    """
    staged = stage(raw.withColumn("seq", F.monotonically_increasing_id()), "text-lines")
    blocks = staged.groupBy("file", "block").agg(F.min("seq").alias("first_seq"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_seq")
    # One row per file block, so one task orders the files.
    doc_id = F.dense_rank().over(Window.orderBy("file")).cast("bigint") - 1 + first_doc
    blocks = stage(blocks.select("file", "block", "n", shift.alias("shift"), doc_id.alias("doc_id")), "text-blocks")
    lines = staged.join(blocks.drop("n"), ["file", "block"]).select(
        "file", "doc_id", (F.col("seq") + F.col("shift")).alias("line_no"), "text"
    )
    return lines, blocks.groupBy("file", "doc_id").agg(F.sum("n").alias("lines"))


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Number the lines of splittable text files: ``file, doc_id, line_no, text``; ``doc_id`` ranks the files by name."""
    return number_file_lines(file_lines(spark.read.text(path)))[0]


def write_text_lines(lines: DataFrame, path: str, text_col: str = "text", order: tuple[str, ...] = ()) -> None:
    """Newline-joined text files. With ``order`` the part files, read by name, are in that order."""
    if order:
        lines = lines.orderBy(*order)
    lines.select(F.col(text_col).alias("value")).write.mode("overwrite").text(path)


def rename_split(split: Column) -> Column:
    """The source says ``validation``, the outputs say ``valid``."""
    return F.when(split == "validation", "valid").otherwise(split)


def dataset_splits(lines: DataFrame, split_col: str = "split") -> DataFrame:
    """Heading-free lines with the output name of their split."""
    return drop_heading_lines(lines).withColumn("split", rename_split(F.col(split_col)))


def write_dataset(lines: DataFrame, path: str, split_col: str = "split") -> DataFrame:
    """Write ``path/split=<name>/`` text files in one job and return the written table."""
    dataset_splits(lines, split_col).select("split", F.col("text").alias("value")).write.mode(
        "overwrite"
    ).partitionBy("split").text(path)
    return lines.sparkSession.read.text(path).withColumnRenamed("value", "text")


def split_stats(
    dataset: DataFrame, path: str, name: str, version: str, source: str, description: str
) -> DataFrame:
    """One row per split: line count and path, with the data set's info repeated on each row.

    The row key is the name the source uses; the path holds the name used on disk.
    """
    return dataset.groupBy("split").agg(F.count("*").alias("num_lines")).select(
        F.when(F.col("split") == "valid", "validation").otherwise(F.col("split")).alias("split"),
        "num_lines",
        F.concat(F.lit(f"{path.rstrip('/')}/split="), F.col("split")).alias("path"),
        F.lit(name).alias("name"),
        F.lit(version).alias("version"),
        F.lit(source).alias("source"),
        F.lit(description).alias("description"),
    )


def preview_sample(lines: DataFrame, splits: list[str], n: int = 5, split_col: str = "split") -> DataFrame:
    """The first ``n`` lines of each named split in corpus order.

    One scan: the limit on the rank is applied in every task before the shuffle and once more after it.
    """
    rank = F.row_number().over(Window.partitionBy(split_col).orderBy(*ORDER))
    return lines.filter(F.col(split_col).isin(splits)).withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
