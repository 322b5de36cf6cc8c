"""The whole job: raw lines -> cleaned lines -> tokenizer -> shuffled, batched, labelled blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.config import JobConfig
from tokenloom.operators.batching import loader_batches, train_val_blocks
from tokenloom.operators.cleaning import ReportedCleaning
from tokenloom.operators.merges import train_tokenizer
from tokenloom.operators.sequencing import number_rows
from tokenloom.operators.vocabulary import Tokenizer
from tokenloom.sources.artifact import reuse_tokenizer
from tokenloom.sources.lines import ORDER, read_text_lines, write_text_lines
from tokenloom.staging import stage


SPLITS = ("train", "val")


@dataclass(frozen=True)
class PreparedCorpus:
    """``lines`` is ``split, doc_id, line_no, text``, cleaned; ``batches`` is ready for a model; ``report`` counts lines
    and tokens per split, as the job that wrote the lines saw them."""

    lines: DataFrame
    tokenizer: Tokenizer
    samples: DataFrame
    batches: DataFrame
    report: DataFrame


def prepare_corpus(
    lines: DataFrame,
    cfg: JobConfig,
    artifact_path: str | None = None,
    tokenizer: Tokenizer | None = None,
) -> PreparedCorpus:
    """``lines`` is ``split, doc_id, line_no, text`` with splits ``train`` and ``val``.

    The cleaned lines are written once and read by training and packing alike. The tokenizer is the
    given one, else the one at ``artifact_path``, else trained on the train split. Several shards take
    turns over the cleaned lines of a split, which are numbered for that; ``line_no`` stays the raw one.
    """
    spark = lines.sparkSession

    number_col, several = "line_no", cfg.loader.shards > 1
    # The raw lines are put in order: a range sort samples its input, which would clean every line twice.
    cleaning = ReportedCleaning(lines.orderBy("split", *ORDER) if several else lines, SPLITS, cfg.cleaning)
    cleaned = cleaning.lines.select("split", "doc_id", "line_no", F.col("clean").alias("text"))
    if several:
        number_col = "split_line"
        cleaned = number_rows(cleaned, ["split"], ORDER, number_col, in_order=True)
    else:
        cleaned = stage(cleaned, "cleaned", partition_by=("split",))
    report = cleaning.report()
    train, val = (cleaned.filter(F.col("split") == s).drop("split") for s in SPLITS)
    if tokenizer is None:

        def fit() -> Tokenizer:
            return train_tokenizer(train, cfg.tokenizer)

        tokenizer = reuse_tokenizer(spark, artifact_path, fit) if artifact_path else fit()
    samples = train_val_blocks(
        train, val, tokenizer, cfg.loader, ascii_only=cfg.cleaning.remove_special_chars, number_col=number_col
    )
    return PreparedCorpus(cleaned, tokenizer, samples, loader_batches(samples, cfg.loader, tokenizer.pad_id), report)


def run_job(spark: SparkSession, cfg: JobConfig, output_dir: str) -> PreparedCorpus:
    """The file-to-file job: read the two text files of the configuration, write cleaned text and batches."""
    train = read_text_lines(spark, cfg.train_path).withColumn("split", F.lit("train"))
    val = read_text_lines(spark, cfg.val_path).withColumn("split", F.lit("val"))
    done = prepare_corpus(train.unionByName(val), cfg, f"{output_dir}/tokenizer")
    for split in SPLITS:
        write_text_lines(
            done.lines.filter(F.col("split") == split), f"{output_dir}/processed_data/{split}", order=("doc_id", "line_no")
        )
    done.report.coalesce(1).write.mode("overwrite").json(f"{output_dir}/cleaning_report")
    done.batches.write.mode("overwrite").partitionBy("split").parquet(f"{output_dir}/batches")
    return done
