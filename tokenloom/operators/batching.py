"""Shuffling, batching and collating samples."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.config import LoaderConfig
from tokenloom.functions import tokens as tk
from tokenloom.operators.encoding import EncodeFn
from tokenloom.operators.packing import pack_blocks, shard_lines, unpacked_samples
from tokenloom.operators.sequencing import number_rows
from tokenloom.operators.vocabulary import Tokenizer
from tokenloom.sources.lines import ORDER, nonblank_lines


def drawn_slot(buffer: int, seed: int, groups: Sequence[str], step: Column) -> Column:
    """The buffer slot that is given out at a step: 48 bits of an MD5 of seed, groups and step, modulo ``buffer``."""
    code = F.md5(F.concat_ws(":", F.lit(str(seed)), *groups, step).cast("binary"))
    return F.pmod(F.conv(F.substring(code, 1, 12), 16, 10).cast("long"), F.lit(buffer))


def shuffle_blocks(
    blocks: DataFrame, buffer: int, seed: int = 0, groups: Sequence[str] = ("shard",), index: str = "block"
) -> DataFrame:
    """Add ``position``: the order in which a replacement buffer gives out the samples of each group.

    The first ``buffer`` samples fill the buffer. Each later one is a step: a slot is drawn, its sample is given out, and the
    new one takes its place; at the end the samples left are given out in random order. ``index`` numbers a group's
    samples from 0 without gaps; a buffer of one or less leaves the order alone.

    The draws don't depend on the samples, so the buffer needs no loop: samples of one slot form a chain, and a sample leaves
    at the step that brings the chain's next one. A task sorts the chain of one slot, a ``buffer``-th of a group; only the
    samples left at the end, at most ``buffer`` of a group, are ordered together. Both parts read one exchange.
    """
    if buffer <= 1:
        return blocks.withColumn("position", F.col(index))
    place = F.col(index).cast("bigint")
    slot = F.when(place < buffer, place).otherwise(drawn_slot(buffer, seed, groups, place - buffer))
    chain = Window.partitionBy(*groups, "_slot").orderBy(index)
    chained = blocks.withColumn("_slot", slot).withColumn("_next", F.lead(place).over(chain))
    out = chained.filter("_next IS NOT NULL").withColumn("position", F.col("_next") - buffer)
    # The last sample of a group is always among those left, so its number tells how many samples there are.
    left = Window.partitionBy(*groups)
    last = F.md5(F.concat_ws(":", F.lit(f"{seed}:left"), *groups, index).cast("binary"))
    at_end = chained.filter("_next IS NULL").withColumn("_draw", last)
    at_end = at_end.withColumn("_n", F.max(place).over(left) + 1).withColumn("_rank", F.row_number().over(left.orderBy("_draw", index)))
    at_end = at_end.withColumn("position", F.greatest(F.lit(0), F.col("_n") - buffer) + F.col("_rank") - 1)
    return out.drop("_slot", "_next").unionByName(at_end.drop("_slot", "_next", "_draw", "_n", "_rank"))


def batch_blocks(samples: DataFrame, batch_size: int, position: str = "position") -> DataFrame:
    """Add ``batch_id, row_in_batch``. Positions are dense in a shard, so this is arithmetic, no window."""
    return samples.withColumn("batch_id", F.floor(F.col(position) / batch_size)).withColumn(
        "row_in_batch", F.pmod(F.col(position), F.lit(batch_size)).cast("int")
    )


def collate(
    batches: DataFrame, pad: int, groups: Sequence[str] = ("shard",), width: Column | None = None
) -> DataFrame:
    """Pad to the longest sample of the batch; mask by value; label -100 where masked.

    ``width`` gives the longest length where it is known beforehand, which saves the shuffle that brings
    a batch together.
    """
    if width is None:
        width = F.max(F.size("input_ids")).over(Window.partitionBy(*groups, "batch_id"))
    padded = batches.withColumn("_width", width).withColumn("input_ids", tk.pad_ids(F.col("input_ids"), F.col("_width"), pad))
    return padded.drop("_width").select(
        "*",
        tk.pad_mask(F.col("input_ids"), pad).alias("attention_mask"),
        tk.labels_of(F.col("input_ids"), pad).alias("labels"),
    )


def split_samples(
    lines: DataFrame,
    encode: Tokenizer | EncodeFn,
    cfg: LoaderConfig,
    eos: int | None = None,
    text_col: str = "text",
    by: Sequence[str] = (),
    ascii_only: bool = False,
    number_col: str = "line_no",
    prepare: Callable[[DataFrame], DataFrame] = nonblank_lines,
) -> DataFrame:
    """All samples in reading order: ``by, shard, block, input_ids, n``; ``block`` counts samples of a shard.

    Lines are sorted before they are prepared and encoded, so that the sort's sampling pass stays cheap.
    """
    if cfg.pack_sequences:
        return pack_blocks(
            lines, encode, cfg.max_length, cfg.shards, False, eos, text_col, by, ascii_only, number_col, prepare
        )
    groups = [*by, "shard"]
    texts = shard_lines(lines, cfg.shards, number_col).select(*groups, *ORDER, F.col(text_col).alias("text"))
    texts = prepare(texts.orderBy(*groups, *ORDER))
    samples = number_rows(unpacked_samples(texts, encode, cfg.max_length, "text", ascii_only), groups, ORDER, "block", True)
    return samples.select(*groups, "block", "input_ids", F.size("input_ids").alias("n"))


def whole_samples(samples: DataFrame, cfg: LoaderConfig) -> DataFrame:
    """The samples that training reads: without the short remainder of each shard, if configured."""
    return samples.filter(F.col("n") == cfg.max_length) if cfg.pack_sequences and cfg.drop_last_block else samples


def train_samples(samples: DataFrame, cfg: LoaderConfig, groups: Sequence[str] = ("shard",)) -> DataFrame:
    """Training drops the short remainder of each shard, if configured, and shuffles."""
    return shuffle_blocks(whole_samples(samples, cfg), cfg.shuffle_buffer_size, cfg.seed, groups)


def val_samples(samples: DataFrame) -> DataFrame:
    """Validation keeps every sample, in reading order."""
    return samples.withColumn("position", F.col("block"))


def train_val_blocks(
    train_lines: DataFrame,
    val_lines: DataFrame,
    encode: Tokenizer | EncodeFn,
    cfg: LoaderConfig,
    eos: int | None = None,
    text_col: str = "text",
    ascii_only: bool = False,
    number_col: str = "line_no",
    prepare: Callable[[DataFrame], DataFrame] = nonblank_lines,
) -> DataFrame:
    """Samples of both splits: ``split, shard, block, input_ids, n, position``. One pass packs the two."""
    both = train_lines.withColumn("split", F.lit("train")).unionByName(val_lines.withColumn("split", F.lit("val")))
    samples = split_samples(both, encode, cfg, eos, text_col, ["split"], ascii_only, number_col, prepare)
    return placed_samples(samples, cfg)


def placed_samples(samples: DataFrame, cfg: LoaderConfig) -> DataFrame:
    """Add ``position`` to the samples of both splits: shuffled in training, in reading order in validation."""
    train, val = (samples.filter(F.col("split") == s) for s in ("train", "val"))
    return train_samples(train, cfg).unionByName(val_samples(val))


def _packed_width(cfg: LoaderConfig) -> Column:
    """Batch width of packed samples of which only the last of a shard may be short.

    A short sample shares its batch with full ones, unless it is the first of its batch and so alone in it.
    """
    alone = (F.col("n") < cfg.max_length) & (F.col("row_in_batch") == 0)
    return F.when(alone, F.col("n")).otherwise(F.lit(cfg.max_length))


def loader_batches(samples: DataFrame, cfg: LoaderConfig, pad: int, groups: Sequence[str] = ("split", "shard")) -> DataFrame:
    """Model-ready batches: ``groups, batch_id, row_in_batch, input_ids, attention_mask, labels``.

    ``samples`` as :func:`train_samples` or :func:`val_samples` leave them. A short packed sample stays
    last in its shard, except where training keeps and shuffles it.
    """
    short_is_last = cfg.pack_sequences and (cfg.drop_last_block or cfg.shuffle_buffer_size <= 1)
    batches = batch_blocks(samples, cfg.batch_size)
    return collate(batches, pad, groups, _packed_width(cfg) if short_is_last else None).select(
        *groups, "batch_id", "row_in_batch", "input_ids", "attention_mask", "labels"
    )
