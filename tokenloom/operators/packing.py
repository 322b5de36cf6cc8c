"""Token lines to training samples: one per line, or packed into blocks of exact length."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions import tokens as tk
from tokenloom.functions.text import with_computed
from tokenloom.operators.encoding import EncodeFn, encoder
from tokenloom.operators.sequencing import group_codes, running_start
from tokenloom.operators.vocabulary import Tokenizer
from tokenloom.sources.lines import ORDER, nonblank_lines
from tokenloom.staging import new_path, scratch, stage


def shard_lines(lines: DataFrame, shards: int, number_col: str = "line_no") -> DataFrame:
    """Line number modulo ``shards``. Numbers are given before blank lines go, so blanks count."""
    return lines.withColumn("shard", F.pmod(F.col(number_col), F.lit(shards)).cast("int"))


def _encode_fn(lines: DataFrame, encode: Tokenizer | EncodeFn, ascii_only: bool) -> EncodeFn:
    return encoder(lines.sparkSession, encode, ascii_only) if isinstance(encode, Tokenizer) else encode


def unpacked_samples(
    lines: DataFrame, encode: Tokenizer | EncodeFn, max_length: int, text_col: str = "text", ascii_only: bool = False
) -> DataFrame:
    """One sample per line: specials on, cut to ``max_length`` (the EOS may go), empty samples dropped."""
    fn = _encode_fn(lines, encode, ascii_only)
    ids = with_computed(lines, "input_ids", fn(F.col(text_col))).drop(text_col)
    if isinstance(encode, Tokenizer):
        ids = ids.withColumn("input_ids", tk.add_special_tokens(F.col("input_ids"), encode.bos_id, encode.eos_id))
    return ids.withColumn("input_ids", F.slice("input_ids", 1, max_length)).filter(F.size("input_ids") > 0)


def append_eos(ids: Column, eos: int | None) -> Column:
    """End-of-line id behind the ids; nothing when the tokenizer has none."""
    return ids if eos is None else F.concat(ids, F.array(F.lit(eos).cast("int")))


def _cut(groups: Sequence[str], length: int):
    """Cut runs of adjacent lines at the block borders of the whole stream.

    A task reads its lines in order, so nearly all blocks come out whole; a block that another task
    has a part of comes out as a piece with its place ``at`` in the block.
    """

    def pieces(key: tuple, at: int, ids: np.ndarray):
        """Split ids that begin at stream position ``at``: an optional head, whole blocks, an optional tail."""
        edges = np.arange(at + length - at % length, at + len(ids), length) - at
        edges = np.concatenate([[0], edges, [len(ids)]])
        position = at + edges[:-1]
        return key, position // length, position % length, edges, ids

    def emit(found, types) -> pa.RecordBatch:
        sizes = [len(p[1]) for p in found]
        columns = [
            pa.array([v for p, n in zip(found, sizes) for v in [p[0][g]] * n], types[g]) for g in range(len(groups))
        ]
        blocks = np.concatenate([p[1] for p in found])
        ats = np.concatenate([p[2] for p in found])
        lens = np.concatenate([np.diff(p[3]) for p in found])
        ids = np.concatenate([p[4] for p in found])
        bounds = np.concatenate([[0], np.cumsum(lens)])
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
        columns += [pa.array(blocks, pa.int64()), pa.array(ats, pa.int32()), lists, pa.array(lens == length)]
        return pa.RecordBatch.from_arrays(columns, names=[*groups, "block", "at", "input_ids", "whole"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[tuple, int, np.ndarray] | None = None
        types: list[pa.DataType] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(g).type for g in groups]
            start = batch.column("start").to_numpy(zero_copy_only=False)
            lists = batch.column("input_ids")
            n = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            offset = np.concatenate([[0], np.cumsum(n)])
            opens = group_codes(batch, groups)
            opens[1:] |= start[1:] != start[:-1] + n[:-1]
            rows = np.append(np.flatnonzero(opens), batch.num_rows)
            found = []
            for first, stop in zip(rows[:-1], rows[1:]):
                key = tuple(batch.column(g)[int(first)].as_py() for g in groups)
                at, ids = int(start[first]), flat[offset[first] : offset[stop]]
                if held is not None:
                    if held[0] == key and held[1] + len(held[2]) == at:
                        at, ids = held[1], np.concatenate([held[2], ids])
                    elif len(held[2]):
                        found.append(pieces(*held))
                keep = max(at, (at + len(ids)) // length * length)
                if keep > at:
                    found.append(pieces(key, at, ids[: keep - at]))
                held = (key, keep, ids[keep - at :])
            if found:
                yield emit(found, types)
        if held is not None and len(held[2]):
            yield emit([pieces(*held)], types)

    return run


def pack_ids(
    encoded: DataFrame,
    max_length: int,
    drop_last: bool = False,
    groups: Sequence[str] = ("shard",),
    order: Sequence[str] = ORDER,
    in_order: bool = False,
) -> DataFrame:
    """Concatenate ``input_ids`` per group in order and cut into blocks: ``groups, block, input_ids, n``.

    The token stream is shuffled once, by the range sort that orders it. Blocks are then cut where the
    lines lie; only the few pieces at task borders are grouped, at most ``max_length`` ids to a block.
    """
    rows = encoded.select(*groups, *order, "input_ids").withColumn("_n", F.size("input_ids").cast("bigint"))
    group_fields = [encoded.schema[g] for g in groups]
    schema = T.StructType(
        [
            *group_fields,
            T.StructField("block", T.LongType()),
            T.StructField("at", T.IntegerType()),
            T.StructField("input_ids", T.ArrayType(T.IntegerType())),
            T.StructField("whole", T.BooleanType()),
        ]
    )
    path = new_path(encoded.sparkSession, "blocks")
    with scratch(encoded.sparkSession):
        placed = running_start(rows, groups, order, "_n", in_order, name="lines")
        cut = placed.select(*groups, "start", "input_ids").mapInArrow(_cut(groups, max_length), schema)
        # Written once: whether a block came out whole depends on how the read was split into tasks.
        staged = stage(cut, "blocks", path, partition_by=("whole",))
    whole = staged.filter("whole").select(*groups, "block", "input_ids")
    joined = (
        staged.filter(~F.col("whole"))
        .groupBy(*groups, "block")
        .agg(F.array_sort(F.collect_list(F.struct("at", "input_ids"))).alias("parts"))
        .select(*groups, "block", F.flatten("parts.input_ids").alias("input_ids"))
    )
    if drop_last:
        joined = joined.filter(F.size("input_ids") == max_length)
    return whole.unionByName(joined).withColumn("n", F.size("input_ids"))


def pack_blocks(
    lines: DataFrame,
    encode: Tokenizer | EncodeFn,
    max_length: int,
    shards: int = 1,
    drop_last: bool = False,
    eos: int | None = None,
    text_col: str = "text",
    by: Sequence[str] = (),
    ascii_only: bool = False,
    number_col: str = "line_no",
    prepare: Callable[[DataFrame], DataFrame] = nonblank_lines,
) -> DataFrame:
    """Shard, strip, encode with an EOS behind every line, pack: ``by, shard, block, input_ids, n``.

    The raw lines are sorted, then prepared and encoded: the sort's sampling pass would otherwise do that
    work once more. ``prepare`` works row by row on the column ``text`` and may drop rows (cleaning, say).
    """
    if isinstance(encode, Tokenizer):
        eos = encode.eos_id
    fn = _encode_fn(lines, encode, ascii_only)
    groups = [*by, "shard"]
    texts = shard_lines(lines, shards, number_col).select(*groups, *ORDER, F.col(text_col).alias("text"))
    texts = prepare(texts.orderBy(*groups, *ORDER))
    encoded = with_computed(texts, "input_ids", append_eos(fn(F.col("text")), eos)).drop("text")
    return pack_ids(encoded, max_length, drop_last, groups, in_order=True)
