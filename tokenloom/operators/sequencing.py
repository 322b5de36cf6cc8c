"""Running totals over a global order, without putting a whole group into one task.

A window over one shard would pass the shard through a single task. Here rows are range-partitioned by
their unique order key, so a document or shard of any size is cut into even pieces; each task totals its
own piece, and only one total per piece and group is summed globally.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.staging import stage


_BROADCAST_TOTALS = 200_000


def group_codes(batch: pa.RecordBatch, groups: Sequence[str]) -> np.ndarray:
    """For each row, whether it opens a run of equal group values (the first row always does)."""
    opens = np.zeros(batch.num_rows, dtype=bool)
    opens[:1] = True
    for g in groups:
        col = batch.column(g)
        differs = pc.not_equal(col.slice(1), col.slice(0, max(0, len(col) - 1)))
        opens[1:] |= differs.to_numpy(zero_copy_only=False)
    return opens


def _key(batch: pa.RecordBatch, groups: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(g)[row].as_py() for g in groups)


def _running(groups: Sequence[str], weight: str) -> Column:
    """The total of a task's earlier rows of the same group, for rows in order. Only weights and groups go to Python and back."""

    @F.arrow_udf(T.LongType())
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        current, carried = None, 0
        for columns in batches:
            batch = pa.RecordBatch.from_arrays(list(columns), names=["_weight", *(groups or ["_all"])])
            if not batch.num_rows:
                yield pa.array([], pa.int64())
                continue
            w = batch.column("_weight").to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(w) - w
            starts = np.flatnonzero(group_codes(batch, groups))
            base = before[starts].copy()
            if _key(batch, groups, 0) == current:
                base[0] -= carried
            before -= np.repeat(base, np.diff(np.append(starts, len(w))))
            current, carried = _key(batch, groups, len(w) - 1), int(before[-1] + w[-1])
            yield pa.array(before)

    # Its value depends on the rows before, so it must be neither repeated nor moved.
    return run.asNondeterministic()(weight, *(groups or [weight]))


def running_start(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], weight: str, in_order: bool = False, name: str = "ordered"
) -> DataFrame:
    """Add ``start``: the total ``weight`` of all earlier rows of the same group, in ``order``.

    ``in_order`` says ``df`` is already globally sorted by groups and order, which lets a caller sort the
    raw text before costly steps: a range sort samples its input, that is, computes it twice.
    The ordered rows are written once (the piece numbers must not be recomputed differently), and come back in runs of
    adjacent rows, a run per file that a task reads.
    """
    ordered = df if in_order else df.orderBy(*groups, *order)
    staged = stage(ordered.select("*", F.spark_partition_id().alias("_piece"), _running(groups, weight).alias("_before")), name)
    # One row per written piece and group: as many as the sort had partitions, plus one per further group.
    totals = staged.groupBy("_piece", *groups).agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(*groups).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_piece", *groups, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    bases = stage(bases, f"{name}-bases")
    # A broadcast join leaves the written order alone. One that shuffles, for very many groups, loses it.
    few = bases.count() <= _BROADCAST_TOTALS
    joined = staged.join(F.broadcast(bases) if few else bases, ["_piece", *groups])
    placed = joined.withColumn("start", F.col("_base") + F.col("_before")).drop("_piece", "_before", "_base")
    return placed if few else placed.sortWithinPartitions(*groups, "start")


def number_rows(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str = "position", in_order: bool = False
) -> DataFrame:
    """Add the dense row number, from 0, within the group."""
    placed = running_start(df.withColumn("_one", F.lit(1)), groups, order, "_one", in_order, "numbered")
    return placed.withColumnRenamed("start", out).drop("_one")
