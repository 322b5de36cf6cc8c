"""What several operators share: free column names, staged tables, and words of a batch as numbers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.staging import discard, new_path

# Words are the runs of characters other than these; no UTF-8 continuation byte is among them.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BLOCK = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that ``df`` doesn't have yet, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(df: DataFrame, name: str) -> Column:
    """The column of that very name, also when it holds dots or other odd characters."""
    return df[f"`{name.replace('`', '``')}`"]


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the job's shuffle files go when it has ended.

    The folder goes with the application. Executors can be lost at any time: what follows re-reads files.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        schema = df.schema
        df.write.options(**options).parquet(path)
        out = spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    out.staged_at = path
    return out


def drop_staged(*tables: DataFrame) -> None:
    """Remove staged tables that no later step reads."""
    for df in tables:
        discard(df.sparkSession, df.staged_at)


def kept_names(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name, for use on a table made from it."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def text_of(df: DataFrame, text_col: str) -> Column:
    return F.coalesce(col(df, text_col).cast("string"), F.lit(""))


def running_sums(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Add for each ``out: weight`` the total weight of all earlier rows in ``order``, which tells rows apart.

    Rows are sorted by range; each piece sums up its own rows, and only one total per piece is summed globally.
    """
    part, *bases = fresh(df, "_part", *[f"_base{i}" for i in range(len(sums))])
    placed = staged(df.repartitionByRange(*[col(df, c) for c in order]).withColumn(part, F.spark_partition_id()), "in-order")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per written piece
    totals = placed.groupBy(part).agg(*[F.sum(w).alias(b) for b, w in zip(bases, sums.values(), strict=True)])
    totals = totals.select(part, *[F.coalesce(F.sum(b).over(before), F.lit(0)).alias(b) for b in bases])
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.select("*", *[F.coalesce(F.sum(w).over(inside), F.lit(0)).alias(o) for o, w in sums.items()]).join(totals, part)
    return joined.select(*kept_names(df), *[(F.col(o) + F.col(b)).cast("long").alias(o) for o, b in zip(sums, bases, strict=True)])


def text_slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows with about ``size`` bytes of text; a longer text comes alone.

    Gives the rows, the text bytes as one array, and the n + 1 offsets of the rows in it.
    """
    for batch in batches:
        texts = batch.column(column)
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        n, at = len(texts), texts.offset
        offsets = np.frombuffer(texts.buffers()[1], width)[at : at + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8) if n and texts.buffers()[2] is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
            hi = min(hi, n)
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it (n + 1 numbers)."""
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.empty(len(data), bool)
    edge[:1] = inside[:1]
    edge[1:] = inside[1:] & ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    edge[firsts] = inside[firsts]
    starts = np.flatnonzero(edge)
    edge[:-1] = inside[:-1] & ~inside[1:]
    edge[-1:] = inside[-1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    edge[lasts] = inside[lasts]
    ends = np.flatnonzero(edge) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _byte_codes() -> np.ndarray:
    return _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over a code per byte, mixed. ``lower`` folds A-Z.

    Works on blocks of whole words, so that memory beside the result stays bounded for any text length.
    """
    codes = _byte_codes()
    if lower:
        codes[65:91] = codes[97:123]
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _BLOCK, "right")))
        lo, hi = int(starts[first]), int(ends[last - 1])
        power = np.empty(hi - lo + 1, np.uint64)
        power[0] = 1
        power[1:] = _BASE
        np.multiply.accumulate(power, out=power)
        # The sum up to a place, with later bytes weighing more; equal words differ by a power of the base only.
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(codes[data[lo:hi]] * power[:-1], out=sums[1:])
        back = np.empty(hi - lo + 1, np.uint64)
        back[0] = 1
        back[1:] = inverse
        np.multiply.accumulate(back, out=back)
        s, e = starts[first:last] - lo, ends[first:last] - lo
        out[first:last] = _mixed((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))
        first = last
    return out


def joined_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of each ordered pair of hashes."""
    return _mixed(a * _BASE + b)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` word hashes; empty when there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _mixed(out * _BASE + words[i : i + n])
    return out


def join_totals(rows: DataFrame, totals: DataFrame, keys: list[str], rows_of: str, share: int = 1_000) -> DataFrame:
    """Left-join ``totals``, one row for each value of ``keys`` (nulls equal), whose column ``rows_of`` counts their rows.

    Values with at least one row in ``share`` are at most ``share`` of them, so these are broadcast and their rows stay
    where they are; all other rows meet their totals by a shuffle, in which no key is hot. ``rows`` and ``totals``
    should be written tables: both are read twice. Columns of ``totals`` other than ``keys`` need new names.
    """
    n = totals.agg(F.sum(rows_of)).first()[0] or 0
    heavy = totals.filter(F.col(rows_of) * share >= n)
    mark, *names = fresh(rows.join(totals.drop(*keys)), "_heavy", *[f"_key{i}" for i in range(len(keys))])

    def met(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(*[col(right, k).alias(m) for k, m in zip(keys, names, strict=True)], *[col(right, c) for c in right.columns if c not in keys])
        same = [F.col(m).eqNullSafe(col(left, k)) for k, m in zip(keys, names, strict=True)]
        return left.join(right, reduce(lambda a, b: a & b, same), how).drop(*names)

    # Rows of heavy keys are told apart by the marker that their totals bring along.
    near = met(rows, F.broadcast(heavy.withColumn(mark, F.lit(True))), "inner").drop(mark)
    far = met(rows, F.broadcast(heavy.select(*keys)), "left_anti")
    return near.unionByName(met(far, totals.filter(F.col(rows_of) * share < n), "left"))
