"""Packing documents into sequences of a fixed window by non-negative least squares.

A document of n ids is cut into whole windows, which are sequences of their own, and a rest shorter than a
window. The histogram of the rests is all that the planning needs, whatever the corpus: combinations of up to
three lengths (in units of a few ids) that fill a window are enumerated, and non-negative least squares says
how often to use each so that together they use up the histogram. Repeats are rounded down, and what is left is
packed greedily, longest first; a gap that no length fits is filled by cutting a rest.

The plan names ranges of ranks among the rests of one length. Every rest finds its own place from its rank,
so the plan is joined on the length, and no group of equal lengths needs to come together in a task.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.byte_bpe import encoded_rows
from tokenloom.llm.common import col, running_sums, staged, text_of, text_slices

WINDOW = 2048
#: Ids in a unit of length; rests of fewer than SHORT units are left to the greedy step, which counts single ids.
UNIT, SHORT = 8, 8
#: Gaps of fewer ids are padded rather than filled by a cut.
LEAST_CUT = 32


def combinations(units: int, short: int) -> list[tuple[int, ...]]:
    """All multisets of up to three lengths of at least ``short`` that add up to ``units``."""
    out: list[tuple[int, ...]] = [(units,)]
    for a in range(short, units // 2 + 1):
        out.append((a, units - a))
        out += [(a, b, units - a - b) for b in range(a, (units - a) // 2 + 1)]
    return out


def nnls(matrix: np.ndarray, target: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """Non-negative x with the least squared error of ``matrix @ x - target``, by active sets."""
    gram, right = matrix.T @ matrix, matrix.T @ target
    n = len(right)
    x, free, barred = np.zeros(n), np.zeros(n, bool), np.zeros(n, bool)
    scale = max(float(np.abs(right).max(initial=0.0)), 1e-30)
    for _ in range(4 * len(target) + 10):
        slope = np.where(free | barred, -np.inf, right - gram @ x)
        enter = int(slope.argmax())
        if slope[enter] <= tolerance * scale:
            break
        free[enter] = True
        while True:
            own = np.flatnonzero(free)
            best = np.linalg.solve(gram[np.ix_(own, own)] + 1e-10 * np.eye(len(own)), right[own])
            if best.min() > 0:
                barred[:] = False
                x[:] = 0
                x[own] = best
                break
            falling = best <= 0
            step = min(1.0, float((x[own][falling] / np.maximum(x[own][falling] - best[falling], 1e-300)).min()))
            x[own] += step * (best - x[own])
            out = own[(x[own] <= 1e-12 * max(1.0, x.max())) & falling]
            if not len(out):
                out = own[[int(best.argmin())]]
            if enter in out:
                barred[enter] = True
            x[out] = 0
            free[out] = False
            if not free.any():
                break
    return x


@dataclass
class Plan:
    """Places for rests: of those of ``rest`` ids, ranks ``lo`` to ``hi`` (exclusive) have ids ``first`` to ``last`` in
    sequence ``base + (rank - lo) // each``, after ``slot + (rank - lo) % each`` other pieces."""

    rows: list[tuple[int, int, int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def add(self, rest: int, lo: int, hi: int, first: int, last: int, each: int, slot: int, base: int | None = None) -> None:
        self.rows.append((rest, lo, hi, first, last, each, slot, self.sequences if base is None else base))


PLAN_COLUMNS = "rest int, lo long, hi long, first int, last int, each int, slot int, base long"


def plan_rests(counts: np.ndarray, window: int = WINDOW, unit: int = UNIT, short: int = SHORT) -> Plan:
    """A place for each of ``counts[r]`` rests of r ids, ranked from 0 within their length."""
    plan, units = Plan(), window // unit
    left = counts.astype(np.int64).copy()  # of each length, the highest ranks are still left
    size = (np.arange(window) + unit - 1) // unit
    histogram = np.bincount(size, weights=left, minlength=units + 1)[: units + 1]
    kinds = combinations(units, short)
    if histogram[short:].sum():
        matrix = np.zeros((units + 1, len(kinds)))
        for k, kind in enumerate(kinds):
            for u in kind:
                matrix[u, k] += 1
        target = np.where(np.arange(units + 1) >= short, histogram, 0)
        repeats = np.floor(nnls(matrix, target / target.max()) * target.max() + 1e-6).astype(np.int64)
        budget = target.astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            if not repeats[k]:
                break
            need = matrix[:, k].astype(np.int64)
            n = min(int(repeats[k]), int((budget[need > 0] // need[need > 0]).min()))
            if n:
                budget -= n * need
                for slot, u in enumerate(kinds[k]):
                    at = plan.sequences
                    for rest in range(max(1, (u - 1) * unit + 1), min(window - 1, u * unit) + 1):
                        got = min(int(left[rest]), plan.sequences + n - at)
                        if got:
                            lo = int(counts[rest] - left[rest])
                            plan.add(rest, lo, lo + got, 0, rest, 1, slot, at)
                            left[rest] -= got
                            at += got
                plan.sequences += n
    _greedy(plan, counts, left, window)
    return plan


def _greedy(plan: Plan, counts: np.ndarray, left: np.ndarray, window: int) -> None:
    """Longest first, filled up with the longest that fits; many sequences alike at once."""
    pool: dict[int, list[tuple[int, int, int, int]]] = {}  # length: (rest, first, lo, hi)
    for r in np.flatnonzero(left[1:]) + 1:
        pool[int(r)] = [(int(r), 0, int(counts[r] - left[r]), int(counts[r]))]
    lengths = sorted(pool)

    def take(length: int, n: int) -> tuple[int, int, int, int]:
        rest, first, lo, hi = pool[length][-1]
        if lo + n == hi:
            pool[length].pop()
            if not pool[length]:
                del pool[length]
                lengths.remove(length)
        else:
            pool[length][-1] = (rest, first, lo + n, hi)
        return rest, first, lo, lo + n

    def available(length: int, taken: dict[int, int]) -> int:
        _, _, lo, hi = pool[length][-1]
        return hi - lo - taken.get(length, 0)

    while lengths:
        gap, taken, slots = window, {}, []
        while gap and lengths:
            at = bisect_right(lengths, gap) - 1
            while at >= 0 and not available(lengths[at], taken):
                at -= 1
            if at < 0:
                break
            length = lengths[at]
            n = min(gap // length, available(length, taken))
            taken[length] = taken.get(length, 0) + n
            slots.append((length, n))
            gap -= n * length
        cut = 0
        if gap >= LEAST_CUT:
            longer = [x for x in reversed(lengths) if x > gap and available(x, taken)]
            cut = longer[0] if longer else 0
        used = dict(taken)
        if cut:
            used[cut] = used.get(cut, 0) + 1
        repeat = min(available(x, {}) // n for x, n in used.items())
        slot = 0
        for length, n in slots:
            rest, first, lo, hi = take(length, n * repeat)
            plan.add(rest, lo, hi, first, first + length, n, slot)
            slot += n
        if cut:
            rest, first, lo, hi = take(cut, repeat)
            plan.add(rest, lo, hi, first, first + gap, 1, slot)
            if cut - gap not in pool:
                insort(lengths, cut - gap)
            pool.setdefault(cut - gap, []).insert(0, (rest, first + gap, lo, hi))
        plan.sequences += repeat


# Ids between the steps are bytes: nothing looks at single ids there.
_ENCODED = "doc_id long, row long, n long, codes binary"


def code_type(vocabulary: str, end_id: int) -> np.dtype:
    """Two bytes an id if all ids of the vocabulary file and the end id fit in them, else four."""
    with open(vocabulary, encoding="utf-8") as f:
        known = json.load(f)
    ids = [end_id, *known["model"]["vocab"].values(), *[t["id"] for t in known.get("added_tokens") or []]]
    return np.dtype("<u2") if max(ids) <= np.iinfo(np.uint16).max else np.dtype("<u4")


def _encode(ranks: str, vocabulary: str, end_id: int, code: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for rows, ids, offsets in encoded_rows(batches, text_slices, ranks, vocabulary, end_id):
            n = rows.num_rows
            data = pa.py_buffer(ids.astype(code).tobytes())
            places = pa.py_buffer((offsets * code.itemsize).astype(np.int32).tobytes())
            codes = pa.Array.from_buffers(pa.binary(), n, [None, places, data])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.arange(row, row + n)), pa.array(np.diff(offsets)), codes],
                names=["doc_id", "row", "n", "codes"],
            )
            row += n

    return run


def _cut(checksums: bool, code: np.dtype):
    """The ids of each piece, or their checksum, some documents at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cut_batch(batch, checksums, code)

    return run


def _cut_batch(batch: pa.RecordBatch, checksums: bool, code: np.dtype) -> Iterator[pa.RecordBatch]:
    if batch.num_rows:
        codes, pieces = batch.column("codes").cast(pa.large_binary()), batch.column("pieces")
        values = np.frombuffer(codes.buffers()[2], np.uint8)
        offsets = np.frombuffer(codes.buffers()[1], np.int64)[codes.offset : codes.offset + len(codes) + 1]
        first = int(offsets[0])
        values = values[first : int(offsets[-1])].view(code)
        offsets = (offsets - first) // code.itemsize
        fields = {f: pieces.values.field(f).to_numpy(zero_copy_only=False) for f in ("start", "length", "sequence_id", "offset")}
        spans = pieces.offsets.to_numpy()
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20), "right")) - 1)
            hi = min(hi, batch.num_rows)
            a, b = spans[lo], spans[hi]
            doc = np.repeat(np.arange(lo, hi), np.diff(spans[lo : hi + 1]))
            lengths = fields["length"][a:b]
            begin = offsets[doc] + fields["start"][a:b]
            ends = np.cumsum(lengths)
            index = np.repeat(begin - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
            if checksums:
                data = memoryview(np.ascontiguousarray(values[index], "<u4")).cast("B")
                edges = [0, *ends.tolist()]
                last = pa.array([zlib.crc32(data[4 * x : 4 * y]) for x, y in zip(edges[:-1], edges[1:], strict=True)], pa.int64())
            else:
                last = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values[index].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    *[pa.array(fields[f][a:b]) for f in ("start", "length")],
                    batch.column("n").take(pa.array(doc)),
                    *[pa.array(fields[f][a:b]) for f in ("sequence_id", "offset")],
                    last,
                ],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32" if checksums else "ids"],
            )
            lo = hi


_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame,
    ranks: str,
    vocabulary: str,
    end_id: int,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    checksums: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``; with ``checksums``,
    ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers in place of the ids.

    A document is the ids of its whole text and ``end_id``; a null or empty text is the end id alone. Every id lies in
    one piece, pieces of a sequence follow each other from 0 without gaps and hold at most ``window`` ids. Rows that
    repeat an id are documents of their own, null ids are kept, an empty table gives no pieces. Other columns are not read.
    """
    picked = docs.select(col(docs, id_col).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    code = code_type(vocabulary, end_id)
    encoded = staged(picked.mapInArrow(_encode(ranks, vocabulary, end_id, code), _ENCODED), "encoded", compression="zstd")
    sizes = encoded.select("row", "n", (F.col("n") % window).cast("int").alias("rest"), F.expr(f"n div {window}").alias("whole"), "doc_id")
    # Ranks among all rests in the order of their length, and whole windows before each document in that order.
    ordered = running_sums(sizes.withColumn("one", F.lit(1)), ["rest", "doc_id", "row"], {"index": "one", "whole_before": "whole"})
    ordered = staged(ordered, "ranked")
    counts, wholes = np.zeros(window, np.int64), 0
    for r in ordered.groupBy("rest").agg(F.count("*").alias("c"), F.sum("whole").alias("w")).collect():  # at most one per length
        counts[r["rest"]], wholes = r["c"], wholes + r["w"]
    before = np.cumsum(counts) - counts
    counts[0] = 0
    plan = plan_rests(counts, window)
    spark = docs.sparkSession
    # Both tables are bounded by the window, whatever the corpus.
    starts = spark.createDataFrame([(r, int(before[r])) for r in range(1, window)], "rest int, earlier long")
    places = spark.createDataFrame(plan.rows, PLAN_COLUMNS)
    rank = F.col("index") - F.col("earlier")
    ranked = ordered.filter("rest > 0").join(F.broadcast(starts), "rest").withColumn("rank", rank)
    nth = F.col("rank") - F.col("lo")
    rests = ranked.join(F.broadcast(places), (ranked["rest"] == places["rest"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    rests = rests.select(
        "row",
        (F.col("whole") * window + F.col("first")).alias("start"),
        (F.col("last") - F.col("first")).cast("long").alias("length"),
        F.expr("base + (rank - lo) div each").alias("sequence_id"),
        (F.col("slot") + nth % F.col("each")).alias("slot"),
    )
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    rests = rests.select("row", "start", "length", "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))
    full = ordered.filter("whole > 0").select(
        "row", "whole_before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("i")
    )
    full = full.select(
        "row",
        (F.col("i") * window).alias("start"),
        F.lit(window).cast("long").alias("length"),
        (F.lit(plan.sequences) + F.col("whole_before") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    pieces = rests.unionByName(full).groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    return encoded.join(pieces, "row").select("doc_id", "n", "codes", "pieces").mapInArrow(_cut(checksums, code), _PIECES + (", ids_crc32 long" if checksums else ", ids array<int>"))
