"""Compression of vectors to one byte per part, with codebooks learnt over all vectors under norm-of-sum bounds.

Components become whole numbers, vectors are cut into parts, and each part position has a codebook of its own, improved
by rounds of assignment and mean. The codebooks of all rounds are kept (they are small), and every vector part
keeps two bounds with the round of each: the distance to its own entry, and the least distance to any other entry. In a
later round an entry has moved by the distance between its place then and its place in the stamped round. That
true net displacement (the norm of the sum of its moves) is never more than the sum of the moves' norms, which
bounds carried along would have to add up. If the one bound plus its entry's displacement stays below the other minus
the largest displacement of the others, the entry is still the nearest and nothing is computed; else the own distance is
computed anew and asked again; only then are all entries scanned.

Bounds only save work: rounding is turned to the safe side, so codes equal those of full scans. Vectors and bounds
are written between rounds, and the sums of the parts of each entry are added up by task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import col, drop_staged, fresh, kept_names, staged

_ROWS = 4096  # rows looked at together


@dataclass(frozen=True)
class Codes:
    """Parts of a vector, entries of a codebook (at most 256), rounds, and what a component of 1 becomes."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@dataclass(frozen=True)
class Compressed:
    """``rows``: the kept columns, ``code`` (an entry number per part) and ``error``; codebooks as [part, entry, component];
    and per round the vector parts looked at, those that the bounds alone settled, and those that one distance settled."""

    rows: DataFrame
    codebooks: np.ndarray
    work: list[tuple[int, int, int]]


def largest(width: int) -> int:
    """The largest whole component for which the error of ``width`` components fits into 63 bits."""
    return min(2**31 - 1, int((2**60 / max(1, width)) ** 0.5))


def _whole(scale: int, dim: int, parts: int, vector: str, keep: list[str], names: list[str]):
    """Rows with usable vectors: the kept columns, the components as bytes (None for another length), and no bounds yet."""
    width, limit = -(-dim // parts) * parts, largest(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(vector)
            values = lists.values.cast(pa.float64())
            missing = values.is_null().to_numpy(zero_copy_only=False)
            flat = values.fill_null(0).to_numpy(zero_copy_only=False)
            bad = np.concatenate([[0], np.cumsum(missing | ~np.isfinite(flat))])
            offsets = lists.offsets.to_numpy()
            good = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
            rows = np.flatnonzero(good)
            fits = np.diff(offsets)[rows] == dim
            whole = np.zeros((int(fits.sum()), width), np.int32)
            at = offsets[:-1][rows[fits]][:, None] + np.arange(dim)
            with np.errstate(over="ignore"):
                whole[:, :dim] = np.clip(np.floor(flat[at] * scale), -limit, limit)
            packed = iter(whole)
            vectors = [next(packed).tobytes() if ok else None for ok in fits.tolist()]
            kept = batch.take(pa.array(rows))
            none = pa.nulls(len(rows), pa.binary())
            yield pa.RecordBatch.from_arrays([*[kept.column(c) for c in keep], pa.array(vectors, pa.binary()), none, pa.nulls(len(rows), pa.binary())], names=names)

    return run


def _moves(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[round, part, entry]: how far each entry is from its place in that round, and the farthest of all other entries."""
    own = np.sqrt(((history - history[-1]).astype(np.float64) ** 2).sum(3)) * (1 + 1e-12)
    others = np.zeros_like(own)
    for e in range(own.shape[2]):
        rest = np.delete(own, e, 2)
        others[:, :, e] = rest.max(2) if rest.shape[2] else 0
    return own, others


BOUNDS = np.dtype([("entry", "u1"), ("own_round", "u1"), ("other_round", "u1"), ("own", "<f4"), ("other", "<f4")])


def assign(x: np.ndarray, state: np.ndarray | None, history: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """New bounds of vectors ``x`` [row, part, component] under the last codebooks, and counts of the three outcomes.

    Gives the state, the exact squared distance where it was computed (-1 elsewhere), and the counts.
    """
    now, (rows, parts, _) = len(history) - 1, x.shape
    out = np.zeros((rows, parts), BOUNDS) if state is None else state.copy()
    squared, counts = np.full((rows, parts), -1, np.int64), np.zeros(3, np.int64)
    counts[0] = rows * parts
    moved, others = _moves(history)
    for p in range(parts):
        book, mine = history[-1, p], x[:, p].astype(np.int64)
        due = np.arange(rows)
        if state is not None:
            s = out[:, p]
            near = s["own"] + moved[s["own_round"], p, s["entry"]]
            far = s["other"] - others[s["other_round"], p, s["entry"]]
            due = np.flatnonzero(~(near < far))
            counts[1] += rows - len(due)
            exact = ((mine[due] - book[s["entry"][due]]) ** 2).sum(1)
            squared[due, p] = exact
            root = np.sqrt(exact.astype(np.float64)) * (1 + 1e-12)
            out["own"][due, p] = np.nextafter(root.astype(np.float32), np.float32(np.inf))
            out["own_round"][due, p] = now
            settled = out["own"][due, p] < far[due]
            counts[2] += int(settled.sum())
            due = due[~settled]
        if not len(due):
            continue
        d = np.stack([((mine[due] - entry) ** 2).sum(1) for entry in book], 1)
        best = d.argmin(1)
        squared[due, p] = d[np.arange(len(due)), best]
        rest = d.copy()
        rest[np.arange(len(due)), best] = np.iinfo(np.int64).max
        second = np.sqrt(rest.min(1).astype(np.float64)) * (1 - 1e-12)
        root = np.sqrt(squared[due, p].astype(np.float64)) * (1 + 1e-12)
        out["entry"][due, p], out["own_round"][due, p], out["other_round"][due, p] = best, now, now
        out["own"][due, p] = np.nextafter(root.astype(np.float32), np.float32(np.inf))
        out["other"][due, p] = np.maximum(0, np.nextafter(second.astype(np.float32), np.float32(-np.inf)))
    return out, squared, counts


def _chunks(batch: pa.RecordBatch, parts: int, vector: str, bounds: str):
    """Runs of rows with a vector: their places, vectors, and bounds (None at first)."""
    usable = np.flatnonzero(batch.column(vector).is_valid().to_numpy(zero_copy_only=False))
    for i in range(0, len(usable), _ROWS):
        rows = usable[i : i + _ROWS]
        held = batch.take(pa.array(rows))
        x = np.frombuffer(b"".join(held.column(vector).to_pylist()), np.int32).reshape(len(rows), parts, -1)
        state = held.column(bounds)
        known = None if state.null_count else np.frombuffer(b"".join(state.to_pylist()), BOUNDS).reshape(len(rows), parts)
        yield rows, x, known


def _round(history: np.ndarray, vector: str, bounds: str, sums: str, names: list[str]):
    """All rows with new bounds, and a row per task with the counts and sums of the parts of each entry, and of the work."""
    parts, entries, width = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, work, last = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64), np.zeros(3, np.int64), None
        for batch in batches:
            last = batch
            new: list[bytes | None] = [None] * batch.num_rows
            for rows, x, known in _chunks(batch, parts, vector, bounds):
                state, _, done = assign(x, known, history)
                work += done
                for p in range(parts):
                    np.add.at(total[p], state["entry"][:, p], x[:, p])
                    count[p] += np.bincount(state["entry"][:, p], minlength=entries)
                for row, s in zip(rows.tolist(), state, strict=True):
                    new[row] = s.tobytes()
            keep = [batch.column(n) for n in names if n not in (bounds, sums)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(new, pa.binary()), pa.nulls(batch.num_rows, pa.binary())], names=names)
        if last is not None:
            every = np.concatenate([work, count.ravel(), total.ravel()]).astype("<i8").tobytes()
            none = [pa.nulls(1, last.schema.field(n).type) for n in names if n not in (bounds, sums)]
            yield pa.RecordBatch.from_arrays([*none, pa.nulls(1, pa.binary()), pa.array([every], pa.binary())], names=names)

    return run


def _numbers(sums: str):
    """Place and value of each number other than 0 of the tasks' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = sum((np.frombuffer(b, "<i8") for b in batch.column(sums).to_pylist()), np.zeros(0, np.int64) if not batch.num_rows else 0)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["place", "value"])

    return run


def _coded(history: np.ndarray, keep: list[str], vector: str, bounds: str, names: list[str]):
    """The kept columns, the final entry of each part, and the exact error, from the last bounds."""
    parts = history.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list[np.ndarray | None] = [None] * batch.num_rows
            errors: list[int | None] = [None] * batch.num_rows
            for rows, x, known in _chunks(batch, parts, vector, bounds):
                state, squared, _ = assign(x, known, history)
                for p in range(parts):
                    open_ = np.flatnonzero(squared[:, p] < 0)
                    squared[open_, p] = ((x[open_, p].astype(np.int64) - history[-1, p][state["entry"][open_, p]]) ** 2).sum(1)
                for row, code, error in zip(rows.tolist(), state["entry"].astype(np.int16), squared.sum(1).tolist(), strict=True):
                    codes[row], errors[row] = code, error
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(codes, pa.list_(pa.int16())), pa.array(errors, pa.int64())], names=names
            )

    return run


def compress(
    vectors: DataFrame, rule: Codes = Codes(), id_col: str = "vec_id", vector_col: str = "embedding", keep: list[str] | None = None
) -> Compressed:
    """A code and an error for every row with a usable vector; other columns than ``keep`` (all but the vector by default)
    are left out.

    Rows whose vector is null or holds null or non-finite components are left out. Component x becomes floor(scale * x);
    whole components beyond +-:func:`largest` (over 2^24 for up to 4,096 components) stop there, so that errors fit a long.
    Vectors as long as most are (ties: the shorter ones) take part; rows of another length stay, with null code and error.
    A length that ``parts`` doesn't divide is filled up with zeros. Codebooks start as the parts of the rows with the
    ``entries`` smallest ids (null ids last, equal ids by their components), fewer if there are fewer rows, and
    equal entries are allowed: the lower number wins all ties. Entries without parts stay as they are. The result doesn't depend on
    the layout of the rows. An empty table gives an empty one with codebooks of no entries.

    The driver holds ``entries`` vectors and the codebooks of every round. New columns are named ``code`` and ``error``, with
    underscores before a name that is taken.
    """
    keep = [c for c in vectors.columns if c != vector_col] if keep is None else keep
    given = vectors.select(*[col(vectors, c) for c in keep])
    code, error, vector, bounds, sums, key = fresh(given, "code", "error", "components", "bounds", "sums", "row_id")
    lengths = vectors.filter(col(vectors, vector_col).isNotNull()).groupBy(F.size(col(vectors, vector_col)).alias("n")).count()
    common = lengths.orderBy(F.desc("count"), "n").limit(1).collect()
    dim = common[0]["n"] if common else 0
    kept_types = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in given.dtypes)
    kept_types += ", " if kept_types else ""
    wide, names = f"{kept_types}`{key}` long, `{vector}` binary, `{bounds}` binary, `{sums}` binary", [*given.columns, key, vector, bounds, sums]
    source = vectors.select(*[col(vectors, c) for c in keep], col(vectors, id_col).cast("long").alias(key), col(vectors, vector_col).alias(vector))
    whole = _whole(rule.scale, dim, rule.parts, vector, [*given.columns, key], names)
    table = staged(source.mapInArrow(whole, wide), "vectors")
    first = table.filter(F.col(vector).isNotNull()).select(key, vector).orderBy(F.col(key).asc_nulls_last(), vector).limit(rule.entries).collect()
    start = [np.frombuffer(r[vector], np.int32).reshape(rule.parts, -1).astype(np.int64) for r in first]
    if not start:
        nothing = table.select(*kept_names(given), F.lit(None).cast("array<smallint>").alias(code), F.lit(None).cast("long").alias(error))
        return Compressed(nothing, np.zeros((rule.parts, 0, -(-dim // rule.parts)), np.int64), [])
    history, work = np.stack(start, 1)[None], []
    shape = history.shape[1:]
    for _ in range(rule.rounds):
        after = staged(table.mapInArrow(_round(history, vector, bounds, sums, names), wide), "bounds")
        drop_staged(table)
        # One row per task, added up where it lies; at most as many rows as numbers in the codebooks reach the driver.
        numbers = after.filter(F.col(sums).isNotNull()).select(sums).mapInArrow(_numbers(sums), "place long, value long")
        flat = np.zeros(3 + shape[0] * shape[1] * (1 + shape[2]), np.int64)
        for r in numbers.groupBy("place").agg(F.sum("value").alias("value")).collect():
            flat[r["place"]] = r["value"]
        work.append(tuple(flat[:3].tolist()))
        count = flat[3 : 3 + shape[0] * shape[1]].reshape(shape[:2])[:, :, None]
        total = flat[3 + shape[0] * shape[1] :].reshape(shape)
        history = np.concatenate([history, np.where(count > 0, total // np.maximum(count, 1), history[-1])[None]])
        table = after.filter(F.col(sums).isNull())
        table.staged_at = after.staged_at
    coded = _coded(history, given.columns, vector, bounds, [*given.columns, code, error])
    out = staged(table.mapInArrow(coded, f"{kept_types}`{code}` array<smallint>, `{error}` long"), "codes")
    drop_staged(table)
    return Compressed(out, history[-1], work)


def restored(codes: np.ndarray, codebooks: np.ndarray, scale: int = 4096) -> np.ndarray:
    """The vectors that codes [row, part] stand for, each component in the middle of its step, with the zeros filled in."""
    picked = np.stack([codebooks[p][codes[:, p]] for p in range(len(codebooks))], 1)
    return ((picked + 0.5) / scale).reshape(len(codes), -1)
