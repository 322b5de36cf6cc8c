"""Nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut into two halves, each half is quantised by its own centroids, and a pair of centroids is
a cell. A query walks through the cells by the sum of its squared distances to the two centroids, nearest
first, with a heap over the sorted lists of both halves, until the cells hold the wanted number of vectors.
All vectors of these cells are ranked by their exact cosine.

Equal vectors are one entry with their smallest ids, so a vector that a third of all rows share costs one
comparison. Entries lie in blocks of bounded size along the order of cells, and a block meets the queries that
visit it as two matrices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import col, drop_staged, staged


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of either half, fitted on ``sample`` vectors, and the share of all vectors that a query ranks.

    The share decides the recall: a half finds 0.94 to 0.98 of the true neighbours among vectors that hardly cluster
    (independent components around a few centres); clustered ones need far less. ``least`` vectors are always ranked.
    """

    centroids: int = 64
    sample: int = 20_000
    rounds: int = 12
    share: float = 0.5
    least: int = 1_000
    block: int = 8_192
    query_block: int = 32_768
    seed: int = 1


def _rows_of(lists: pa.ListArray) -> Iterator[np.ndarray | None]:
    """Each vector in its own type, or None if it is null, empty, zero, or has null or non-finite components."""
    lists = lists if pa.types.is_list(lists.type) else lists.cast(pa.list_(lists.type.value_type))
    values = lists.values
    bad = np.zeros(len(values), bool) if values.null_count == 0 else values.is_null().to_numpy(zero_copy_only=False)
    flat = values.fill_null(0).to_numpy(zero_copy_only=False)
    bad |= ~np.isfinite(flat)
    offsets = lists.offsets.to_numpy()
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(lists)):
        lo, hi = offsets[i], offsets[i + 1]
        own = flat[lo:hi]
        usable = valid[i] and not bad[lo:hi].any() and own.any()
        yield np.ascontiguousarray(own) if usable else None


def _vectors(dim: int, top: int):
    """Equal vectors of a task as one row with their smallest ids; held rows are given out when they get many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = {}
        for batch in batches:
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), _rows_of(batch.column("embedding")), strict=True):
                if v is None or vec_id is None or len(v) != dim:
                    continue
                ids = held.setdefault(v.astype(np.float64).tobytes(), [])
                if len(ids) < top or vec_id < ids[-1]:
                    ids.append(vec_id)
                    ids.sort()
                    del ids[top:]
            if len(held) >= 50_000:
                yield _entry_rows(held)
                held = {}
        yield _entry_rows(held)

    return run


def _entry_rows(held: dict[bytes, list[int]]) -> pa.RecordBatch:
    keys = [hashlib.blake2b(v, digest_size=16).digest() for v in held]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.list_(pa.int64()))],
        names=["key", "vector", "ids"],
    )


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that squares neither overflow nor vanish; no digit changes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(-1, keepdims=True))[1])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return vectors / np.sqrt((vectors**2).sum(1))[:, None]


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ centroids.T + (centroids**2).sum(1))


def fit_half(x: np.ndarray, size: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids of a bounded sample by Lloyd's rounds; a centroid without members moves to the farthest vector."""
    rnd = np.random.default_rng(seed)
    centroids = x[rnd.permutation(len(x))[:size]].copy()
    for _ in range(rounds):
        d = _distances(x, centroids)
        nearest = d.argmin(1)
        far = iter(np.argsort(-d[np.arange(len(x)), nearest], kind="stable"))
        for k in range(len(centroids)):
            mine = nearest == k
            centroids[k] = x[mine].mean(0) if mine.any() else x[next(far)]
    return centroids


def cells_in_order(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells by the sum of the two distances, until they hold ``wanted`` vectors. ``counts`` is left by right."""
    by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[by_left].tolist(), right[by_right].tolist()
    by_left, by_right, sizes = by_left.tolist(), by_right.tolist(), counts.tolist()
    width, out, held = len(b), [], 0
    heap, pushed = [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap and held < wanted:
        _, i, j = heappop(heap)
        n = sizes[by_left[i]][by_right[j]]
        if n:
            out.append(by_left[i] * width + by_right[j])
            held += n
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < width and (p, q) not in pushed:
                pushed.add((p, q))
                heappush(heap, (a[p] + b[q], p, q))
    return out


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def _assigned(left: np.ndarray, right: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column("vector").to_pylist()))
                half = x.shape[1] // 2
                cell = _distances(x[:, :half], left).argmin(1) * len(right) + _distances(x[:, half:], right).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

    return run


def _visits(left: np.ndarray, right: np.ndarray, counts: np.ndarray, first_block: np.ndarray, blocks: np.ndarray, wanted: int):
    """For each query and each block that it visits: the query, and the visited cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            if not vectors:
                continue
            x = unit(_matrix(vectors))
            half = x.shape[1] // 2
            to_left, to_right = _distances(x[:, :half], left), _distances(x[:, half:], right)
            for i, (key, part) in enumerate(zip(batch.column("key").to_pylist(), batch.column("part").to_pylist(), strict=True)):
                cells = np.sort(np.array(cells_in_order(to_left[i], to_right[i], counts, wanted), np.int32))
                reach: dict[int, list[int]] = {}
                for cell in cells.tolist():
                    for b in range(first_block[cell], first_block[cell] + blocks[cell]):
                        reach.setdefault(b, []).append(cell)
                n = len(reach)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(reach), pa.int32()),
                        pa.array([part] * n, pa.int32()),
                        pa.array([key] * n, pa.binary()),
                        pa.array([vectors[i]] * n, pa.binary()),
                        pa.array([np.array(c, np.int32).tobytes() for c in reach.values()], pa.binary()),
                    ],
                    names=["block", "part", "key", "vector", "cells"],
                )

    return run


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row in double precision, so that a pair has one score wherever it is computed."""
    query, vectors = _scaled(query), _scaled(vectors)
    return (vectors * query).sum(1) / (np.sqrt((vectors**2).sum(1)) * np.sqrt((query**2).sum()))


def _ranked(top: int):
    """The best ids of a block for each of its queries: all those that can still be among ``top``."""

    def run(_key, queries: pa.Table, entries: pa.Table) -> pa.Table:
        keys, ids, scores = [], [], []
        if queries.num_rows and entries.num_rows:
            v = _matrix(entries.column("vector").to_pylist())
            cell, owned = entries.column("cell").to_numpy(), entries.column("ids").to_pylist()
            u = unit(v)
            for key, q, c in zip(*[queries.column(n).to_pylist() for n in ("key", "vector", "cells")], strict=True):
                seen = np.flatnonzero(np.isin(cell, np.frombuffer(c, np.int32)))
                if not len(seen):
                    continue
                query = np.frombuffer(q, np.float64)
                rough = u[seen] @ (unit(query[None])[0])
                if len(seen) > top:
                    floor = np.partition(rough, len(seen) - top)[len(seen) - top]
                    seen = seen[rough >= floor - 1e-9]
                found = sorted((-s, i) for s, e in zip(cosines(query, v[seen]).tolist(), seen.tolist(), strict=True) for i in owned[e])[:top]
                keys += [key] * len(found)
                scores += [-s for s, _ in found]
                ids += [i for _, i in found]
        return pa.table({"key": pa.array(keys, pa.binary()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})

    return run


def nearest(
    vectors: DataFrame, every: int = 50, top: int = 5, index: MultiIndex = MultiIndex(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its ``top`` nearest other rows.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id or of
    another length than most. Ties go to the smaller id. Rows that repeat an id count as one vector for each of their
    contents. With too few rows a query gets fewer; an empty table gives an empty one. Other columns are not read.
    """
    rows = vectors.select(col(vectors, id_col).cast("long").alias("vec_id"), col(vectors, vector_col).alias("embedding"))
    lengths = rows.filter("embedding IS NOT NULL").groupBy(F.size("embedding").alias("n")).count()
    common = lengths.orderBy(F.desc("count"), "n").limit(1).collect()
    dim = common[0]["n"] if common else 0
    schema, keep = "key binary, vector binary, ids array<long>", top + 1
    groups = rows.mapInArrow(_vectors(dim, keep), schema).groupBy("key")
    # One list of at most `keep` ids per task and vector.
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    entries = staged(groups.agg(F.first("vector").alias("vector"), ids.alias("ids")), "entries")
    total = entries.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], out)
    # A bounded sample (key is a hash of the vector) fits the centroids; every vector is indexed.
    sample = unit(_matrix([r["vector"] for r in entries.select("key", "vector").orderBy("key").limit(index.sample).collect()]))
    half, size = dim // 2, min(index.centroids, len(sample))
    left, right = (fit_half(x, size, index.rounds, index.seed) for x in (sample[:, :half], sample[:, half:]))
    assigned = entries.mapInArrow(_assigned(left, right), f"{schema}, cell int")
    indexed = staged(assigned, "indexed")
    counts = np.zeros(size * size, np.int64)
    for r in indexed.groupBy("cell").count().collect():  # at most one row per pair of centroids
        counts[r["cell"]] = r["count"]
    before = np.cumsum(counts) - counts
    blocks = np.maximum(1, -(-counts // index.block))
    first_block = before // index.block
    # A cell larger than a block has blocks of its own, after all shared ones.
    large, extra = counts > index.block, int(total // index.block) + 1
    first_block[large] = extra + np.cumsum(blocks[large]) - blocks[large]
    wanted = max(index.least, int(np.ceil(index.share * total)))

    queries = rows.filter(F.col("vec_id") % every == 0)
    asked = staged(queries.mapInArrow(_queries(dim), "query_id long, key binary, vector binary"), "queries")
    distinct = asked.groupBy("key").agg(F.first("vector").alias("vector"))
    parts = max(1, -(-asked.count() // index.query_block))
    distinct = distinct.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    visit = _visits(left, right, counts.reshape(size, size), first_block, blocks, wanted)
    # Queries are dealt out evenly: walking the cells is the costly step.
    visits = distinct.repartition("key").mapInArrow(visit, "block int, part int, key binary, vector binary, cells binary")
    places = vectors.sparkSession.createDataFrame(
        [(int(c), int(first_block[c]), int(blocks[c])) for c in np.flatnonzero(counts)], "cell int, first int, blocks int"
    )
    laid = indexed.join(F.broadcast(places), "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        "cell", "vector", "ids",
    )
    met = visits.groupBy("block", "part").cogroup(laid.groupBy("block", "part"))
    found = met.applyInArrow(_ranked(keep), "key binary, vec_id long, score double")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    few = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep).drop("place")
    pairs = asked.select("query_id", "key").distinct().join(few, "key").filter("query_id <> vec_id")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # An id with several contents keeps its best score.
    once = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(mine)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
    result = staged(ranked, "nearest")
    drop_staged(entries, indexed, asked)
    return result


def _queries(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, v.astype(np.float64).tobytes())
                for i, v in zip(batch.column("vec_id").to_pylist(), _rows_of(batch.column("embedding")), strict=True)
                if v is not None and i is not None and len(v) == dim
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in rows], pa.int64()),
                    pa.array([hashlib.blake2b(v, digest_size=16).digest() for _, v in rows], pa.binary()),
                    pa.array([v for _, v in rows], pa.binary()),
                ],
                names=["query_id", "key", "vector"],
            )

    return run


def exact_nearest(vectors: np.ndarray, ids: np.ndarray, every: int = 50, top: int = 5) -> dict[int, list[tuple[int, float]]]:
    """Brute force, for measuring recall on what fits in memory."""
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = cosines(vectors[i], vectors)
        order = sorted((-s, int(j)) for s, j in zip(scores.tolist(), ids.tolist(), strict=True) if j != ids[i])[:top]
        out[int(ids[i])] = [(j, -s) for s, j in order]
    return out
