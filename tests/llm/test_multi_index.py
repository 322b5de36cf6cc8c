import numpy as np
import pytest

from tokenloom.llm.multi_index import MultiIndex, cells_in_order, exact_nearest, nearest

SMALL = MultiIndex(centroids=6, sample=400, rounds=4, least=1, block=40, query_block=7)


def test_cells_come_by_distance():
    rnd = np.random.default_rng(3)
    left, right, counts = rnd.random(7), rnd.random(5), rnd.integers(0, 4, (7, 5))
    got = cells_in_order(left, right, counts, 10**9)
    want = [c for c in np.argsort((left[:, None] + right[None, :]).ravel(), kind="stable") if counts.ravel()[c]]
    assert got == want
    part = cells_in_order(left, right, counts, 20)
    assert part == want[: len(part)] and counts.ravel()[part].sum() >= 20 > counts.ravel()[part[:-1]].sum()


@pytest.fixture(scope="module")
def table():
    rnd = np.random.default_rng(5)
    v = (rnd.normal(size=(700, 8)) + rnd.normal(size=(5, 8))[rnd.integers(0, 5, 700)] * 2).astype(np.float32)
    v[50:250] = v[50]  # a vector that many rows share
    v[300] = v[301] * 2  # one direction, two lengths
    return v


def frame(spark, v):
    rows = [(i, [float(x) for x in row], "x") for i, row in enumerate(v)]
    odd = [(7000, None, "x"), (7050, [0.0] * 8, "x"), (7100, [float("nan")] * 8, "x"), (7150, [1.0, None] * 4, "x"), (None, [1.0] * 8, "x"), (7200, [1.0], "x"), (7250, [float("inf")] * 8, "x")]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score string").repartition(4)


def test_searching_all_cells_is_exact(spark, table):
    got = nearest(frame(spark, table), index=MultiIndex(**{**SMALL.__dict__, "share": 1.0})).collect()
    want = exact_nearest(table.astype(np.float64), np.arange(len(table)))
    rows = [(q, n + 1, i, s) for q, found in want.items() for n, (i, s) in enumerate(found)]
    assert sorted(tuple(r)[:3] for r in got) == sorted(r[:3] for r in rows)
    exact = {r[:3]: r[3] for r in rows}
    assert all(abs(exact[tuple(r)[:3]] - r.score) < 1e-12 for r in got)


def test_recall_at_the_default(spark, table):
    rnd = np.random.default_rng(6)
    v = rnd.normal(size=(3000, 32)).astype(np.float32)
    got = nearest(frame(spark, v)[["vec_id", "embedding"]]).collect()
    want = exact_nearest(v.astype(np.float64), np.arange(len(v)))
    hits = sum(i in {r.vec_id for r in got if r.query_id == q} for q, found in want.items() for i, _ in found)
    assert hits >= 0.9 * 5 * len(want)


def test_few_and_no_rows(spark, table):
    few = nearest(frame(spark, table[:3]).filter("vec_id < 3")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, 1), (0, 2)]
    assert nearest(frame(spark, table[:3]).limit(0)).collect() == []


def test_finite_vectors_of_any_size(spark):
    rnd = np.random.default_rng(9)
    v = rnd.normal(size=(120, 6))
    sizes = np.array([1.0, 1e200, 1e-200, 1e300, 1e-300])[np.arange(120) % 5]
    table = spark.createDataFrame([(i, (row * s).tolist()) for i, (row, s) in enumerate(zip(v, sizes))], "vec_id long, embedding array<double>")
    got = nearest(table, index=MultiIndex(**{**SMALL.__dict__, "share": 1.0})).collect()
    want = exact_nearest(v, np.arange(120))
    assert {(r.query_id, r.rank): r.vec_id for r in got} == {(q, n + 1): i for q, found in want.items() for n, (i, _) in enumerate(found)}
