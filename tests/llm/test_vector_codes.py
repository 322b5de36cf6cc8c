import math

import numpy as np
import pytest

from tokenloom.llm.vector_codes import Codes, assign, compress, largest, restored


def plain(rows, rule):
    """Full scans in Python's whole numbers; rows of equal length that ``parts`` divides."""
    good = [(i, [math.floor(rule.scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(good[0][1]) // rule.parts if good else 0
    cut = [(i, [v[p * width : (p + 1) * width] for p in range(rule.parts)]) for i, v in good]
    seeds = sorted(cut, key=lambda r: (r[0] is None, r[0], [x for p in r[1] for x in p]))[: rule.entries]
    books = [[v[p] for _, v in seeds] for p in range(rule.parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rule.rounds):
        for p in range(rule.parts):
            held = [[] for _ in books[p]]
            for _, v in cut:
                held[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(h) for c in zip(*h)] if h else e for h, e in zip(held, books[p])]
    out = []
    for i, v in cut:
        found = [nearest(v[p], books[p]) for p in range(rule.parts)]
        out.append((i, [k for _, k in found], sum(d for d, _ in found)))
    return out, books


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("rule", [Codes(), Codes(parts=3, entries=4, rounds=9, scale=16), Codes(parts=2, entries=1, rounds=2)])
def test_codes_equal_full_scans(spark, rule):
    rnd = np.random.default_rng(rule.parts)
    v = (rnd.normal(size=(400, 24)) / 5 + rnd.normal(size=(6, 24))[rnd.integers(0, 6, 400)]).astype(np.float32)
    v[100:250] = v[100]  # a vector that many rows share
    rows = [(i if i % 90 else None, [float(x) for x in row]) for i, row in enumerate(v)] + [(7, [0.0] * 24), (7, [0.0] * 24)]
    odd = [(900, None), (901, [float("nan")] * 24), (902, [None] + [1.0] * 23), (903, [math.inf] * 24)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    want, books = plain(rows, rule)
    done = compress(table.repartition(5), rule)
    again = compress(table.repartition(2), rule)
    got = ordered((r.vec_id, r.code, r.error) for r in done.rows.collect())
    assert got == ordered(want) == ordered((r.vec_id, r.code, r.error) for r in again.rows.collect())
    assert done.codebooks.tolist() == books
    assert len(done.work) == rule.rounds and all(looked == 402 * rule.parts for looked, _, _ in done.work)
    if rule.entries > 1:
        settled = sum(a + b for _, a, b in done.work[1:])
        assert settled > 0.3 * sum(n for n, _, _ in done.work[1:])  # bounds do spare scans


def test_bounds_hold_with_ties_and_moving_entries():
    rnd = np.random.default_rng(2)
    x = rnd.integers(-3, 4, (300, 2, 2)).astype(np.int32)  # many equal distances
    history, state = rnd.integers(-3, 4, (1, 2, 5, 2)), None
    for _ in range(12):
        state, squared, _ = assign(x, state, history)
        for p in range(2):
            d = ((x[:, p, None, :] - history[-1, p][None]) ** 2).sum(2)
            assert (state["entry"][:, p] == d.argmin(1)).all()
            known = squared[:, p] >= 0
            assert (squared[known, p] == d.min(1)[known]).all()
        history = np.concatenate([history, history[-1:] + rnd.integers(-1, 2, (1, 2, 5, 2))])


def test_net_displacement_is_tighter_than_added_drifts():
    """An entry that goes away and comes back has not moved: no scan is needed, though its drifts add up."""
    x = np.array([[[0, 0]]] * 3, np.int32)
    home = np.array([[[[1, 0], [9, 0]]]])
    state, _, counts = assign(x, None, home)
    away = np.concatenate([home, home + [[[[0, 0], [-7, 0]]]], home])
    state, _, counts = assign(x, state, away)
    assert counts.tolist() == [3, 3, 0] and (state["other_round"] == 0).all()


def test_other_lengths_nulls_names_and_large_values(spark):
    rows = [(i, [float(i), 1.0, 2.0], "x") for i in range(5)] + [(9, [1.0], "y"), (10, [], None), (None, [1e300, -1e300, 0.0], "z")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string")
    done = compress(table, Codes(parts=2, entries=2, rounds=2))
    assert done.rows.columns == ["vec_id", "code", "_code", "error"]
    got = {(r.vec_id, r.code): (r._code, r.error) for r in done.rows.collect()}
    assert len(got) == 8 and got[(9, "y")] == got[(10, None)] == (None, None)
    assert len(got[(None, "z")][0]) == 2 and 0 <= got[(None, "z")][1] < 2**63
    assert done.codebooks.shape == (2, 2, 2) and abs(done.codebooks).max() <= largest(3)
    back = restored(np.array([[0, 1]]), done.codebooks)
    assert back.shape == (1, 4)
    none = compress(table.limit(0))
    assert none.rows.collect() == [] and none.rows.columns == done.rows.columns and none.codebooks.size == 0
    few = compress(table.filter("vec_id < 3"), Codes(parts=1))
    assert sorted((r.vec_id, r._code, r.error) for r in few.rows.collect()) == [(i, [i], 0) for i in range(3)]
