import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm.periodic_runs import Repeats, SuffixArray, find_runs, last_before, runs_of, with_strongest


def plain(words, rule):
    """Every period, every stretch of words that it fits; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(rule.least, rule.exponent * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4), st.integers(1, 12), st.integers(2, 3))
@settings(max_examples=150, deadline=None)
def test_runs_equal_brute_force(rows, least, exponent):
    rule = Repeats(least, exponent)
    firsts = np.cumsum([0, *map(len, rows)])
    got = [(int(s), int(e - s), int(q)) for s, e, q in runs_of(np.array([w for r in rows for w in r], np.uint64), firsts, rule)]
    want = [(int(f) + s, n, q) for r, f in zip(rows, firsts) for s, n, q in plain(r, rule)]
    assert sorted(got) == sorted(want)


def test_suffix_array_and_lcp():
    rnd = np.random.default_rng(4)
    for _ in range(30):
        sizes = rnd.integers(0, 30, 3)
        firsts, words = np.cumsum([0, *sizes]), rnd.integers(0, 3, sizes.sum()).astype(np.uint64)
        array = SuffixArray(words, firsts)
        rows = [(r, words[i : firsts[r + 1]].tolist(), i) for r in range(3) for i in range(firsts[r], firsts[r + 1])]
        assert [i for _, _, i in sorted(rows)] == array.order.tolist()
        for k in range(1, len(words)):
            (r, a, _), (s, b, _) = sorted(rows)[k - 1], sorted(rows)[k]
            same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert array.lcp[k] == (same if r == s else 0)
        v = rnd.integers(0, 5, 50)
        for equal in (False, True):
            got = last_before(v, np.arange(50), equal)
            assert got.tolist() == [max((j for j in range(i) if v[j] < v[i] + equal), default=-1) for i in range(50)]


def test_table_with_nulls_long_texts_and_clashing_names(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a\x85b " * 30), (None, "x  y " * 20), (5, "x  y " * 20), (5, "x  y " * 20)]
    for i in range(60):
        text = [rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            at, size = rnd.randint(0, len(text)), rnd.randint(1, 15)
            text[at:at] = [rnd.choice(words) for _ in range(size)] * rnd.randint(2, 6) + text[at : at + 2]
        rows.append((100 + i, "\t".join(text)))
    big = [rnd.choice(words) for _ in range(200_000)]
    big[1000:1000] = ["a", "b"] * 40_000 + ["a"]
    rows.append((999, " ".join(big)))
    docs = spark.createDataFrame([(i, t, "p", "q") for i, t in rows], "doc_id long, text string, periodic string, text_of_row string")
    out = find_runs(docs.repartition(3))
    assert out.columns == [*docs.columns, "_periodic"]
    got = sorted(((r.doc_id, r.text, [tuple(x) for x in r._periodic.runs], r._periodic.collapsed, r._periodic.n_words) for r in out.collect()), key=repr)
    want = []
    for i, t in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = [(1000, 80_001, 2)] if i == 999 else plain(own, Repeats())
        want.append((i, t, runs, collapsed(own, runs), len(own)))
    assert got == sorted(want, key=repr)
    assert find_runs(docs.limit(0)).collect() == []
    assert find_runs(docs, keep=["doc_id"]).columns == ["doc_id", "_periodic"]


@pytest.mark.parametrize(
    "runs, best",
    [([(0, 30, 10), (5, 9, 3), (40, 24, 8)], (0, 30, 10)), ([(0, 30, 10), (50, 31, 10)], (50, 31, 10)), ([], None), ([(3, 48, 12), (3, 24, 6)], (3, 24, 6))],
)
def test_strongest(spark, runs, best):
    rows = spark.createDataFrame([(runs, 1)], "runs array<struct<start: long, length: long, period: long>>, strongest int")
    got = with_strongest(rows, "runs").first()["_strongest"]
    assert (None if got is None else tuple(got)) == best
