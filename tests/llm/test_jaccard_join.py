import random
import re

import pytest
from pyspark.sql import functions as F

from tokenloom.llm.components import components
from tokenloom.llm.jaccard_join import jaccard_components, one_of_each


def plain(rows):
    """Brute force over all pairs of texts; ids that repeat are one document."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    name = {d: d for d, _ in rows if d is not None}
    while True:
        before = dict(name)
        for (d, _), a in zip(rows, sets):
            for (e, _), b in zip(rows, sets):
                if None not in (d, e) and (d == e or (a and b and 100 * len(a & b) >= 80 * len(a | b))):
                    name[d] = name[e] = min(name[d], name[e])
        if name == before:
            return sorted(((d, len(s), name.get(d)) for (d, _), s in zip(rows, sets)), key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(30))
    rows = [(900, None), (901, ""), (902, " \n "), (903, "a b"), (904, "A  b"), (905, "a b c"), (None, "a b"), (906, "one two three four five")]
    rows += [(907, "a b c"), (907, "one two three four five")]  # one id with two texts
    for i in range(60):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, 60))]
        rows.append((i * 10, " ".join(words) + (" " + passage if i % 3 == 0 else "")))
        for c in range(rnd.randint(0, 4)):
            near = rows[-1 if rnd.random() < 0.5 else 10].__getitem__(1).split()
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(near))
                near[at : at + rnd.randint(0, 2)] = [rnd.choice(vocabulary)]
            rows.append((i * 10 + c + 1, " ".join(near)))
    base = [f"x{i}" for i in range(80)]
    for i in range(40):  # a large group of near copies, some of them not near enough
        near = base[:]
        for _ in range(rnd.randint(0, 6)):
            near[rnd.randrange(80)] = f"y{rnd.randrange(10_000)}"
        rows.append((2000 + i, " ".join(near)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n int").repartition(3)
    got = [tuple(r) for r in jaccard_components(docs).collect()]
    assert sorted(got, key=repr) == plain(rows)
    if seed == 1:
        kept = one_of_each(docs)
        assert kept.columns == docs.columns
        name = {d: c for d, _, c in plain(rows)}
        assert {r.doc_id for r in kept.collect()} == {d for d in name if d is None or name[d] == d}


def test_empty_and_textless(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(empty).collect() == []
    alone = spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard_components(alone).collect()) == [(1, 0, 1), (2, 0, 2)]


def test_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(159, 200), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0
