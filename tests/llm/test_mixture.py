import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from tokenloom.llm.mixture import Mixture, drawn, mix


def plain_targets(sizes, plan):
    """Shares by weight, excess over the most handed on until nobody has any. ``sizes`` by source, None last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: plan.weights[i % len(plan.weights)] for i, s in enumerate(names)}
    total, done = Fraction(*plan.share) * sum(sizes.values()), {}
    while len(done) < len(names):
        open_ = [s for s in names if s not in done]
        left, by = total - sum(done.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / by > plan.epochs * sizes[s]]
        if not over:
            return {**done, **{s: left * weight[s] / by for s in open_}}
        done.update({s: Fraction(plan.epochs * sizes[s]) for s in over})
    return done


def plain(rows, plan):
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += n(text)
    targets, out = plain_targets(sizes, plan), []
    for source, target in targets.items():
        budget = int(target)
        own = [(hashlib.md5(f"{plan.seed}|{'' if i is None else i}".encode()).hexdigest(), n(t), i) for i, t, s in rows if s == source]
        whole, rest = divmod(budget, max(1, sizes[source]))
        for _, size, i in sorted(own, key=lambda r: r[:2]):
            part = min(size, rest)
            rest -= part
            out.append((i, size, sizes[source], float(target), whole * size + part))
    return sorted(out, key=repr), targets


def rows_of(n, sources, hot=None):
    rows = [(i, " ".join(["w"] * (i * 7 % 23)), sources[i % len(sources)] if hot is None or i % 3 else hot) for i in range(n)]
    return [*rows, (5000, None, "a"), (5001, " \n", "zero"), (None, "x y", "a")]


@pytest.mark.parametrize(
    "plan, sources, hot",
    [(Mixture(), ["a", "b", "c", None], "b"), (Mixture(), ["é", "z", "Z", "", None], None), (Mixture((1, 3), (2, 1), 2), ["a", "b"], None), (Mixture((1,), (7, 10), 3), ["q"], None)],
)
def test_takes_equal_plain_version(spark, plan, sources, hot):
    rows = rows_of(300, sources, hot)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, mix int")
    want, targets = plain(rows, plan)
    for parts in (1, 7):
        out = mix(docs.repartition(parts), plan)
        assert out.columns == [*docs.columns, "_mix"]
        found = [r._mix for r in out.collect()]
        got = sorted(((r.doc_id, r._mix["size"], r._mix.source_size, r._mix.target, r._mix.taken) for r in out.collect()), key=repr)
        assert got == want and len(found) == len(rows)
    taken = defaultdict(int)
    for r in out.collect():
        taken[r.source] += r._mix.taken
        assert 0 <= r._mix.taken <= plan.epochs * r._mix["size"]
    assert taken == {s: int(t) for s, t in targets.items()}


def test_drawn_rows_hold_the_taken_words(spark):
    rows = rows_of(90, ["a", "b", None])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = Mixture((1, 1, 1), (4, 3), 2)
    taken = {r.doc_id: r.mix.taken for r in mix(docs, plan).collect()}
    got = defaultdict(int)
    turns = defaultdict(list)
    for r in drawn(docs, plan).collect():
        got[r.doc_id] += len(r.text.split())
        turns[r.doc_id].append(r["pass"])
    assert {i: n for i, n in taken.items() if n} == got
    assert all(sorted(t) == list(range(len(t))) for t in turns.values())


def test_equal_rows_many_sources_and_empty_table(spark):
    rows = [(1, "a b c", "s")] * 40 + [(i, "w " * (i % 5), f"s{i % 150}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.mix["size"], r.mix.source_size, r.mix.target, r.mix.taken) for r in mix(docs).collect()), key=repr)
    assert got == plain(rows, Mixture())[0]
    assert mix(docs.limit(0)).collect() == [] and drawn(docs.limit(0)).columns == [*docs.columns, "pass"]
    textless = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.mix.target, r.mix.taken) for r in mix(textless).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]
