import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import candidates as cd
from tokenloom.operators import scoring as sc


@pytest.fixture
def scores(spark):
    rng = random.Random(4)
    rows = [(g, t, rng.choice([0.0, 0.5, 1.0, 2.0, -1.0, 3.5])) for g in range(12) for t in range(rng.randrange(1, 15))]
    return rows, spark.createDataFrame(rows, "group_id long, token_id int, logit double").repartition(3)


def groups(rows):
    out = defaultdict(list)
    for g, t, x in rows:
        out[g].append((t, x))
    return out


def test_pairs_skip_ignored_labels(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 0], [1, 2, 3, -100]), (2, [7], [7])], "k int, input_ids array<int>, labels array<int>")
    out = sc.next_token_pairs(df, ["k"], labels_col="labels").orderBy("pos").collect()
    assert [(r.k, r.pos, r.prev_id, r.next_id) for r in out] == [(1, 0, 1, 2), (1, 1, 2, 3)]


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_loss_against_plain_counting(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    rng = random.Random(9)
    train = [[rng.randrange(6) for _ in range(20)] for _ in range(5)]
    held = [[rng.randrange(8) for _ in range(9)] for _ in range(4)]
    make = lambda rows: spark.createDataFrame(list(enumerate(rows)), "k int, input_ids array<int>")
    table = sc.bigram_table(sc.next_token_pairs(make(train), ["k"]), 8)
    pair, single = Counter(), Counter()
    for row in train:
        for a, b in zip(row, row[1:]):
            pair[a, b] += 1
            single[a] += 1
    nll = lambda a, b: -math.log((pair[a, b] + 1) / (single[a] + 8))
    losses = sc.perplexity(sc.masked_nll(sc.next_token_pairs(make(held), ["k"]), table, 8, ["k"]))
    for r in losses.collect():
        expected = [nll(a, b) for a, b in zip(held[r.k], held[r.k][1:])]
        assert r.n == 8 and r.nll == pytest.approx(sum(expected) / 8)
        assert r.perplexity == pytest.approx(math.exp(sum(expected) / 8))
    total = sc.total_loss(losses).first()
    overall = sc.masked_nll(sc.next_token_pairs(make(held), ["k"]), table, 8).first()
    assert total.n == overall.n == 32 and total.nll == pytest.approx(overall.nll)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_levels_of_losses_from_one_lookup(spark):
    rng = random.Random(3)
    rows = [(s, h, b, [rng.randrange(6) for _ in range(rng.randrange(2, 9))]) for s in ("train", "val", None) for h in (0, 1) for b in range(3)]
    pairs = sc.next_token_pairs(spark.createDataFrame(rows, "split string, shard int, batch_id long, input_ids array<int>"), ["split", "shard", "batch_id"])
    table = sc.bigram_table(pairs.filter("split = 'train'"), 8)
    out = sc.loss_levels(pairs, table, 8)
    got = {(r.level, r.split, r.shard, r.batch_id): (r.n, r.nll, r.perplexity) for r in out.collect()}
    assert len(got) == 18 + 3 + 1
    for level, by in ((0, ["split", "shard", "batch_id"]), (3, ["split"]), (7, [])):
        for r in sc.perplexity(sc.masked_nll(pairs, table, 8, by)).collect():
            key = (level, *[r[c] if c in by else None for c in ("split", "shard", "batch_id")])
            assert got[key] == (r.n, pytest.approx(r.nll), pytest.approx(r.perplexity))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # One look-up of pairs and one of unseen scores for all levels.
    assert plan.count("Join LeftOuter") == 2 and plan.count("Expand") == 1


def test_perplexity_is_capped_and_bad_losses_raise(spark):
    df = spark.createDataFrame([(1, 50.0), (1, 1.0)], "n long, nll double")
    assert sorted(r.perplexity for r in sc.perplexity(df).collect()) == [pytest.approx(math.e), pytest.approx(math.exp(20))]
    sc.require_finite(df)
    bad = spark.createDataFrame([(1, float("nan")), (1, float("inf")), (1, 2.0)], "n long, nll double")
    assert sc.finite_loss_check(bad).first().non_finite == 2
    with pytest.raises(FloatingPointError):
        sc.require_finite(bad)


def test_softmax(scores):
    rows, df = scores
    out = {(r.group_id, r.token_id): r.prob for r in cd.softmax_temperature(df, 0.7).collect()}
    for g, items in groups(rows).items():
        total = sum(math.exp(x / 0.7) for _, x in items)
        for t, x in items:
            assert out[g, t] == pytest.approx(math.exp(x / 0.7) / total)
    with pytest.raises(ValueError):
        cd.softmax_temperature(df, 0.0)


@pytest.mark.parametrize("k", [0, 1, 3, 50])
def test_topk_keeps_ties(scores, k):
    rows, df = scores
    out = {(r.group_id, r.token_id) for r in cd.topk_candidates(df, k).collect()}
    expected = set()
    for g, items in groups(rows).items():
        cut = sorted((x for _, x in items), reverse=True)[: k or len(items)][-1]
        expected |= {(g, t) for t, x in items if x >= cut}
    assert out == expected


@pytest.mark.parametrize("p", [0.0, 0.3, 0.9, 1.0])
def test_nucleus(scores, p):
    rows, df = scores
    out = {(r.group_id, r.token_id) for r in cd.nucleus_candidates(df, p).collect()}
    expected = set()
    for g, items in groups(rows).items():
        total, before = sum(math.exp(x) for _, x in items), 0.0
        for i, (t, x) in enumerate(sorted(items, key=lambda tx: (-tx[1], tx[0]))):
            if p >= 1 or i == 0 or before <= p:
                expected.add((g, t))
            before += math.exp(x) / total
    assert out == expected


def test_nucleus_keeps_what_follows_a_sum_of_exactly_p(spark):
    tied = [[5, 4, 1], [7, 2, 1], [16, 11, 3], [21, 6, 3]]
    rows = [(g, t, math.log(n)) for g, counts in enumerate(tied) for t, n in enumerate(counts)]
    rows += [(1000, t, math.log(n)) for t, n in enumerate([900_001, 99_999])]
    df = spark.createDataFrame(rows, "group_id long, token_id int, logit double")
    kept = Counter(r.group_id for r in cd.nucleus_candidates(df, 0.9).collect())
    assert [kept[g] for g in range(len(tied))] == [3, 3, 3, 3]
    assert kept[1000] == 1


def test_greedy(scores):
    rows, df = scores
    out = {r.group_id: r.token_id for r in cd.greedy_candidate(df).collect()}
    assert out == {g: min(items, key=lambda tx: (-tx[1], tx[0]))[0] for g, items in groups(rows).items()}


def test_sampling_follows_the_softmax(spark):
    df = spark.createDataFrame([(0, t, x) for t, x in enumerate([0.0, 1.0, 2.0])], "group_id long, token_id int, logit double")
    copies = cd.fan_out_sequences(df, 4000)
    drawn = cd.sample_candidates(copies, seed=3, by=["group_id", "copy"])
    share = {r.token_id: r.n / 4000 for r in drawn.groupBy("token_id").agg(F.count("*").alias("n")).collect()}
    total = sum(math.exp(x) for x in (0, 1, 2))
    for t, x in enumerate((0, 1, 2)):
        assert share[t] == pytest.approx(math.exp(x) / total, abs=0.03)
    again = cd.sample_candidates(copies.repartition(5), seed=3, by=["group_id", "copy"])
    assert drawn.exceptAll(again).count() == 0


def test_repetition(spark):
    rng = random.Random(6)
    rows = [[rng.randrange(3) for _ in range(rng.randrange(0, 40))] for _ in range(50)] + [[1] * 30, [1, 2, 3]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "k int, input_ids array<int>")
    got = {(r.k, tuple(r.ngram)): r.n for r in cd.repeated_ngrams(df, ["k"]).collect()}
    expected = {}
    for k, ids in enumerate(rows):
        for gram, n in Counter(tuple(ids[i : i + 4]) for i in range(len(ids) - 3)).items():
            if n > 1:
                expected[k, gram] = n
    assert got == expected
    tokens = {(r.k, r.token_id): r.n for r in cd.token_repetition(df, ["k"]).collect()}
    assert tokens == {(k, t): n for k, ids in enumerate(rows) for t, n in Counter(ids).items()}
    plan = cd.token_repetition(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    shares = {r.k: r.repeated_share for r in cd.repetition_share(df, ["k"]).collect()}
    assert shares == {k: pytest.approx(1 - len(set(ids)) / len(ids)) for k, ids in enumerate(rows) if ids}


def test_predictions_are_scored_where_they_lie(spark):
    rng = random.Random(5)
    rows = [(k, [rng.randrange(8) for _ in range(30)]) for k in range(20)]
    pairs = sc.next_token_pairs(spark.createDataFrame(rows, "k int, input_ids array<int>"), ["k"])
    table = spark.createDataFrame([(a, b, 2, -0.1 * (a + b + 1)) for a in range(6) for b in range(5)], "prev_id int, next_id int, n long, log_prob double")
    small = sc.masked_nll(pairs, table, 8, ["k"])
    # A vocabulary whose score table may be too large to broadcast counts equal pairs of a group first, with the same result.
    large = sc.masked_nll(pairs, table, 5000, ["k"])
    got = {r.k: (r.n, r.nll) for r in small.collect()}
    size = {a: math.log(10 + 8) for a in range(6)}
    score = lambda a, b: 0.1 * (a + b + 1) if a < 6 and b < 5 else size.get(a, math.log(8))
    for k, ids in rows:
        want = [score(a, b) for a, b in zip(ids, ids[1:])]
        assert got[k] == (29, pytest.approx(sum(want) / 29))
    size = {a: math.log(10 + 5000) for a in range(6)}
    score = lambda a, b: 0.1 * (a + b + 1) if a < 6 and b < 5 else size.get(a, math.log(5000))
    for r in large.collect():
        ids = dict(rows)[r.k]
        assert r.nll == pytest.approx(sum(score(a, b) for a, b in zip(ids, ids[1:])) / 29)
    dealt = [re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString()) for df in (small, large)]
    assert not any("next_id" in d for d in dealt[0]) and any("next_id" in d for d in dealt[1])


def test_sums_of_samples_are_brought_to_their_groups(spark):
    """With the place of each sample given, groups come out as if the samples themselves had been moved; no token moves."""
    rng = random.Random(8)
    rows = [(s, h, b, b // 3, [rng.randrange(6) for _ in range(rng.randrange(2, 9))]) for s in ("train", "val", None) for h in (0, 1) for b in range(8)]
    samples = spark.createDataFrame(rows, "split string, shard int, block long, batch_id long, input_ids array<int>").repartition(4)
    by, name = ["split", "shard", "batch_id"], ["split", "shard", "block"]
    table = sc.bigram_table(sc.next_token_pairs(samples, []), 8)
    table = spark.createDataFrame(table.collect(), table.schema)
    placed = samples.select(*name, "batch_id").filter("block < 7")
    pairs = sc.next_token_pairs(samples, name)
    got = sc.loss_levels(pairs, table, 8, by, placed=placed)
    moved = sc.loss_levels(sc.next_token_pairs(samples.filter("block < 7"), by), table, 8, by)
    key = lambda r: (r.level, r.split, r.shard, r.batch_id)
    want = {key(r): (r.n, pytest.approx(r.nll), pytest.approx(r.perplexity)) for r in moved.collect()}
    assert {key(r): (r.n, r.nll, r.perplexity) for r in got.collect()} == want and len(want) == 18 + 3 + 1
    losses = sc.masked_nll(pairs, table, 8, by, placed)
    assert {(r.split, r.shard, r.batch_id): (r.n, r.nll) for r in losses.collect()} == {k[1:]: v[:2] for k, v in want.items() if k[0] == 0}
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", got._jdf.queryExecution().executedPlan().toString())
    assert dealt and not any("next_id" in d for d in dealt)
