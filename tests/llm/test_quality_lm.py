import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tokenloom.llm.quality_lm import PerplexityRule, _held_out, classified, keep_fluent

RULE = PerplexityRule(order=3, fold=3, least=5, quantile=0.9, slack=1.2, block_bytes=3000)


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney by dictionaries; returns the probability of a byte after a context."""
    grams = Counter()
    for t in texts:
        b = bytes([1]) * (order - 1) + t.encode()
        grams.update(b[i : i + order] for i in range(len(b) - order + 1))
    levels = [grams]
    for _ in range(order - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))
    levels.reverse()
    tables = []
    for counts in levels:
        seen = Counter(counts.values())
        if seen[1] and seen[2]:
            y = seen[1] / (seen[1] + 2 * seen[2])
            d = [min(max(k - (k + 1) * y * seen[k + 1] / seen[k], 0.01), k) if seen[k] else k / 2 for k in (1, 2, 3)]
        else:
            d = [0.5] * 3
        total, saved = defaultdict(int), defaultdict(float)
        for g, c in counts.items():
            total[g[:-1]] += c
            saved[g[:-1]] += d[min(c, 3) - 1]
        tables.append((counts, d, total, saved))

    def p(gram):
        value = 1 / 256
        for k, (counts, d, total, saved) in enumerate(tables, 1):
            g = gram[-k:]
            c, t = counts.get(g, 0), total.get(g[:-1], 0)
            if t:
                value = (c - d[min(c, 3) - 1] if c else 0) / t + saved[g[:-1]] / t * value
        return value

    def perplexity(text):
        b = bytes([1]) * (order - 1) + text.encode()
        n = len(b) - order + 1
        return math.exp(-sum(math.log(p(b[i : i + order])) for i in range(n)) / n)

    return perplexity, p


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(1)
    syllables = {"en": ["the", "an", "re", "ing", "st"], "fr": ["é", "le", "ou", "ç", "an"]}
    rows = []
    for i in range(160):
        lang = "fr" if i % 4 == 0 else "en"
        words = ["".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(5, 60))]
        rows.append((i, " ".join(words), lang))
    rows += [(500, None, "en"), (501, "", "fr"), (502, "Q#9!x " * 30, "en"), (503, "the an", None), (504, "zz", "xx"), (None, "the an re", "en"), (0, rows[0][1], "en")]
    labels = [(i, 1, 0) for i in range(120)] + [(130, 1, 1), (131, 0, 0), (5, 0, 0), (None, 1, 0)]
    return rows, labels


def test_perplexities_equal_brute_force(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = classified(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), RULE).collect()
    ids = np.array([i for i in range(120) if i != 5])
    held = set(ids[_held_out(ids, RULE.fold)].tolist())
    assert 10 < len(held) < 80
    train = set(ids.tolist()) - held
    perplexity, p = plain_model([t for i, t, _ in rows if i in train], RULE.order)
    assert abs(sum(p(b"th" + bytes([x])) for x in range(256)) - 1) < 1e-9
    texts = {(i, lang): t for i, t, lang in rows}
    assert len(got) == len(rows)
    for r in got:
        t = texts[r.doc_id, r.lang] or ""
        assert (r.n_bytes, r.perplexity is None) == (len(t.encode()), not t)
        if t:
            assert abs(r.perplexity - perplexity(t)) < 1e-4 * r.perplexity
            assert r.kept == (r.perplexity <= r.threshold)
        else:
            assert not r.kept
    by_id = {r.doc_id: r for r in got}
    assert not by_id[502].kept and by_id[503].threshold == by_id[504].threshold and by_id[1].threshold != by_id[4].threshold
    for lang in ("en", "fr"):
        own = sorted(perplexity(t) for i, t, x in rows if i in held and x == lang)
        assert abs(by_id[1 if lang == "en" else 4].threshold - 1.2 * own[math.ceil(0.9 * len(own)) - 1]) < 1e-3


def test_kept_rows(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, mark int")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = keep_fluent(docs, labels, RULE)
    want = sorted(r.doc_id or -1 for r in classified(docs, labels, RULE).collect() if r.kept)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == want
    assert classified(docs.limit(0), labels, RULE).collect() == []


def test_without_trusted_documents(spark, corpus):
    rows, _ = corpus
    docs = spark.createDataFrame(rows[:5], "doc_id long, text string, lang string")
    got = classified(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), RULE).collect()
    assert all(abs(r.perplexity - 256) < 1e-2 and r.kept and r.threshold is None for r in got)


def test_default_threshold_decides(spark):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice(["the", "an", "re", "ing", "st", "ou"]) for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    rows = [(i, " ".join(rnd.choice(vocabulary) for _ in range(80)), "en") for i in range(400)]
    for i in range(1000, 1020):  # every sixteenth word backwards
        rows.append((i, " ".join(w[::-1] if k % 16 == 0 else w for k, w in enumerate(rnd.choice(vocabulary) for _ in range(80))), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in classified(docs, labels).collect()}
    held = sorted(got[i].perplexity for i in range(400) if _held_out(np.array([i]), 5)[0])
    assert len(held) >= 30 and abs(got[0].threshold - held[math.ceil(PerplexityRule().quantile * len(held)) - 1]) < 1e-9
    assert all(got[i].perplexity < 1.5 * held[-1] and not got[i].kept for i in range(1000, 1020))
    assert sum(got[i].kept for i in range(400)) > 0.9 * 400


def test_small_language_has_its_own_median(spark):
    rnd = random.Random(6)

    def prose(letters, size, n):
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 6))) for _ in range(size)]
        return [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(n)]

    large, small = prose("abcdefg", 40, 900), prose("nopqrstu", 90, 60)
    rows = [(i, t, "en") for i, t in enumerate(large)] + [(1000 + i, t, "es") for i, t in enumerate(small)]
    labels = [(i, 1, 0) for i in range(900)] + [(1000 + i, 1, 0) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rule = PerplexityRule(order=3)
    got = {r.doc_id: r for r in classified(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rule).collect()}
    held = {lang: sorted(got[i].perplexity for i, _, _ in labels if got[i].lang == lang and _held_out(np.array([i]), rule.fold)[0]) for lang in ("en", "es")}
    assert len(held["en"]) >= rule.least > len(held["es"]) > 0

    def at(values, q):
        return sorted(values)[math.ceil(q * len(values)) - 1]

    n, middle = len(held["es"]), {k: at(v, 0.5) for k, v in held.items()}
    ratio = at([x / middle[k] for k, v in held.items() for x in v], rule.quantile)
    want = n / rule.least * at(held["es"], rule.quantile) + (1 - n / rule.least) * middle["es"] * ratio
    assert abs(got[1000].threshold - want) < 1e-9 and abs(got[0].threshold - at(held["en"], rule.quantile)) < 1e-9
    overall = at(held["en"] + held["es"], rule.quantile)
    clean = [got[1000 + i] for i in range(25, 60)]
    assert sum(r.kept for r in clean) > 0.8 * len(clean) > sum(r.perplexity <= overall for r in clean)
