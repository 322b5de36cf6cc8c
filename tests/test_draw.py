import hashlib
import math
import random

import pytest

from tokenloom.operators.inference import DrawConfig, next_token_draw

CONFIGS = {
    "off": DrawConfig(seed=3),
    "greedy": DrawConfig(repetition_penalty=1.3, temperature=0),
    "all": DrawConfig(1.2, 3, 0.7, 4, 0.8, 5),
    "bigrams": DrawConfig(no_repeat_ngram=2, top_k=3),
    "nucleus": DrawConfig(top_p=0.5),
    "top one": DrawConfig(top_k=1, temperature=2.0),
    "unigrams": DrawConfig(no_repeat_ngram=1),
}


def plainly(k, ids, logits, cfg):
    """Tokens that survive each step, as dictionaries, and the draw by the same noise."""
    x = {t: v / cfg.repetition_penalty ** ids.count(t) for t, v in enumerate(logits)}
    if n := cfg.no_repeat_ngram:
        held = {tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)}
        x = {t: v for t, v in x.items() if (*ids[len(ids) - n + 1 :], t) not in held}
    if not x:
        return max(range(len(logits)), key=lambda t: (logits[t], -t)), 0.0
    x = {t: v / (cfg.temperature or 1) for t, v in x.items()}
    if 0 < cfg.top_k < len(logits):
        # Banned tokens count as the smallest.
        floor = sorted([*x.values(), *[-math.inf] * (len(logits) - len(x))])[-cfg.top_k]
        x = {t: v for t, v in x.items() if v >= floor}
    ranked = sorted(x, key=lambda t: (-x[t], t))
    if cfg.top_p < 1:
        total, before, kept = sum(math.exp(v) for v in x.values()), 0.0, []
        for t in ranked:
            if kept and before > cfg.top_p * total:
                break
            kept.append(t)
            before += math.exp(x[t])
        ranked = kept
    if cfg.temperature == 0:
        return ranked[0], x[ranked[0]]

    def noisy(t):
        u = (int(hashlib.md5(f"{cfg.seed}:{k}:{t}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return x[t] - math.log(-math.log(u))

    best = max(ranked, key=noisy)
    return best, x[best]


@pytest.mark.parametrize("name", CONFIGS)
def test_draw_equals_the_plain_steps(spark, name):
    rng, cfg = random.Random(name), CONFIGS[name]
    rows = [(k, [rng.randrange(6) for _ in range(rng.randrange(0, 14))], [float(rng.randrange(-9, 9)) / 2 for _ in range(6)]) for k in range(60)]
    rows += [(60, [0, 1, 2, 3, 4, 5], [1.0] * 6), (61, [9, 9], [0.5, 0.25]), (62, [1], [])]
    df = spark.createDataFrame(rows, "k int, input_ids array<int>, logits array<double>")
    out = next_token_draw(df, ("k",), cfg)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.k: (r.token_id, r.logit) for r in out.collect()}
    for k, ids, logits in rows:
        if not logits:
            assert got[k] == (None, None)
            continue
        token, logit = plainly(k, ids, logits, cfg)
        assert got[k] == (token, pytest.approx(logit)), (k, ids, logits)
