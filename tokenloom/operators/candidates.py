"""Operators on stored scores ``(group_id, token_id, logit)``: what sampling does to a model's output.

A group holds each token at most once, so its windows hold at most ``vocab_size`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import with_computed
from tokenloom.functions.tokens import uniform_hash

# Sums of probabilities that are equal as numbers differ by less than this after rounding.
_ROUNDING = 1e-10


def _ranked(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy(F.desc("logit"), "token_id")


def softmax_temperature(scores: DataFrame, temperature: float = 1.0, by: Sequence[str] = ("group_id",)) -> DataFrame:
    """Add ``prob = softmax(logit / T)`` within the group; the maximum is subtracted first."""
    if temperature <= 0:
        raise ValueError("softmax needs a temperature above 0; use greedy_candidate for 0")
    scaled = scores.withColumn("_x", F.col("logit") / temperature)
    weighed = scaled.withColumn("_e", F.exp(F.col("_x") - F.max("_x").over(Window.partitionBy(*by))))
    return weighed.withColumn("prob", F.col("_e") / F.sum("_e").over(Window.partitionBy(*by))).drop("_x", "_e")


def topk_candidates(scores: DataFrame, k: int, by: Sequence[str] = ("group_id",)) -> DataFrame:
    """Keep logits not below the k-th largest. Ties at the cut stay; ``k <= 0`` keeps all."""
    if k <= 0:
        return scores
    rank = F.rank().over(Window.partitionBy(*by).orderBy(F.desc("logit")))
    return scores.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def nucleus_candidates(scores: DataFrame, p: float, by: Sequence[str] = ("group_id",)) -> DataFrame:
    """Keep the likeliest tokens while the probability before them is at most ``p``; ``p >= 1`` keeps all.

    The token that crosses ``p`` and the top token always stay. Equal logits rank by token id. A sum within 1e-10 of ``p``
    counts as ``p``: counts of 5, 4 and 1 sum to 0.9 before the last one, however the doubles are rounded.
    """
    if p >= 1:
        return scores
    before = F.sum("prob").over(_ranked(by).rowsBetween(Window.unboundedPreceding, -1))
    ranked = softmax_temperature(scores, 1.0, by).withColumn("_before", F.coalesce(before, F.lit(0.0)))
    top = F.row_number().over(_ranked(by)) == 1
    return ranked.withColumn("_top", top).filter(F.col("_top") | (F.col("_before") <= p + _ROUNDING)).drop("_before", "_top", "prob")


def greedy_candidate(scores: DataFrame, by: Sequence[str] = ("group_id",)) -> DataFrame:
    """The largest logit of each group, the lowest token id among equals, by one aggregate with map-side combining."""
    best = F.max_by(F.struct("token_id", "logit"), F.struct(F.col("logit"), -F.col("token_id")))
    return scores.groupBy(*by).agg(best.alias("best")).select(*by, "best.token_id", "best.logit")


def sample_candidates(scores: DataFrame, seed: int = 0, by: Sequence[str] = ("group_id",)) -> DataFrame:
    """Draw one token per group by probability: the largest ``logit + Gumbel noise``.

    Adding Gumbel noise to logits and taking the maximum samples from their softmax, without computing
    it. The noise is a hash of seed, group and token, so a draw is the same on every run and layout.
    """
    noise = -F.log(-F.log(uniform_hash(F.lit(seed), *[F.col(b) for b in by], F.col("token_id"))))
    drawn = F.max_by(F.struct("token_id", "logit"), F.struct((F.col("logit") + noise).alias("k"), -F.col("token_id")))
    return scores.groupBy(*by).agg(drawn.alias("drawn")).select(*by, "drawn.token_id", "drawn.logit")


def fan_out_sequences(prompts: DataFrame, n: int) -> DataFrame:
    """``n`` copies of every row, numbered from 0 in ``copy``; use ``copy`` as a group key to sample each."""
    return prompts.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("copy"))


def ngrams_of(ids: Column, n: int) -> Column:
    """All runs of ``n`` adjacent ids, each a struct: the row zipped with itself, shifted. Needs ``size >= n``."""
    count = F.size(ids) - (n - 1)
    return F.arrays_zip(*[F.slice(ids, F.lit(k + 1), count).alias(f"t{k}") for k in range(n)])


def repeated_ngrams(
    encoded: DataFrame, keys: Sequence[str], n: int = 4, ids_col: str = "input_ids"
) -> DataFrame:
    """``keys, ngram, n``: n-grams that occur more than once in a sequence (one row of ids).

    The grams of a row are sorted in place and only those equal to a neighbour leave it, so what is
    grouped is the repetition and not the corpus.
    """
    long_enough = encoded.select(*keys, ids_col).filter(F.size(ids_col) >= n)
    sorted_grams = with_computed(long_enough, "grams", F.sort_array(ngrams_of(F.col(ids_col), n)))
    at = F.col("at")
    neighbours = sorted_grams.select(*keys, "grams", F.explode(F.sequence(F.lit(0), F.size("grams") - 1)).alias("at")).select(
        *keys, F.get("grams", at).alias("gram"), F.get("grams", at - 1).alias("before"), F.get("grams", at + 1).alias("after")
    )
    again = neighbours.filter(F.col("gram").eqNullSafe(F.col("before")) | F.col("gram").eqNullSafe(F.col("after")))
    return (
        again.groupBy(*keys, "gram")
        .agg(F.count("*").alias("n"))
        .select(*keys, F.array(*[f"gram.t{k}" for k in range(n)]).alias("ngram"), "n")
    )


def token_repetition(encoded: DataFrame, keys: Sequence[str], ids_col: str = "input_ids") -> DataFrame:
    """``keys, token_id, n``: how often each token occurs in a sequence (one row of ids).

    Equal tokens of a row are neighbours once the row is sorted; the lengths of their runs need no shuffle.
    """
    long_enough = encoded.select(*keys, ids_col).filter(F.size(ids_col) > 0)
    ordered = with_computed(long_enough, "ordered", F.sort_array(ids_col))
    every = F.sequence(F.lit(0), F.size("ordered") - 1)
    opens = F.filter(every, lambda i: (i == 0) | (F.get("ordered", i) != F.get("ordered", i - 1)))
    runs = with_computed(ordered, "opens", opens)
    places = F.sequence(F.lit(0), F.size("opens") - 1)
    counted = F.transform(
        places,
        lambda k: F.struct(
            F.get("ordered", F.get("opens", k)).alias("token_id"),
            (F.coalesce(F.get("opens", k + 1), F.size("ordered")) - F.get("opens", k)).cast("bigint").alias("n"),
        ),
    )
    return runs.select(*keys, F.inline(counted))


def repetition_share(encoded: DataFrame, keys: Sequence[str], ids_col: str = "input_ids") -> DataFrame:
    """``keys, tokens, distinct_tokens, repeated_share``: read off the row itself, no shuffle."""
    counted = with_computed(encoded.select(*keys, ids_col), "distinct_tokens", F.size(F.array_distinct(ids_col)))
    tokens = F.size(ids_col)
    return counted.filter(tokens > 0).select(
        *keys, tokens.alias("tokens"), "distinct_tokens", (1 - F.col("distinct_tokens") / tokens).alias("repeated_share")
    )
