"""Corpus scoring: next-token counts stand in for a model, the loss metrics are the usual ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.config import IGNORE_LABEL

PAIR = ("prev_id", "next_id")

# Rows of a score table that every task may hold: some 30 MB.
_BROADCAST_PAIRS = 1 << 20


def next_token_pairs(
    samples: DataFrame, keep: Sequence[str], ids_col: str = "input_ids", labels_col: str | None = None
) -> DataFrame:
    """``keep, pos, prev_id, next_id``: position i predicts the label at i + 1; ignored labels are skipped."""
    labels = labels_col or ids_col
    following = F.posexplode(F.slice(labels, F.lit(2), F.size(labels) - 1)).alias("pos", "next_id")
    pairs = samples.filter(F.size(ids_col) > 1).select(*keep, F.col(ids_col).alias("_ids"), following)
    return pairs.filter(F.col("next_id") != IGNORE_LABEL).select(*keep, "pos", F.get("_ids", F.col("pos")).alias("prev_id"), "next_id")


def bigram_table(pairs: DataFrame, vocab_size: int) -> DataFrame:
    """``prev_id, next_id, n, log_prob``: add-one smoothed next-token probabilities.

    Pairs are counted with partial aggregation. The window then holds at most ``vocab_size`` rows per
    ``prev_id``.
    """
    counts = pairs.groupBy(*PAIR).agg(F.count("*").alias("n"))
    return with_log_prob(counts, vocab_size)


def with_log_prob(counts: DataFrame, vocab_size: int) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy("prev_id"))
    return counts.withColumn("log_prob", F.log((F.col("n") + 1) / (total + vocab_size)))


def unseen_table(table: DataFrame, vocab_size: int) -> DataFrame:
    """Log-probability of a next token never seen after ``prev_id``; one row per token."""
    return table.groupBy("prev_id").agg((-F.log(F.sum("n") + vocab_size)).alias("unseen_log_prob"))


def _scored(pairs: DataFrame, table: DataFrame, vocab_size: int, by: Sequence[str]) -> DataFrame:
    """``by, n, loss``: a row per group, with its predictions and their negative log-likelihood together.

    The score table of a small vocabulary, which has ``vocab_size`` squared rows at most, is broadcast: every prediction is
    scored where it lies, and a task sends one row per group that it holds a part of. The table of a larger one is joined by
    its real size; equal pairs of a group are counted first there, so a pair found in nearly all groups makes a
    skewed partition of the counted side at worst, which adaptive execution splits.
    A pair the table lacks scores as unseen after its first token, or uniformly if that is unknown too.
    The unseen scores have one row per token of the vocabulary, which bounds their broadcast.
    """
    scores = table.select(*PAIR, "log_prob")
    if vocab_size**2 <= _BROADCAST_PAIRS:
        counted, scores = pairs.select(*by, *PAIR, F.lit(1).cast("bigint").alias("n")), F.broadcast(scores)
    else:
        counted = pairs.groupBy(*by, *PAIR).agg(F.count("*").alias("n"))
    scored = counted.join(scores, list(PAIR), "left").join(F.broadcast(unseen_table(table, vocab_size)), "prev_id", "left")
    nll = -F.coalesce("log_prob", "unseen_log_prob", -F.log(F.lit(float(vocab_size))))
    return scored.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.col("n") * nll).alias("loss"))


def _scored_in(pairs: DataFrame, table: DataFrame, vocab_size: int, by: Sequence[str], placed: DataFrame | None) -> DataFrame:
    """As :func:`_scored`; with ``placed``, by the groups that it names for the samples.

    ``placed`` has a row per sample: the columns that name it, which the pairs have too, and those of ``by``. Predictions are added
    up by sample where these lie, so what moves to a group is one row per sample and no token. Samples without a place are left out.
    """
    if placed is None:
        return _scored(pairs, table, vocab_size, by)
    named = [c for c in placed.columns if c in pairs.columns]
    places = placed.select(*[F.col(c).alias(f"_{c}") for c in named], *[c for c in by if c not in named])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in named])
    moved = _scored(pairs, table, vocab_size, named).join(places, same)
    return moved.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))


def _means() -> list[Column]:
    return [F.sum("n").alias("n"), (F.sum("loss") / F.sum("n")).alias("nll")]


def masked_nll(
    pairs: DataFrame, table: DataFrame, vocab_size: int, by: Sequence[str] = (), placed: DataFrame | None = None
) -> DataFrame:
    """``by, n, nll``: predictions and their mean negative log-likelihood, ignored labels left out.

    ``placed`` may name the group of each sample (:func:`_scored_in`).
    """
    return _scored_in(pairs, table, vocab_size, by, placed).select(*by, "n", (F.col("loss") / F.col("n")).alias("nll"))


def loss_levels(
    pairs: DataFrame,
    table: DataFrame,
    vocab_size: int,
    by: Sequence[str] = ("split", "shard", "batch_id"),
    levels: Sequence[Sequence[str]] = (("split",), ()),
    placed: DataFrame | None = None,
) -> DataFrame:
    """Losses of every group of ``by`` and of the coarser ``levels`` at once: ``level, by, n, nll, perplexity``.

    Pairs are looked up once, and all levels are added up from the sums of the groups, so a level is the mean over its
    predictions and not over its groups. ``level`` is the grouping id: a bit for each column of ``by``, the first one
    highest, set where the row is a total over that column (which is null in it). ``placed`` is as in :func:`masked_nll`.
    """
    sets = [list(by), *map(list, levels)]
    summed = _scored_in(pairs, table, vocab_size, by, placed).groupingSets(sets, *by).agg(F.grouping_id(*by).cast("int").alias("level"), *_means())
    return perplexity(summed).select("level", *by, "n", "nll", "perplexity")


def perplexity(losses: DataFrame) -> DataFrame:
    """Add ``exp(min(loss, 20))``."""
    return losses.withColumn("perplexity", F.exp(F.least(F.col("nll"), F.lit(20.0))))


def total_loss(losses: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Combine per-group losses into coarser ones, weighted by their prediction counts."""
    return losses.groupBy(*by).agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("nll")) / F.sum("n")).alias("nll")
    )


def finite_loss_check(losses: DataFrame) -> DataFrame:
    """One row: groups, and groups whose loss is not a finite number."""
    bad = F.col("nll").isNull() | F.isnan("nll") | (F.abs("nll") == float("inf"))
    return losses.agg(
        F.count("*").alias("groups"), F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("non_finite")
    )


def require_finite(losses: DataFrame) -> None:
    """Raise if any loss is not finite."""
    bad = finite_loss_check(losses).first()["non_finite"]
    if bad:
        raise FloatingPointError(f"{bad} groups have a non-finite loss")
