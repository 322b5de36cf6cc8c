"""Mixing sources to target weights: how many words of each document a weighted mixture takes.

Every document gets a key from a hash of a seed and its id. Documents are sorted by range within their sources, by source
and key, and one distributed prefix sum over their sizes gives each its place on its source's line of words. A
source whose budget is B words out of S is gone through ``B div S`` times in whole, and once more up to word
``B mod S`` of its line, which cuts a single document. So every source gives exactly its budget, and the same rows give
the same mixture in whatever layout they come.

Targets share the wanted total by weight, but none is above ``epochs`` times its source; what is cut off goes to the
others by weight. With the sources in order of size over weight, those held back are the first ones, so prefix
sums settle who they are. All arithmetic is on whole numbers; a target is one division of two of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import SPACE_CLASS, col, fresh, join_totals, kept_names, running_sums, staged, text_of


@dataclass(frozen=True)
class Mixture:
    """Weights of the sources, by code point of their names and null last, repeating; the mixture's size is ``share[0] /
    share[1]`` of all words; a source is gone through at most ``epochs`` times."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: tuple[int, int] = (3, 2)
    epochs: int = 2
    seed: int = 20240501


def n_words(df: DataFrame, text_col: str):
    """The number of runs of other characters than the six white-space ones in a text, 0 for null."""
    return F.size(F.array_remove(F.split(text_of(df, text_col), f"{SPACE_CLASS}+"), "")).cast("long")


def source_targets(totals: DataFrame, plan: Mixture = Mixture()) -> DataFrame:
    """For ``source, source_rows, source_size`` (a row per source): ``start`` (words of earlier sources), ``target``, ``whole``
    (times the source is taken in whole) and ``rest`` (words of one more pass), written. Two rows of sums reach the driver.

    Weights that are too large for the sources (``share`` above ``epochs``) give every source its most.
    """
    base = lcm(*plan.weights)
    named = totals.select("*", F.col("source").isNull().alias("unnamed"), F.lit(1).cast("long").alias("one"))
    placed = running_sums(named, ["unnamed", "source"], {"start": "source_size", "position": "one"})
    weight = F.element_at(F.array(*[F.lit(w) for w in plan.weights]), (F.pmod("position", F.lit(len(plan.weights))) + 1).cast("int"))
    placed = placed.withColumn("weight", weight.cast("long")).withColumn("level", F.expr(f"source_size * ({base} div weight)"))
    ranked = staged(running_sums(placed, ["level", "position"], {"lighter": "source_size", "used": "weight"}), "targets")
    up, down = plan.share
    sums = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
    # A source is held back if the rest by weight, without those before it, would give it more than its most.
    left = F.lit(up * sums["size"]) - F.lit(down * plan.epochs) * F.col("lighter")
    held = left * F.col("weight") > F.lit(down * plan.epochs) * F.col("source_size") * (F.lit(sums["weight"]) - F.col("used"))
    free = ranked.filter(~held).agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    over, under = up * sums["size"] - down * plan.epochs * (sums["size"] - (free["size"] or 0)), down * (free["weight"] or 1)
    most, due = F.lit(plan.epochs) * F.col("source_size"), F.lit(over) * F.col("weight")
    target = F.when(held, most.cast("double")).otherwise(due.cast("double") / F.lit(float(under)))
    budget = F.when(held, most).otherwise(F.call_function("div", due, F.lit(under)))
    size = F.greatest("source_size", F.lit(1))
    return staged(
        ranked.select("source", "source_rows", "source_size", "start", target.alias("target"), budget.alias("budget")).select(
            "*", F.call_function("div", F.col("budget"), size).alias("whole"), F.pmod("budget", size).alias("rest")
        ),
        "targets",
    )


def mix(
    docs: DataFrame,
    plan: Mixture = Mixture(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: list[str] | None = None,
    out: str = "mix",
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default; only they are sorted) and a struct ``out`` (an underscore is put
    before a name that ``docs`` has): ``size`` (words), ``source_size`` and ``target`` of the row's source, ``whole`` (times the row is taken in whole), ``part`` (its first
    words taken once more), ``taken`` (all words the mixture takes of it) and ``key`` (its place in its source's order).

    ``taken`` sums up to the whole part of each source's target. Null and empty texts have size 0 and take nothing; a null
    source is a source of its own, after all names; rows with a null id take part. Rows that agree in id, size and text may
    swap places, which changes nothing. An empty table gives an empty one. A source may hold any share of the
    rows: keys are random, so ranges cut through it.
    """
    out, size, source, unnamed, key, tie, before = fresh(docs, out, "size", "source", "unnamed", "key", "tie", "before")
    keep = docs.columns if keep is None else keep
    own = col(docs, source_col).cast("string")
    chosen = F.md5(F.concat_ws("|", F.lit(str(plan.seed)), F.coalesce(col(docs, id_col).cast("string"), F.lit(""))))
    rows = staged(
        docs.select(
            *[col(docs, c) for c in keep], own.alias(source), own.isNull().alias(unnamed), n_words(docs, text_col).alias(size),
            chosen.alias(key), F.xxhash64(text_of(docs, text_col)).alias(tie),
        ),
        "sized",
    )
    sums = rows.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("source_rows"), F.sum(size).alias("source_size"))
    targets = source_targets(staged(sums, "sources"), plan)
    renamed = [*fresh(rows, *targets.columns[1:], before)]
    lookup = targets.select(F.col("source").alias(source), *[F.col(c).alias(n) for c, n in zip(targets.columns[1:], renamed, strict=False)])
    n_rows, total, start, target, _, whole, rest, before = renamed
    placed = running_sums(rows, [unnamed, source, key, size, tie], {before: f"`{size}`"})
    joined = join_totals(placed, lookup, [source], n_rows)
    part = F.greatest(F.lit(0), F.least(F.col(size), F.col(rest) - (F.col(before) - F.col(start))))
    struct = F.struct(
        F.col(size).alias("size"), F.col(total).alias("source_size"), F.col(target).alias("target"), F.col(whole).alias("whole"), part.alias("part"),
        (F.col(whole) * F.col(size) + part).alias("taken"), F.col(key).alias("key"),
    )
    return joined.select(*kept_names(docs.select(*[col(docs, c) for c in keep])), struct.alias(out))


def drawn(docs: DataFrame, plan: Mixture = Mixture(), **names: str) -> DataFrame:
    """The mixture itself: the columns of ``docs`` and ``pass`` (from 0), a row for each time that a document is taken. The
    text of a row's cut pass is its first ``part`` words joined by one space; a document that takes no word has no row."""
    text_col = names.get("text_col", "text")
    out = fresh(docs, names.get("out", "mix"))[0]
    turn = fresh(docs, "pass")[0]
    rows = mix(docs, plan, **names).filter(F.col(f"{out}.taken") > 0)
    times = F.col(f"{out}.whole") + F.when(F.col(f"{out}.part") > 0, 1).otherwise(0)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias(turn))
    words = F.slice(F.array_remove(F.split(text_of(rows, text_col), f"{SPACE_CLASS}+"), ""), 1, F.col(f"{out}.part").cast("int"))
    text = F.when(F.col(turn) < F.col(f"{out}.whole"), col(rows, text_col)).otherwise(F.array_join(words, " "))
    return rows.select(*[text.alias(c) if c == text_col else col(rows, c) for c in docs.columns], turn)
