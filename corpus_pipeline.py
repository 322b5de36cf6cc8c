"""The corpus pipeline: five stages, each a DataFrame of the last one's rows, written and read again in between.

Rows are ``documents`` until the last stage, which gives packed pieces. ``run`` writes every stage to the shared
folder and removes it when the next one stands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import jaccard_join, packing, quality_lm, quality_rules, substring_dedup
from tokenloom.llm.common import drop_staged, fresh, kept_names, staged
from tokenloom.llm.queries import byte_files, table

END_ID = 1


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no quality rule."""
    return quality_rules.keep_good(docs)


def by_perplexity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity stays below their language's threshold; the model is trained on the trusted ones left."""
    return quality_lm.keep_fluent(docs, table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a smaller id has; ``n_chars`` counts what is left. Untouched texts stay as they are."""
    out = fresh(docs, "deduped")[0]
    done = substring_dedup.remove_repeats(docs, out=out)
    left, cut = F.col(out)["text"], F.col(out)["n_removed"] > 0
    done = done.withColumn("n_chars", F.when(cut, F.length(left).cast("long")).otherwise(F.col("n_chars")))
    return done.withColumn("text", F.when(cut, left).otherwise(F.col("text"))).select(*kept_names(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack_documents(docs, *byte_files(), end_id=END_ID)


STAGES = [
    ("quality rules", by_rules),
    ("quality classifier", by_perplexity),
    ("n-gram Jaccard join", one_per_group),
    ("substring dedup", without_repeats),
    ("packing", packed),
]

#: Perplexities and token ids have no SQL; ``tests/llm/test_pipeline.py`` holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        after = stage(spark, docs, sf_dir)
        if stage is STAGES[-1][1]:
            return after
        docs = staged(after, f"stage-{name.replace(' ', '-')}")
        if before is not None:
            drop_staged(before)
        before = docs
    return docs
