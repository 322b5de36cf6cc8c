"""Quality rules: one table of thresholds, compiled into a Spark projection of built-in functions.

Nulls and texts without a word have all counts 0 and fail; a null or unknown language is measured with the
stop words of all languages, but a language without a list can't fail a rule on them. Repeated rows are judged one by one, an empty table gives an empty one, and
other columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import SPACE_CLASS, SPACES, col, fresh, kept_names, text_of

# Frequent function words of each language.
STOP_WORDS = {
    "en": "the of and to in a is that it for on was with as be by this are at from or an not have".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er in aus bei wir".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par au sur pas plus il ne avec ce".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
SYMBOLS = r"[#*$%&|<>]"
SHOUTS = r"[!?]{2,}"


@dataclass(frozen=True)
class Rule:
    """A document fails if ``metric``, a column of the counts, is below ``low`` or above ``high``."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Ratios are per word, but for lines: per line that has a word.
RULES = (
    Rule("length", "n_words", low=50),
    Rule("repetition", "n_repeat_words / n_words", high=0.5),
    Rule("word_length", "word_chars / n_words", low=3.0, high=10.0),
    Rule("symbols", "n_symbols / n_words", high=0.1),
    Rule("shouting", "n_shouts / n_words", high=0.1),
    Rule("stop_words", "n_stop_words / n_words", low=0.03),
    Rule("repeated_lines", "n_dup_lines / n_lines", high=0.4),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_shouts")


def _stop_word(word: Column, lang: Column) -> Column:
    bare = F.lower(F.btrim(word, F.lit(".,;:!?()\"'")))
    known = F
    for name, words in STOP_WORDS.items():
        known = known.when(lang == name, bare.isin(words))
    return known.otherwise(bare.isin(sorted({w for words in STOP_WORDS.values() for w in words})))


def measured(docs: DataFrame, out: str, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Add the struct ``out`` with the ``COUNTS`` (long) of every whole text.

    Words repeat if a three-word window that holds them occurs twice. Windows are compared by hash first;
    only texts with an equal pair of hashes sort the windows themselves.
    """
    text, words, lines, hashes, windows, places = fresh(docs, "_text", "_words", "_lines", "_hashes", "_windows", "_places")
    kept = [col(docs, c) for c in docs.columns]
    lang = col(docs, lang_col) if lang_col in docs.columns else F.lit(None).cast("string")
    tongue = fresh(docs, "_lang")[0]
    df = docs.select(*kept, text_of(docs, text_col).alias(text), lang.alias(tongue))
    w, n = F.col(words), F.size(words)
    df = df.withColumn(words, F.array_remove(F.split(text, f"{SPACE_CLASS}+"), ""))
    df = df.withColumn(lines, F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""))

    def each(fn) -> Column:
        return F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), fn))

    def three(i: Column) -> list[Column]:
        return [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]

    df = df.withColumn(hashes, each(lambda i: F.xxhash64(*three(i))))
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    df = df.withColumn(
        windows,
        F.when(repeats, F.sort_array(each(lambda i: F.struct(F.concat_ws(" ", *three(i)).alias("w"), i.alias("i"))))),
    )

    def again(k: Column) -> Column:
        here = F.get(F.col(windows), k)["w"]
        return F.coalesce(here == F.get(F.col(windows), k - 1)["w"], F.lit(False)) | F.coalesce(
            here == F.get(F.col(windows), k + 1)["w"], F.lit(False)
        )

    every = F.sequence(F.lit(0), F.size(windows) - 1)
    df = df.withColumn(
        places,
        F.when(
            F.size(windows) > 0,
            F.sort_array(F.transform(F.filter(every, again), lambda k: F.get(F.col(windows), k)["i"])),
        ),
    )
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct((i + 3).alias("end"), (acc["n"] + (i + 3 - F.greatest(acc["end"], i)).cast("long")).alias("n")),
    )["n"]
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(lines),
        "n_stop_words": F.size(F.filter(w, lambda x: _stop_word(x, F.col(tongue)))),
        "n_shouts": F.regexp_count(text, F.lit(SHOUTS)),
    }
    # Made by a generator: a filter on the counts would otherwise copy all that they are computed from into itself.
    row = F.struct(*[counts[c].cast("long").alias(c) for c in COUNTS])
    return df.select(*kept_names(docs), F.explode(F.array(row)).alias(out))


def verdict(counts: str, rules: tuple[Rule, ...] = RULES, lang: Column | None = None) -> Column:
    """Names of the rules that a document fails. A ratio over nothing counts as 0. Stop words judge no ``lang`` without a list."""
    listed = F.lit(True) if lang is None else F.coalesce(lang.isin(list(STOP_WORDS)), F.lit(True))

    def failed(rule: Rule) -> Column:
        parts = [F.col(counts)[p.strip()] for p in rule.metric.split("/")]
        value = parts[0].cast("double") if len(parts) == 1 else F.when(parts[1] == 0, F.lit(0.0)).otherwise(parts[0] / parts[1])
        bad = [value < rule.low] if rule.low is not None else []
        bad += [value > rule.high] if rule.high is not None else []
        if "n_stop_words" in rule.metric:
            return F.when(listed & reduce(Column.__or__, bad), F.lit(rule.name))
        return F.when(reduce(Column.__or__, bad), F.lit(rule.name))

    return F.array_compact(F.array(*[failed(r) for r in rules]))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All columns of ``docs``, and a struct ``quality`` of counts and array ``failed_rules`` (or ``_quality`` ... if taken)."""
    counts, failed = fresh(docs, "quality", "failed_rules")
    judged = measured(docs, counts, text_col, lang_col)
    lang = col(judged, lang_col) if lang_col in docs.columns else None
    return judged.withColumn(failed, verdict(counts, rules, lang))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that fail no rule, columns unchanged."""
    failed = fresh(docs, "quality", "failed_rules")[1]
    judged = quality_rules(docs, rules, text_col, lang_col)
    return judged.filter(F.size(failed) == 0).select(*kept_names(docs))
