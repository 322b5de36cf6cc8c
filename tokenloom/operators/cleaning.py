"""Cleaning as an operator on line tables, and its report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tokenloom.config import CleaningConfig
from tokenloom.functions.text import clean_expr, in_length, with_computed


def with_clean_text(
    lines: DataFrame, cfg: CleaningConfig = CleaningConfig(), text_col: str = "text", out: str = "clean"
) -> DataFrame:
    """Add the cleaned text, null where the line is rejected (too short, too long, or null)."""
    cleaned = with_computed(lines, out, clean_expr(F.col(text_col), cfg))
    return cleaned.withColumn(out, F.when(in_length(F.col(out), cfg), F.col(out)))


def clean_lines(
    lines: DataFrame, cfg: CleaningConfig = CleaningConfig(), text_col: str = "text", out: str = "clean"
) -> DataFrame:
    """Cleaned lines, rejected ones dropped. No shuffle; other columns, the order key too, stay."""
    cleaned = with_computed(lines, out, clean_expr(F.col(text_col), cfg)).filter(in_length(F.col(out), cfg))
    return cleaned if text_col == out else cleaned.drop(text_col)


def _tokens(clean: Column) -> Column:
    """Cleaned text holds single spaces only, so its token count is its space count plus one."""
    return F.char_length(clean) - F.char_length(F.replace(clean, F.lit(" "), F.lit(""))) + 1


def cleaning_report(
    lines: DataFrame, cfg: CleaningConfig = CleaningConfig(), by: str = "split", text_col: str = "text"
) -> DataFrame:
    """Per split: lines read, lines kept, white-space tokens kept."""
    return (
        with_clean_text(lines, cfg, text_col)
        .groupBy(by)
        .agg(
            F.count("*").alias("lines_in"),
            F.count("clean").alias("lines_kept"),
            F.coalesce(F.sum(_tokens(F.col("clean"))), F.lit(0)).cast("bigint").alias("tokens"),
        )
    )


REPORT_SCHEMA = "split string, lines_in long, lines_kept long, tokens long"


class ReportedCleaning:
    """Cleaned lines whose report comes with the job that writes them.

    ``lines`` is what :func:`clean_lines` gives. The first action that reads all of it also counts what
    :func:`cleaning_report` counts, for each of the named ``splits`` (a handful: three numbers each travel with the
    tasks' results); rows of no named split are cleaned and not reported. :meth:`report` waits for that action.
    """

    def __init__(
        self,
        lines: DataFrame,
        splits: Sequence[str],
        cfg: CleaningConfig = CleaningConfig(),
        by: str = "split",
        text_col: str = "text",
        out: str = "clean",
    ):
        self.splits, self._spark, self._counts = list(splits), lines.sparkSession, Observation()
        cleaned, kept = with_clean_text(lines, cfg, text_col, out), F.col(out)
        counts = []
        for i, split in enumerate(self.splits):
            here = F.col(by) == split
            counts += [
                F.count_if(here).alias(f"lines_in_{i}"),
                F.count_if(here & kept.isNotNull()).alias(f"lines_kept_{i}"),
                F.coalesce(F.sum(F.when(here, _tokens(kept))), F.lit(0)).cast("bigint").alias(f"tokens_{i}"),
            ]
        observed = cleaned.observe(self._counts, *counts) if counts else cleaned
        kept_lines = observed.filter(kept.isNotNull())
        self.lines = kept_lines if text_col == out else kept_lines.drop(text_col)

    def report(self) -> DataFrame:
        """``split, lines_in, lines_kept, tokens``: a row per named split, also where it has no lines."""
        got = self._counts.get if self.splits else {}
        rows = [(s, *[got[f"{c}_{i}"] for c in ("lines_in", "lines_kept", "tokens")]) for i, s in enumerate(self.splits)]
        return self._spark.createDataFrame(rows, REPORT_SCHEMA)
