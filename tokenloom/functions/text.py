"""Line cleaning as column expressions. Everything but NFKC stays in the JVM."""

from __future__ import annotations

import re
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.config import CleaningConfig
from tokenloom.functions.entities import decoded_references

# The code points Python's `re` and `str.strip` treat as white space, and the characters kept.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
KEPT_CHARS = r"A-Za-z0-9.,!?;:\-"


def _all_but(pattern: str) -> str:
    """The complement of a character class, as plain ranges.

    Java matches listed ranges several times faster than a negated union of them.
    """
    known = re.compile(f"[{pattern}]")
    inside = [c for c in range(0x10000) if known.match(chr(c))]
    edges = zip([-1, *inside], [*inside, sys.maxunicode + 1])
    return "".join(rf"\x{{{a + 1:x}}}-\x{{{b - 1:x}}}" for a, b in edges if b - a > 1)


# Kept characters listed one by one, which Java looks up in one table.
_UNWANTED = "^" + "".join(rf"\x{{{c:x}}}" for c in range(0x80) if re.match(f"[{KEPT_CHARS}]", chr(c)))
_SPECIAL = _all_but(KEPT_CHARS + WHITESPACE)


_TEXTS_AT_ONCE = 256


def normalized(texts: pa.Array, form: str) -> pa.Array:
    """Few texts at a time are Python strings, which take more room than the batch that holds thousands of them."""
    parts = [pa.array([], pa.string())]
    for at in range(0, len(texts), _TEXTS_AT_ONCE):
        some = texts.slice(at, _TEXTS_AT_ONCE).to_pylist()
        parts.append(pa.array([None if t is None else unicodedata.normalize(form, t) for t in some], pa.string()))
    return pa.concat_arrays(parts)


def normalizer(form: str):
    @F.arrow_udf(T.StringType())
    def normalize(texts: pa.Array) -> pa.Array:
        return normalized(texts, form)

    return normalize


def html_unescape(text: Column) -> Column:
    """Decode HTML entities by built-in functions; only rows with ``&`` are taken apart."""
    return decoded_references(text)


def unicode_normalize(text: Column, form: str | None = "NFKC") -> Column:
    """Unicode normalization. Pure ASCII rows (as many bytes as characters) are never sent to Python."""
    if form is None:
        return text
    return F.coalesce(normalizer(form)(F.when(F.octet_length(text) != F.char_length(text), text)), text)


def strip_text(text: Column) -> Column:
    """Trim Unicode white space. The regex only runs on rows that begin or end with some."""
    edges = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    trimmed = F.regexp_replace(text, rf"\A[{WHITESPACE}]+|[{WHITESPACE}]+\z", "")
    return F.when(F.rlike(edges, F.lit(f"[{WHITESPACE}]")), trimmed).otherwise(text)


def strip_tags(text: Column) -> Column:
    """Replace each ``<...>`` by a space. The regex only runs on rows that hold both brackets."""
    has_tag = F.contains(text, F.lit("<")) & F.contains(text, F.lit(">"))
    return F.when(has_tag, F.regexp_replace(text, "<[^>]+>", " ")).otherwise(text)


def mask_special_chars(text: Column) -> Column:
    return F.regexp_replace(text, f"[{_SPECIAL}]", " ")


def collapse_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{WHITESPACE}]+", " "))


def lowercase_text(text: Column) -> Column:
    return F.lower(text)


def in_length(text: Column, cfg: CleaningConfig) -> Column:
    n = F.char_length(text)
    return (n > cfg.min_length) & (n <= cfg.max_length)


def clean_expr(text: Column, cfg: CleaningConfig) -> Column:
    """Unescape, drop tags, mask, collapse, strip, lower-case; no length rule.

    Two steps are folded into others without changing any result: the strip before tag removal
    (the final collapse and trim cover it), and masking followed by collapsing, which for the
    default character set is one replacement of every run of unwanted characters by a space.
    """
    out = html_unescape(text)
    if cfg.remove_html:
        # Tag removal spells its text four times: decoded ones are made once for it.
        once = F.get(F.transform(F.array(out), strip_tags), F.lit(0))
        out = F.when(F.contains(text, F.lit("&")), once).otherwise(strip_tags(text))
    if cfg.remove_special_chars:
        out = F.trim(F.regexp_replace(out, f"[{_UNWANTED}]+", " "))
    else:
        out = collapse_ws(out)
    return lowercase_text(out) if cfg.lowercase else out


def with_computed(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add ``expr`` as a generated column, so that later filters reuse its value.

    A filter over an ordinary projected column is pushed below the projection with the whole
    expression copied into it, which would run a regex chain or a Python function twice or more.
    Filters are not pushed through a generator.
    """
    keep = [c for c in df.columns if c != name]
    return df.select(*keep, F.explode(F.array(expr)).alias(name))
