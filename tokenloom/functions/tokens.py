"""Expressions over token-id arrays. None of them leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.config import IGNORE_LABEL


def _repeat(value: int, n: Column) -> Column:
    return F.array_repeat(F.lit(value).cast("int"), n.cast("int"))


def add_special_tokens(ids: Column, bos: int, eos: int, max_length: int | None = None) -> Column:
    """BOS in front; EOS behind unless the BOS-prefixed row already fills ``max_length``."""
    head = F.array(F.lit(bos).cast("int"))
    tail = F.array(F.lit(eos).cast("int"))
    if max_length is None:
        return F.concat(head, ids, tail)
    return F.when(F.size(ids) + 1 < max_length, F.concat(head, ids, tail)).otherwise(F.concat(head, ids))


def truncate_ids(ids: Column, max_length: int, eos: int | None = None) -> Column:
    """Cut to ``max_length``; with ``eos`` given, a cut row ends in it."""
    if eos is None:
        return F.slice(ids, 1, max_length)
    cut = F.concat(F.slice(ids, 1, max_length - 1), F.array(F.lit(eos).cast("int")))
    return F.when(F.size(ids) > max_length, cut).otherwise(ids)


def pad_ids(ids: Column, max_length: int | Column, pad: int) -> Column:
    missing = F.greatest(F.lit(0), F.lit(max_length) - F.size(ids))
    return F.concat(ids, _repeat(pad, missing))


def length_mask(n: Column, width: int | Column | None = None) -> Column:
    """1 for each of ``n`` real positions, 0 up to ``width``: the encoder's mask, by length."""
    ones = _repeat(1, n)
    if width is None:
        return ones
    return F.concat(ones, _repeat(0, F.greatest(F.lit(0), F.lit(width) - n)))


def pad_mask(ids: Column, pad: int) -> Column:
    """1 where the id differs from the padding id: the collator's mask, by value.

    Rows without that id, all full blocks among them, skip the element-wise form.
    """
    by_element = F.transform(ids, lambda x: F.when(x == pad, 0).otherwise(1).cast("int"))
    return F.when(F.array_contains(ids, pad), by_element).otherwise(_repeat(1, F.size(ids)))


def labels_of(ids: Column, pad: int) -> Column:
    by_element = F.transform(ids, lambda x: F.when(x == pad, IGNORE_LABEL).otherwise(x).cast("int"))
    return F.when(F.array_contains(ids, pad), by_element).otherwise(ids)


def uniform_hash(*parts: Column) -> Column:
    """A value in (0, 1) that depends only on ``parts``: the first 52 bits of an md5."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
