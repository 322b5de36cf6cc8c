"""Sharding by a Feistel permutation of global row numbers, in built-in functions only.

A row's number is its rank by the order columns. A keyed Feistel network permutes a domain slightly larger
than the table; numbers that fall outside it are permuted again until they fall inside (cycle walking).
Row ``p`` of the shuffled order goes to shard ``p % shards``, slot ``p // shards``: shard sizes differ by at
most one, and anyone with the row number, the row count and the seed can compute a row's place.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import col, fresh, kept_names, staged, text_of

ROUNDS = 6
# A Mersenne prime and multipliers of well-known generators modulo it.
PRIME = 2147483647
MULTIPLIERS = (48271, 69621, 40692)
#: More steps than any walk takes: a step stays outside with probability below 1/2, on large tables far below.
WALK = 256


def round_keys(seed: int) -> list[int]:
    key, keys = seed % PRIME + 1, []
    for _ in range(ROUNDS):
        key = key * MULTIPLIERS[0] % PRIME
        keys.append(key)
    return keys


def sides(rows: int) -> tuple[int, int]:
    """Sizes of the two halves; their product is at least ``rows`` and less than ``rows`` plus the larger one."""
    left = max(1, isqrt(max(0, rows - 1)) + 1)
    return left, max(1, -(-rows // left))


def _scrambled(half: Column, key: Column) -> Column:
    t = (half + key) % PRIME
    t = F.transform(F.array(t * MULTIPLIERS[0] % PRIME), lambda x: (x.bitwiseXOR(F.shiftright(x, 13)) * MULTIPLIERS[1]) % PRIME)
    return F.element_at(F.transform(t, lambda x: (x.bitwiseXOR(F.shiftright(x, 17)) * MULTIPLIERS[2]) % PRIME), 1)


def permuted(number: Column, rows: int, seed: int) -> Column:
    """The place of row ``number`` of ``rows`` in the shuffled order, as a column expression."""
    left, right = sides(rows)
    keys = F.array(*[F.lit(k).cast("long") for k in round_keys(seed)])

    def turn(pair: Column, i: Column) -> Column:
        key, a, b = F.get(keys, i), pair["l"], pair["r"]
        return F.when(i % 2 == 0, F.struct(((a + _scrambled(b, key)) % left).alias("l"), b.alias("r"))).otherwise(
            F.struct(a.alias("l"), ((b + _scrambled(a, key)) % right).alias("r"))
        )

    def once(x: Column) -> Column:
        halves = F.struct(F.floor((x - x % right) / right).cast("long").alias("l"), (x % right).alias("r"))
        return F.aggregate(
            F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, turn, lambda p: p["l"] * F.lit(right).cast("long") + p["r"]
        )

    def step(x: Column, _: Column) -> Column:
        return F.when(x < rows, x).otherwise(once(x))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once(number.cast("long")), step)
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def numbered(keys: DataFrame, order: list[str], out: str) -> tuple[DataFrame, int]:
    """Add the global row number by ``order``, and say how many rows there are.

    Rows are sorted by range, so that equal or hot keys are no larger than their rows; each piece counts
    its own rows, and only one number per piece is summed up globally.
    """
    part, size, base, rank = fresh(keys, "_part", "_size", "_base", "_rank")
    by = [col(keys, c) for c in order]
    placed = staged(keys.repartitionByRange(*by).withColumn(part, F.spark_partition_id()), "shard-keys")
    sizes = staged(placed.groupBy(part).agg(F.count("*").alias(size)), "shard-sizes")
    rows = sizes.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy(part).orderBy(*[col(placed, c) for c in order])
    ranked = placed.withColumn(rank, F.row_number().over(inside) - 1).join(bases, part)
    out_df = ranked.select(*kept_names(keys), (F.col(base) + F.col(rank)).cast("long").alias(out))
    return out_df, rows


def shard_rows(keys: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard) to rows, in a reproducible shuffle.

    ``keys`` needs no text: join the places back, or compute them. ``order`` should tell rows apart; rows
    equal in it take consecutive numbers in either order. Nulls come first. An empty table stays empty.
    Names that are taken get underscores in front.
    """
    number, place, shard, slot = fresh(keys, "_number", "_place", "shard", "slot")
    ranked, rows = numbered(keys, order, number)
    placed = ranked.withColumn(place, permuted(F.col(number), rows, seed))
    return placed.select(
        *kept_names(keys),
        (F.col(place) % shards).cast("int").alias(shard),
        F.expr(f"`{place}` div {shards}").alias(slot),
    )


def shard_documents(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Place documents: id, ``size`` (UTF-8 bytes and 16), ``text_crc32``, ``shard``, ``slot``. A null text is empty."""
    text = text_of(docs, text_col)
    keys = docs.select(
        col(docs, id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    return shard_rows(keys, ["doc_id", "size", "text_crc32"], shards, seed)
