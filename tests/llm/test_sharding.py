import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.llm.sharding import permuted, shard_documents, shard_rows


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 17, 64, 1000])
def test_permutation(spark, rows):
    places = [r[0] for r in spark.range(rows).select(permuted(F.col("id"), rows, 7)).collect()]
    assert sorted(places) == list(range(rows))
    if rows == 1000:
        assert sum(p == i for i, p in enumerate(places)) < 10
        other = [r[0] for r in spark.range(rows).select(permuted(F.col("id"), rows, 8)).collect()]
        assert other != places


def test_shards_and_layout(spark):
    docs = spark.createDataFrame([(i, None if i % 7 == 0 else "ab ü" * (i % 5)) for i in range(503)], "doc_id long, text string")
    first = {r.doc_id: r for r in shard_documents(docs.repartition(5), 40, 1).collect()}
    again = {r.doc_id: r for r in shard_documents(docs.repartition(2, "text"), 40, 1).collect()}
    assert first == again and len(first) == 503
    sizes = Counter(r.shard for r in first.values())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in first.values() if r.shard == shard) == list(range(n))
    for i, r in first.items():
        data = b"" if i % 7 == 0 else ("ab ü" * (i % 5)).encode()
        assert (r["size"], r.text_crc32) == (len(data) + 16, zlib.crc32(data))


def test_repeated_rows_nulls_empty_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, "a", 0), (1, "a", 0), (None, None, 0), (2, "", 0)], "doc_id long, text string, shard int")
    got = shard_rows(rows, ["doc_id", "text"], 3).collect()
    assert sorted((r._shard, r.slot) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0)]
    assert shard_rows(rows.limit(0), ["doc_id"], 3).collect() == []
