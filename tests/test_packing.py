import random

import pytest
from pyspark.sql import functions as F

import plain
from tokenloom.config import LoaderConfig
from tokenloom.functions import tokens as tk
from tokenloom.operators import batching as bt
from tokenloom.operators import packing as pk
from tokenloom.operators.sequencing import number_rows, running_start


def codes(modulus, plus=0):
    """A stand-in tokenizer: code points reduced to small ids."""

    def encode(text):
        chars = F.filter(F.split(text, ""), lambda c: c != "")
        return F.transform(chars, lambda c: (F.pmod(F.ascii(c), F.lit(modulus)) + plus).cast("int"))

    return encode


def blocks_of(df, *groups):
    return [tuple(r) for r in df.orderBy(*groups, "block").select(*groups, "input_ids").collect()]


@pytest.mark.parametrize(
    "texts, length, drop, expected",
    [
        (["abc", "defghijk"], 5, True, [[97, 98, 99, 99, 0], [1, 2, 3, 4, 5]]),
        (["abc", "defghijk"], 5, False, [[97, 98, 99, 99, 0], [1, 2, 3, 4, 5], [6, 7, 99]]),
        (["abc"], 6, False, [[97, 98, 99, 99]]),
        (["abc"], 6, True, []),
    ],
)
def test_golden_blocks(as_lines, texts, length, drop, expected):
    out = pk.pack_blocks(as_lines(texts), codes(100), length, drop_last=drop, eos=99)
    assert [ids for _, ids in blocks_of(out, "shard")] == expected


def test_blocks_never_exceed_the_length(as_lines):
    texts = as_lines(["Hello world", "This is a test", "Another line of text"])
    out = pk.pack_blocks(texts, codes(90, 1), 10, eos=99)
    ids = [i for _, ids in blocks_of(out, "shard") for i in ids]
    assert all(len(b) <= 10 for _, b in blocks_of(out, "shard")) and len(ids) == 11 + 14 + 20 + 3


@pytest.mark.parametrize("length", [1, 7, 64])
@pytest.mark.parametrize("partitions", [1, 5])
def test_packing_equals_a_sequential_buffer(spark, length, partitions):
    rng = random.Random(length)
    rows = []
    for doc in rng.sample(range(-50, 10**12), 40) + [3]:
        lines = 900 if doc == 3 else rng.randrange(1, 12)
        rows += [(doc, n, "s" + str(rng.randrange(2)), [rng.randrange(99) for _ in range(rng.choice([0, 1, 3, 200]))]) for n in range(lines)]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, split string, input_ids array<int>").repartition(partitions)
    sharded = pk.shard_lines(df, 3)
    for drop in (False, True):
        out = blocks_of(pk.pack_ids(sharded, length, drop, ["split", "shard"]), "split", "shard")
        expected = []
        for split in ("s0", "s1"):
            for shard in range(3):
                ordered = [r[3] for r in sorted(rows) if r[2] == split and r[1] % 3 == shard]
                expected += [(split, shard, b) for b in plain.pack(ordered, length, drop)]
        assert out == expected


def test_running_start_over_hot_and_tiny_groups(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), i, rng.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, w long")
    out = {(r.g, r.k): r.start for r in running_start(df.repartition(6), ["g"], ["k"], "w").collect()}
    seen = {}
    for g, k, w in rows:
        assert out[g, k] == seen.get(g, 0)
        seen[g] = seen.get(g, 0) + w
    numbers = number_rows(df, ["g"], ["k"]).filter("g = 'hot'").orderBy("k").collect()
    assert [r.position for r in numbers] == list(range(len(numbers)))


def test_packing_without_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(8)
    rows = [(d, n, rng.randrange(3), [rng.randrange(99) for _ in range(rng.randrange(9))]) for d in range(30) for n in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, shard int, input_ids array<int>").repartition(4)
    expected = [
        (s, b) for s in range(3) for b in plain.pack([r[3] for r in sorted(rows) if r[2] == s], 5, False)
    ]
    assert blocks_of(pk.pack_ids(df, 5), "shard") == expected
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shards_count_blank_lines(as_lines):
    out = pk.pack_blocks(as_lines(["a", "", "b", "  ", "", "c"]), codes(100), 4, shards=2, eos=99)
    assert blocks_of(out, "shard") == [(0, [97, 99, 98, 99]), (1, [99, 99])]


def test_unpacked_samples(as_lines):
    out = pk.unpacked_samples(as_lines(["abcdef", "", "ab"]), codes(100), 4).orderBy("line_no")
    assert [r.input_ids for r in out.collect()] == [[97, 98, 99, 0], [97, 98]]


def test_collate_golden(spark):
    rows = [(0, 0, [1, 2, 3]), (0, 1, [1, 2, 3, 4]), (0, 2, [1, 2])]
    batches = bt.batch_blocks(spark.createDataFrame(rows, "shard int, position long, input_ids array<int>"), 3)
    out = bt.collate(batches, 0).orderBy("position").collect()
    assert [(r.input_ids, r.attention_mask, r.labels) for r in out] == [
        ([1, 2, 3, 0], [1, 1, 1, 0], [1, 2, 3, -100]),
        ([1, 2, 3, 4], [1, 1, 1, 1], [1, 2, 3, 4]),
        ([1, 2, 0, 0], [1, 1, 0, 0], [1, 2, -100, -100]),
    ]


def test_the_two_masks_differ_on_a_real_pad_id(spark):
    row = spark.createDataFrame([([5, 0, 6],)], "ids array<int>").select(
        tk.pad_mask(F.col("ids"), 0).alias("value"), tk.length_mask(F.size("ids"), 4).alias("length")
    ).first()
    assert (row.value, row.length) == ([1, 0, 1], [1, 1, 1, 0])


def buffered(n, buffer, draws, rest):
    """Numbers 0 to n - 1 through a buffer, one after the other; ``draws`` are slots, ``rest`` orders what is left."""
    held, out = [], []
    for i in range(n):
        if len(held) < buffer:
            held.append(i)
        else:
            slot = draws[i - buffer]
            out.append(held[slot])
            held[slot] = i
    return out + rest(held)


@pytest.mark.parametrize("n, buffer", [(300, 10), (25, 10), (10, 10), (11, 10), (7, 10), (1, 2), (60, 2)])
def test_shuffle_equals_a_sequential_buffer(spark, n, buffer):
    draw = bt.drawn_slot(buffer, 1, ("shard",), F.col("block"))
    blocks = spark.range(2 * n).selectExpr("cast(id % 2 as int) shard", "id div 2 block", "array(cast(id as int)) input_ids")
    slots = {(r.shard, r.block): r.slot for r in blocks.select("shard", "block", draw.alias("slot")).collect()}
    for parts in (1, 5):
        got = bt.shuffle_blocks(blocks.repartition(parts), buffer, 1)
        assert got.columns == ["shard", "block", "input_ids", "position"]
        rows = got.collect()
        assert all(r.input_ids == [2 * r.block + r.shard] for r in rows)
        for shard in (0, 1):
            order = [r.block for r in sorted((r for r in rows if r.shard == shard), key=lambda r: r.position)]
            assert sorted(r.position for r in rows if r.shard == shard) == list(range(n))
            left = order[max(0, n - buffer) :]
            want = buffered(n, buffer, [slots[shard, i] for i in range(n)], lambda held: left if sorted(held) == sorted(left) else [])
            assert order == want


def test_shuffle_depends_on_seed_and_lets_samples_wait(spark):
    blocks = spark.range(2000).selectExpr("0 shard", "id block")
    order = {r.block: r.position for r in bt.shuffle_blocks(blocks, 20, 1).collect()}
    other = {r.block: r.position for r in bt.shuffle_blocks(blocks, 20, 2).collect()}
    same = {r.block: r.position for r in bt.shuffle_blocks(blocks, 1, 1).collect()}
    assert order != other and all(b == p for b, p in same.items())
    waits = [p - b for b, p in order.items()]
    # A sample can wait many times the buffer's length, and none comes more than a buffer early.
    assert max(waits) > 60 and min(waits) >= -20 and len({p % 20 for p in order.values()}) == 20


def test_the_two_parts_of_a_shuffle_read_one_exchange(spark):
    blocks = spark.range(100).selectExpr("0 shard", "id block", "array(cast(id as int)) input_ids")
    rows = bt.shuffle_blocks(blocks, 10)
    rows.write.format("noop").mode("overwrite").save()
    plan = rows._jdf.queryExecution().executedPlan()
    rows.collect()
    assert "ReusedExchange" in plan.toString()


def test_loader_schema_and_partial_batches(as_lines):
    lines = as_lines(["Hello world", "This is a test", "Another line of text"])
    cfg = LoaderConfig(batch_size=2, max_length=10, shuffle_buffer_size=4)
    samples = bt.train_val_blocks(lines, lines, codes(90, 1), cfg, eos=99)
    batches = bt.loader_batches(samples, cfg, pad=0)
    assert batches.columns == ["split", "shard", "batch_id", "row_in_batch", "input_ids", "attention_mask", "labels"]
    rows = batches.orderBy("split", "batch_id", "row_in_batch").collect()
    # 48 ids: training drops the last 8, validation keeps them, padded to its batch.
    assert [(r.split, r.batch_id, r.row_in_batch) for r in rows] == [
        ("train", 0, 0), ("train", 0, 1), ("train", 1, 0), ("train", 1, 1),
        ("val", 0, 0), ("val", 0, 1), ("val", 1, 0), ("val", 1, 1), ("val", 2, 0),
    ]
    assert len(rows[-1].input_ids) == 8 and all(len(r.input_ids) == 10 for r in rows[:-1])


def test_unpacked_loader(as_lines):
    lines = as_lines(["abc", " ", "abcdefghijkl", "d"])
    cfg = LoaderConfig(batch_size=2, max_length=5, pack_sequences=False, shuffle_buffer_size=0)
    samples = bt.train_samples(bt.split_samples(lines, codes(100), cfg), cfg)
    rows = bt.loader_batches(samples, cfg, 0, ["shard"]).orderBy("batch_id", "row_in_batch").collect()
    assert [r.input_ids for r in rows] == [[97, 98, 99, 0, 0], [97, 98, 99, 0, 1], [0]]


def test_known_widths_equal_the_longest_of_each_batch(as_lines):
    for n in (1, 8, 13):
        lines = as_lines(["x" * n, "abc"])
        for drop, buffer in ((True, 4), (True, 1), (False, 1), (False, 4)):
            cfg = LoaderConfig(batch_size=3, max_length=4, drop_last_block=drop, shuffle_buffer_size=buffer)
            samples = bt.train_val_blocks(lines, lines, codes(90, 1), cfg, eos=99)
            fast = bt.loader_batches(samples, cfg, 0)
            slow = bt.collate(bt.batch_blocks(samples, 3), 0, ["split", "shard"]).select(*fast.columns)
            assert fast.exceptAll(slow).count() == slow.exceptAll(fast).count() == 0


def test_packed_loading_needs_no_shuffle_after_the_blocks(as_lines):
    cfg = LoaderConfig(batch_size=3, max_length=4, shuffle_buffer_size=1)
    blocks = bt.split_samples(as_lines(["abcdefgh"]), codes(90, 1), cfg, eos=99)
    plan = bt.loader_batches(bt.val_samples(blocks), cfg, 0, ["shard"])._jdf.queryExecution().executedPlan().toString()
    # The one exchange joins the pieces of blocks cut at task borders.
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_running_totals_keep_the_written_order_without_a_sort(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS g", "id AS k", "1 AS w").orderBy("g", "k")
    out = running_start(rows, ["g"], ["k"], "w", in_order=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort [" not in plan
    assert [(r.g, r.start) for r in out.orderBy("g", "k").collect()] == [(g, i) for g in range(3) for i in range(334 if g == 0 else 333)]
