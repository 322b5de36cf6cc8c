import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from tokenloom.config import CleaningConfig, JobConfig, LoaderConfig, TokenizerConfig
from tokenloom.operators import encoding as en
from tokenloom.operators import inference as inf
from tokenloom.operators import merges as mg
from tokenloom.operators import packing as pk
from tokenloom.operators.cleaning import ReportedCleaning, clean_lines, cleaning_report
from tokenloom.plans.corpus import prepare_corpus, run_job
from tokenloom.sources import lines as ln
from tokenloom.sources.artifact import load_tokenizer
from tokenloom.streaming import streams as sm

SF = "/root/testdata/sf0.001"
LOADER = LoaderConfig(batch_size=2, max_length=8, shuffle_buffer_size=4)


def test_files_in_batches_out(spark, tmp_path):
    (tmp_path / "train.txt").write_text("Hello <b>world</b>.\n")
    (tmp_path / "valid.txt").write_text("Validation <i>text</i>.\n")
    cfg = JobConfig(
        CleaningConfig(min_length=1, max_length=1000), TokenizerConfig(vocab_size=32, min_frequency=1), LOADER,
        str(tmp_path / "train.txt"), str(tmp_path / "valid.txt"),
    )
    out = run_job(spark, cfg, f"{tmp_path}/out")
    texts = {r.split: r.text for r in out.lines.collect()}
    assert texts == {"train": "hello world .", "val": "validation text ."}
    assert spark.read.text(f"{tmp_path}/out/processed_data/val").first().value == "validation text ."
    assert load_tokenizer(spark, f"{tmp_path}/out/tokenizer") == out.tokenizer
    batches = spark.read.parquet(f"{tmp_path}/out/batches")
    assert set(batches.columns) == {"split", "shard", "batch_id", "row_in_batch", "input_ids", "attention_mask", "labels"}
    pairs = {(m.left, m.right) for m in out.tokenizer.merges}
    ids = [out.tokenizer.ids.get(t, 1) for w in plain.words("validation text .") for t in plain.encode_word(w, pairs)]
    blocks = out.samples.filter("split = 'val'").orderBy("block").collect()
    assert [i for r in blocks for i in r.input_ids] == ids + [3]


def test_shards_take_turns_over_cleaned_lines(spark):
    texts = ["aaaa bbbb", "x", "cccc dddd", "eeee ffff"]
    rows = [(s, 0, i, t) for s in ("train", "val") for i, t in enumerate(texts)]
    lines = spark.createDataFrame(rows, "split string, doc_id long, line_no int, text string")
    cfg = JobConfig(
        CleaningConfig(), TokenizerConfig(vocab_size=14, min_frequency=1), LoaderConfig(max_length=64, num_workers=2)
    )
    out = prepare_corpus(lines, cfg)
    shown = en.decode_ids(out.samples.filter("split = 'val'"), out.tokenizer).orderBy("shard").collect()
    assert [(r.shard, r.text) for r in shown] == [(0, "aaaa bbbbeeee ffff"), (1, "cccc dddd")]


def test_plan_conserves_tokens_on_any_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = clean_lines(ln.doc_lines(docs)).withColumnRenamed("clean", "text")
    tok = mg.train_tokenizer(lines, TokenizerConfig(vocab_size=80))
    encoded = en.encode_documents(lines, tok)
    total = encoded.agg(F.sum(F.size("input_ids") + 1)).first()[0]
    one, seven = (pk.pack_blocks(lines.repartition(n), tok, 128, 3) for n in (1, 7))
    assert one.agg(F.sum("n")).first()[0] == total
    assert one.exceptAll(seven).count() == seven.exceptAll(one).count() == 0
    # Decoding gives the text back wherever no character is unknown.
    decoded = en.decode_ids(en.encode_texts(lines.withColumn("was", F.col("text")), tok), tok)
    known = [e.token for e in tok.vocab if e.kind == "char"]
    clear = decoded.filter(F.forall(F.split("was", ""), lambda c: c.isin(*known) | (c == "")))
    assert clear.filter("text <> was").count() == 0 and clear.count() > 1000


def test_training_on_real_text_equals_the_plain_trainer(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = clean_lines(ln.doc_lines(docs)).withColumnRenamed("clean", "text").persist()
    tok = mg.train_tokenizer(lines, TokenizerConfig(vocab_size=130))
    texts = [r.text for r in lines.orderBy(*ln.ORDER).collect()]
    chars, rules = plain.learn(texts, 130, 2)
    assert [(m.left, m.right, m.pair_freq) for m in tok.merges] == rules
    assert [e.token for e in tok.vocab if e.kind == "char"] == chars


@pytest.mark.parametrize("workers", [1, 2])
def test_every_line_is_cleaned_once(spark, monkeypatch, workers):
    from tokenloom.config import CleaningConfig, JobConfig, LoaderConfig
    from tokenloom.plans import corpus

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    lines = ln.doc_lines(spark.read.parquet(f"{SF}/documents.parquet")).withColumn("split", F.lit("train")).repartition(4)
    monkeypatch.setattr(corpus, "ReportedCleaning", lambda raw, *more: ReportedCleaning(raw.withColumn("text", counted("text")), *more))
    done = corpus.prepare_corpus(lines, JobConfig(CleaningConfig(), loader=LoaderConfig(num_workers=workers)), tokenizer=_tokenizer(spark))
    assert done.lines.count() > 1000
    report = {r.split: (r.lines_in, r.lines_kept, r.tokens) for r in done.report.collect()}
    assert report == {**{r.split: (r.lines_in, r.lines_kept, r.tokens) for r in cleaning_report(lines).collect()}, "val": (0, 0, 0)}
    # The lines and their report come from one cleaning.
    assert seen.value == lines.count() == report["train"][0]


def _tokenizer(spark):
    lines = spark.createDataFrame([(0, 0, "low lower lowest new")], "doc_id long, line_no int, text string")
    return mg.train_tokenizer(lines, TokenizerConfig(vocab_size=20, min_frequency=1))


def test_prompts_prediction_and_stripping(spark):
    tok = _tokenizer(spark)
    prompts = spark.createDataFrame([(0, " LOW new \n"), (1, "lower"), (2, "  "), (3, None)], "k int, text string")
    ready = inf.prepare_prompts(prompts, tok)
    rows = {r.k: r for r in ready.collect()}
    assert set(rows) == {0, 1} and rows[0].input_ids[0] == 2 and rows[0].input_ids[-1] == 3
    assert rows[0].attention_mask == [1] * len(rows[0].input_ids)

    def make():
        def predict(ids, mask):
            assert ids.shape == mask.shape and (ids[mask == 0] == 0).all()
            return mask.sum(axis=1)[:, None] * 100.0 + np.arange(5)[None, :]

        return predict

    scores = inf.batch_predict(ready.coalesce(1), make, ("k",), tok.pad_id, batch_size=2).collect()
    assert {r.k: (r.input_ids, r.logits) for r in scores} == {
        k: (rows[k].input_ids, [len(rows[k].input_ids) * 100.0 + t for t in range(5)]) for k in rows
    }
    low = tok.ids["low"]
    outputs = spark.createDataFrame([([2, low, 3, low, low, 3], 3), ([2], 4)], "output_ids array<int>, prompt_length int")
    assert [r.text for r in inf.strip_prompt(outputs, tok).collect()] == ["lowlow", ""]


def test_prediction_by_length(spark):
    """Same scores as in the order of arrival, hardly any padding, one model a worker, tasks of equal work."""
    rng = np.random.default_rng(3)
    sizes = np.where(rng.random(3000) < 0.4, 7, rng.integers(0, 400, 3000))  # one length holds a good third
    prompts = spark.createDataFrame([(i, list(range(int(n)))) for i, n in enumerate(sizes)], "k long, input_ids array<int>").repartition(6)
    built = spark.sparkContext.accumulator(0)

    def make():
        import os

        built.add(1)
        return lambda ids, mask: np.stack([mask.sum(1), np.where(mask == 1, ids, 0).sum(1), np.full(len(ids), os.getpid())], 1)

    shares, scores = {}, {}
    for near in (False, True):
        padding, before = inf.Padding(spark), built.value
        rows = inf.batch_predict(prompts, make, ("k",), 0, 32, near, padding).collect()
        assert len(rows) == 3000 and all(r.logits[:2] == [sizes[r.k], sum(r.input_ids)] for r in rows)
        assert built.value - before == len({r.logits[2] for r in rows})
        scores[near], shares[near] = {r.k: r.logits[:2] for r in rows}, padding.share
    assert scores[True] == scores[False] and shares[True] < 0.05 < 0.4 < shares[False]
    parts = inf.by_length(prompts, ["k"], 8).select(F.spark_partition_id().alias("p"), F.size("input_ids").alias("n"))
    work = sorted(r.w for r in parts.groupBy("p").agg(F.sum("n").alias("w")).collect())
    assert len(work) == 8 and work[-1] < 1.3 * sum(work) / 8
    assert inf.batch_predict(prompts.limit(0), make, ("k",), 0).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [5])], "k long, input_ids array<int>")
    assert {r.k: r.logits[0] for r in inf.batch_predict(odd, make, ("k",), 0).collect()} == {1: 0.0, 2: 0.0, 3: 1.0}


def test_length_parts_cover_the_histogram():
    for counts in ({5: 1000}, {1: 1, 2: 1, 3: 1}, {0: 50, 9: 3}, {n: 10 for n in range(300)}):
        parts = inf.length_parts(counts, 8)
        assert [n for n, _, _ in parts] == sorted(counts)
        assert all(0 <= first and first + width <= 8 and width > 0 for _, first, width in parts)
        assert all(a[1] + a[2] - 1 <= b[1] for a, b in zip(parts, parts[1:]))


def _arrive(spark, path, n, rows):
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{path}/{n:03d}")


def test_streams_equal_batch(spark, tmp_path):
    tok, arriving = _tokenizer(spark), tmp_path / "in"
    rows = [(d, "\n".join(f"Low <i>newest</i> {d} {k}" * (1 + (d * k) % 4) for k in range(6))) for d in range(30)]
    schema = "doc_id long, text string"
    batch = ln.doc_lines(spark.createDataFrame(rows, schema))
    packed_rows = pk.shard_lines(sm.stream_clean_encode(batch, tok), 2)
    whole = pk.pack_ids(packed_rows.withColumn("input_ids", pk.append_eos(F.col("input_ids"), tok.eos_id)), 16)

    def run_until_done():
        stream = ln.doc_lines(sm.stream_documents(spark, f"{arriving}/*", schema, files_per_trigger=1, spread_by="doc_id"))
        encoded = pk.shard_lines(sm.stream_clean_encode(stream, tok), 2)
        sm.stream_pack(encoded, 16, f"{tmp_path}/out", tok.eos_id).trigger(availableNow=True).start().awaitTermination()

    # Two runs over three files: the second goes on from the state that the first has left.
    _arrive(spark, arriving, 0, rows[:11])
    _arrive(spark, arriving, 1, rows[11:12])
    run_until_done()
    _arrive(spark, arriving, 2, rows[12:])
    run_until_done()
    streamed = sm.packed_blocks(spark, f"{tmp_path}/out").unionByName(sm.flush_remainder(spark, f"{tmp_path}/out"))
    key = ("shard", "block", "input_ids", "n")
    assert sorted(map(tuple, streamed.select(*key).collect())) == sorted(map(tuple, whole.select(*key).collect()))

    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "a.txt").write_text("low\nnew lower\n")
    lines = sm.stream_text(spark, f"{tmp_path}/text")
    out = sm.stream_clean_encode(lines, tok).writeStream.format("memory").queryName("coded").trigger(availableNow=True)
    out.start().awaitTermination()
    assert spark.table("coded").count() == 2


def test_text_files_in_three_triggers_equal_batch(spark, tmp_path):
    """Files of many blocks, blank lines, an empty file; a restart between triggers and one in the middle of a batch."""
    tok, folder, out = _tokenizer(spark), tmp_path / "texts", f"{tmp_path}/out"
    folder.mkdir()

    def arrive(*names):
        for name in names:
            body = "" if name == "c0" else "\n".join("" if k % 7 == 3 else f"low newest lower {name} {k}" for k in range(400))
            (folder / f".{name}").write_text(body)
            (folder / f".{name}").rename(folder / f"{name}.txt")

    def rows_of(lines):
        encoded = sm.stream_clean_encode(lines.withColumn("line_no", F.col("line_no").cast("int")), tok)
        return pk.shard_lines(encoded, 3)

    broken = []

    def fails_once(lines):
        if not broken and lines.filter(F.col("file").endswith("b1.txt")).count():
            broken.append(1)
            raise RuntimeError("lost")
        return rows_of(lines)

    def run(then):
        stream = sm.stream_text(spark, str(folder), files_per_trigger=2)
        writer = sm.stream_pack(stream, 16, out, tok.eos_id, sm.numbered(out, then))
        writer.trigger(availableNow=True).start().awaitTermination()

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several blocks a file
    try:
        arrive("a0", "a1")
        run(rows_of)
        arrive("b0", "b1")
        with pytest.raises(Exception, match="lost"):
            run(fails_once)
        run(fails_once)
        arrive("c0", "c1")
        run(rows_of)
        lines = ln.read_text_lines(spark, str(folder))
        assert lines.filter("line_no > 0").select(F.spark_partition_id()).distinct().count() > 1
        want = pk.pack_ids(rows_of(lines).withColumn("input_ids", pk.append_eos(F.col("input_ids"), tok.eos_id)), 16)
        got = sm.packed_blocks(spark, out).unionByName(sm.flush_remainder(spark, out))
        key = ("shard", "block", "input_ids", "n")
        assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
        files = {r.file.rsplit("/", 1)[-1]: (r.doc_id, r["lines"]) for r in sm.numbered_files(spark, out).collect()}
        # The empty file has no lines, and so no number; names are in order of arrival here.
        assert files == {"a0.txt": (0, 400), "a1.txt": (1, 400), "b0.txt": (2, 400), "b1.txt": (3, 400), "c1.txt": (4, 400)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_report_of_named_splits_only(spark, tmp_path):
    rows = [("a", "One two three four"), ("a", None), ("b", "short"), (None, "Some line of text"), ("c", "Five <b>words</b> are in here")]
    lines = spark.createDataFrame(rows, "split string, text string")
    cleaning = ReportedCleaning(lines, ["a", "b", "none"], CleaningConfig(min_length=8))
    cleaning.lines.write.parquet(f"{tmp_path}/kept")
    assert sorted(map(tuple, cleaning.report().collect())) == [("a", 2, 1, 4), ("b", 1, 0, 0), ("none", 0, 0, 0)]
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 3 and cleaning.lines.columns == ["split", "clean"]


def test_no_stream_output_yet(spark, tmp_path):
    assert sm.flush_remainder(spark, f"{tmp_path}/none").count() == 0


def test_queries_and_sql_go_together(spark):
    import __spark_entry__ as entry

    from verification.oracles import ORACLES
    from verification.queries import QUERIES

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(ORACLES) == set(QUERIES) and set(sql) <= set(queries) and set(QUERIES) <= set(queries)
    assert entry.entry(spark).limit(1).count() == 1


def test_a_stream_is_spread_by_the_partitions_of_a_shuffle(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/docs")
    seen = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        stream = sm.stream_documents(spark, f"{tmp_path}/docs", "id long", spread_by="id")
        writer = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.rdd.getNumPartitions()))
        writer.option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert seen == [24]


def test_words_to_train_on_are_counted_once(spark):
    from verification import queries

    words = queries.kept_words(spark, SF)
    assert "Aggregate" not in words._jdf.queryExecution().optimizedPlan().toString() and words.count() > 0
    assert queries.kept_words(spark, SF) is words
