import pytest
from pyspark.sql import functions as F

from tokenloom import staging
from tokenloom.config import JobConfig, LoaderConfig, load_job_config
from tokenloom.sources import lines as ln
from tokenloom.sources.tables import spread


def test_package_entry_points_import():
    import tokenloom

    assert all(hasattr(tokenloom, name) for name in tokenloom.__all__)


@pytest.mark.parametrize(
    "text, expected",
    [("a\nb", ["a", "b"]), ("a\n\nb\n", ["a", "", "b"]), ("a\r\nb\rc\r\n", ["a", "b", "c"]), ("", []), ("\n", [""]), (None, [])],
)
def test_lines_are_those_of_a_file(spark, text, expected):
    rows = ln.doc_lines(spark.createDataFrame([(7, text)], "doc_id long, text string")).orderBy("line_no").collect()
    assert [(r.doc_id, r.line_no, r.text) for r in rows] == [(7, i, t) for i, t in enumerate(expected)]


HEADINGS = [" = Title = ", "", "  text  ", "= = Sub = =", "a = b", " ", None]


def test_blank_and_heading_lines(as_lines):
    kept = ln.drop_heading_lines(as_lines(HEADINGS)).orderBy("line_no").collect()
    assert [(r.line_no, r.text) for r in kept] == [(2, "text"), (4, "a = b")]
    assert ln.nonblank_lines(as_lines(HEADINGS)).count() == 4


def test_data_set_on_disk_with_stats_and_preview(spark, tmp_path):
    rows = [(s, d, i, t) for d, s in enumerate(["train", "validation", "test"]) for i, t in enumerate(HEADINGS * (3 - d))]
    lines = spark.createDataFrame(rows, "split string, doc_id long, line_no int, text string")
    path = f"{tmp_path}/set"
    written = ln.write_dataset(lines, path)
    assert {p.name for p in (tmp_path / "set").glob("split=*")} == {"split=train", "split=valid", "split=test"}
    stats = {r.split: r for r in ln.split_stats(written, path, "n", "raw", "here", "d").collect()}
    assert {s: r.num_lines for s, r in stats.items()} == {"train": 6, "validation": 4, "test": 2}
    assert stats["validation"].path == f"{path}/split=valid" and stats["test"].version == "raw"
    top = ln.preview_sample(lines, ["train", "validation"]).collect()
    assert [(r.split, r.line_no) for r in top] == [(s, i) for s in ("train", "validation") for i in range(5)]


def test_text_files_are_numbered_across_blocks(spark, tmp_path):
    files = {"a.txt": [f"line {i}" if i % 5 else "" for i in range(4000)], "b.txt": ["x", "", "y"]}
    for name, texts in files.items():
        (tmp_path / name).write_text("\n".join(texts) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = ln.read_text_lines(spark, [f"{tmp_path}/{n}" for n in files]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, texts in files.items():
        got = sorted((r.line_no, r.text) for r in rows if r.file.endswith(name))
        assert got == list(enumerate(texts))


def test_text_sink_keeps_the_order(spark, tmp_path):
    lines = spark.createDataFrame([(0, i, f"t{i}") for i in range(200)], "doc_id long, line_no int, text string")
    ln.write_text_lines(lines.repartition(6), f"{tmp_path}/out", order=ln.ORDER)
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts).split() == [f"t{i}" for i in range(200)]


def test_spread_only_widens_narrow_tables(spark):
    assert spread(spark.range(100).coalesce(1), "id").rdd.getNumPartitions() == 8
    assert spread(spark.range(100, numPartitions=11), "id").rdd.getNumPartitions() == 11


def test_text_files_are_ordered_by_name_wherever_they_lie(spark, tmp_path):
    seen = []
    for folder in ("here", "there/deeper"):
        (tmp_path / folder).mkdir(parents=True)
        for name in ("b.txt", "a.txt", "c.txt"):
            (tmp_path / folder / name).write_text(f"{name} one\ntwo\n")
        rows = ln.read_text_lines(spark, f"{tmp_path}/{folder}").orderBy(*ln.ORDER).collect()
        seen.append([(r.doc_id, r.line_no, r.text) for r in rows])
    assert seen[0] == seen[1] == [(d, i, t) for d, n in enumerate("abc") for i, t in enumerate([f"{n}.txt one", "two"])]


def test_scratch_blocks_remove_what_they_stage(spark):
    import os

    with staging.scratch(spark):
        kept = staging.stage(spark.range(3), "inside").inputFiles()
        assert kept
    assert not any(os.path.exists(f.removeprefix("file://")) for f in kept)
    outside = staging.stage(spark.range(3), "outside")
    staging.discard(spark, outside.inputFiles()[0].rsplit("/", 1)[0])


def test_scratch_goes_to_the_configured_folder(spark):
    assert staging.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = staging.stage(spark.range(5), "t")
    assert staged.count() == 5 and all(f.startswith("file:") for f in staged.inputFiles())


def test_job_file(tmp_path):
    path = tmp_path / "job.yaml"
    path.write_text(
        "data:\n  train_path: a.txt\n  cleaning: {min_length: 20, lowercase: false}\n"
        "  dataloader: {batch_size: 2, num_workers: 2, prefetch_factor: 4}\n"
        "tokenizer: {min_frequency: 1}\nmodel: {vocab_size: 99}\ntraining: {max_steps: 1}\n"
    )
    cfg = load_job_config(str(path))
    assert (cfg.cleaning.min_length, cfg.cleaning.lowercase, cfg.train_path, cfg.val_path) == (20, False, "a.txt", None)
    assert (cfg.tokenizer.vocab_size, cfg.tokenizer.min_frequency) == (99, 1)
    assert (cfg.loader.batch_size, cfg.loader.shards, LoaderConfig().shards) == (2, 2, 1)
    assert load_job_config({}) == JobConfig(loader=LoaderConfig(num_workers=4))
    for section in ({"data": {"cleaning": {"min_lenght": 3}}}, {"data": {"dataloader": {"workers": 1}}}, {"tokenizer": {"size": 1}}):
        with pytest.raises(ValueError, match="unknown settings"):
            load_job_config(section)
