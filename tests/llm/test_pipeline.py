import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tokenloom.llm.quality_lm import classified
from tokenloom.llm.quality_rules import quality_rules


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(9)
    common = "the of and to in a is that it for".split()
    vocabulary = ["".join(rnd.choice(["re", "th", "an", "ing", "ou", "st"]) for _ in range(rnd.randint(2, 4))) for _ in range(600)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))

    def prose(n):
        return " ".join(rnd.choice(common) if rnd.random() < 0.3 else rnd.choice(vocabulary) for _ in range(n))

    rows, labels = [], []
    for i in range(60):
        text = prose(rnd.randint(70, 150))
        if i % 10 == 0:
            text += "\n" + passage
        rows.append((i, text, "en", "a", len(text)))
        labels.append((i, 1, 0))
    for i in range(120, 130):
        near = rows[i - 100][1].split(" ")
        near[5] = "changed"
        rows.append((i, " ".join(near), "en", "a", 1))
    rows.append((140, rows[3][1], "en", "a", 1))
    rows += [(150, "spam " * 200, "en", "a", 1), (151, " | ".join(["the", "cell"] * 60), "en", "a", 1), (152, None, "en", "a", None), (153, "the of and " + " ".join(f"xq{rnd.randrange(10**4)}zj" for _ in range(80)) + " the of and to", "en", None, 1)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], folder).cache())
        assert seen[-1].columns == docs.columns and seen[-1].dtypes == docs.dtypes, name
    start, ruled, fluent, single, cut = [{r.doc_id: r.text for r in df.collect()} for df in seen]
    passed = quality_rules(docs).filter(F.size("failed_rules") == 0)
    assert set(ruled) == {r.doc_id for r in passed.collect()} and not {150, 151, 152} & set(ruled) and 153 in ruled
    good = classified(seen[1], spark.read.parquet(f"{folder}/labels.parquet")).filter("kept")
    assert set(fluent) == {r.doc_id for r in good.collect()} and 153 not in fluent, (sorted(set(ruled) - set(fluent)))
    sets = {i: shingles(t) for i, t in fluent.items()}
    gone = {b for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert set(single) == set(fluent) - gone and gone
    windows = defaultdict(set)
    for i, t in single.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        for k in range(len(w) - 12):
            windows[tuple(w[k : k + 13])].add(i)
    for i, t in single.items():
        w = t.split()
        lost = {k + x for k in range(len(w) - 12) if min(windows[tuple(w[k : k + 13])]) < i for x in range(13)}
        assert cut[i].split() == [x for k, x in enumerate(w) if k not in lost] and (lost or cut[i] == t)
    assert sum(cut[i] != single[i] for i in single) >= 4
    for df in seen[1:]:
        df.unpersist()
    pieces = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(cut)
    ends = pieces.filter(F.col("start") + F.col("length") == F.col("doc_tokens")).select("doc_id", F.element_at("ids", -1).alias("last")).collect()
    assert len(ends) == len(cut) and {r["last"] for r in ends} == {corpus_pipeline.END_ID}


def test_repeats_leave_beside_a_column_of_the_same_name(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text, "own", 5), (2, "x " + text, "own", 6)], "doc_id long, text string, deduped string, n_chars long")
    out = corpus_pipeline.without_repeats(spark, docs, "")
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {(1, text, "own", 5), (2, "x", "own", 1)}
