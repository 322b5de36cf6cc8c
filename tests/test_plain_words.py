"""Plain texts are split, counted and encoded in Python, all others in the JVM; both ways give the same."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import plain
from tokenloom.config import TokenizerConfig
from tokenloom.operators import encoding as enc
from tokenloom.operators import merges as mg
from tokenloom.operators import words as wd
from verification import queries


def texts_of_all_kinds(n: int = 400) -> list[str | None]:
    rng = random.Random(2)
    kinds = ["ab1 ", "aB 12.,-", "a' s.", "é a1", "a \n\t", "~!|x9 "]
    out = ["".join(rng.choices(rng.choice(kinds), k=rng.randrange(0, 30))) for _ in range(n)]
    return [None, "", " ", " a", "a ", "a  b", "it's", "b" * 70 + " 1", *out, None]


def test_plain_words_are_those_of_the_pattern(spark, monkeypatch):
    monkeypatch.setattr(wd, "_CHARS_AT_ONCE", 50)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts_of_all_kinds())], "k int, text string").coalesce(1)
    rows = df.select("text", wd.is_plain(F.col("text")).alias("plain"), wd.words_of(F.col("text")).alias("words")).collect()
    assert not any(r.plain for r in rows if r.text and ("'" in r.text or "  " in r.text or "\n" in r.text or not r.text.isascii()))
    kept = [r for r in rows if r.plain or r.text is None]
    assert len(kept) > 60
    given = pa.array(["cut off", *[r.text for r in kept]]).slice(1)
    got, found = [], list(wd.plain_words(given))
    assert len(found) > 5
    for row, words, per_row in found:
        assert row == len(got)
        flat = iter(words.to_pylist())
        got += [[next(flat) for _ in range(n)] for n in per_row]
    assert got == [r.words or [] for r in kept]


@pytest.mark.parametrize("dense", [0, 1 << 22])
def test_words_side_by_side_equal_those_one_by_one(monkeypatch, dense):
    monkeypatch.setattr(enc, "_DENSE_PAIRS", dense)
    monkeypatch.setattr(enc, "_WORDS_AT_ONCE", 100)
    rng = random.Random(6)
    for _ in range(5):
        sides = lambda: "".join(rng.choices("abc", k=rng.randrange(1, 4)))
        merges = {p: p[0] + p[1] for p in ((sides(), sides()) for _ in range(25))}
        ids = {t: i for i, t in enumerate([*"abc", *dict.fromkeys(merges.values())]) if i % 7}
        words = [*{"".join(rng.choices("abcd", k=rng.choice([1, 2, 5, 12, 32, 33, 60]))) for _ in range(500)}]
        for some in (words, words[:1], []):
            pool, at, size = enc._side_by_side(merges, ids, -1)(pa.array(["a", *some], pa.string()).slice(1))
            got = [pool[a : a + n].tolist() for a, n in zip(at, size)]
            assert got == [[ids.get(t, -1) for t in enc.split_word(w, merges)] for w in some]


def test_words_are_counted_with_their_first_place(spark):
    """Keys that are null give no place, keys that repeat share theirs; the batches hold rows in any order."""
    rng = random.Random(3)
    texts = texts_of_all_kinds()
    rows = [(rng.choice([None, -5, 0, 7, 1 << 61]), rng.choice([None, 0, 1, 2]), t) for t in texts]
    counts, first = Counter(), {}
    for doc, line, text in rows:
        for pos, word in enumerate(plain.words(text or "")):
            counts[word] += 1
            if doc is not None and line is not None:
                first[word] = min(first.get(word, (doc, line, pos)), (doc, line, pos))
    df = spark.createDataFrame(rows, "doc_id long, line_no int, text string").repartition(3)
    out = wd.word_counts(df).select("word", "freq", *wd.order_parts(F.col("first"))).collect()
    assert {r.word: r.freq for r in out} == counts
    assert {r.word: (int(r.doc_id), r.line_no, r.pos) for r in out if r.doc_id is not None} == first
    # Decimal keys are made for the distinct words of a batch, not for every word of the text.
    assert "MapInArrow" in wd.word_counts(df)._jdf.queryExecution().executedPlan().toString()


def test_plain_and_other_texts_encode_alike(as_lines):
    texts = texts_of_all_kinds()
    lines = as_lines(texts)
    tok = mg.train_tokenizer(lines, TokenizerConfig(vocab_size=40, min_frequency=1, unicode_normalizer=None))
    ids, pairs = tok.ids, {(m.left, m.right) for m in tok.merges}
    out = {r.line_no: r.input_ids for r in enc.encode_documents(lines.repartition(3), tok).collect()}
    for i, text in enumerate(texts):
        want = None if text is None else [ids.get(t, tok.unk_id) for w in plain.words(text) for t in plain.encode_word(w, pairs)]
        assert out[i] == want


def test_a_session_cleans_its_documents_once(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 7))) for _ in range(40)]
    docs = [(i, "\n".join(" ".join(rng.choices(vocabulary, k=30)) for _ in range(4))) for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    calls, clean = [], queries.cl.clean_lines
    monkeypatch.setattr(queries.cl, "clean_lines", lambda *a, **k: calls.append(1) or clean(*a, **k))
    assert queries.QUERIES["perplexity"](spark, str(tmp_path)).count() == 40
    levels = queries.QUERIES["perplexity_levels"](spark, str(tmp_path)).collect()
    assert {r.level for r in levels} == {0, 3, 7} and all(r.nll > 0 for r in levels)
    assert len(calls) == 1
