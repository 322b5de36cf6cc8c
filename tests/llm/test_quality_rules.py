import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenloom.llm import queries
from tokenloom.llm.quality_rules import COUNTS, RULES, Rule, keep_good, quality_rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
    }


def check(spark, texts):
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in quality_rules(df).collect():
        assert {k: r.quality[k] for k in plain("")} == plain(texts[r.doc_id]), texts[r.doc_id]


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="ab #|\n\té \x0b", max_size=60)), min_size=1, max_size=40))
def test_counts_on_any_text(spark, texts):
    check(spark, texts)


def test_counts_on_long_and_odd_texts(spark):
    check(spark, [None, "", " \n ", "a", "a b", "a b c a b c", "x " * 20000, " ".join(map(str, range(30000))) + " 5 6 7", "l\nl\n \nl"])


@pytest.fixture
def docs(spark):
    good = "the cat and the dog went to that house of " + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    bad = {"short": "the of and", "table": " | ".join(["the", "cell"] * 40), "shout": " ".join(["THE!!", "NOISE!!"] * 40), "same": "spam " * 80}
    rows = [(0, good, "en", "x"), (0, good, "en", "x"), (9, good, None, "x"), *[(i + 1, t, "en", "x") for i, t in enumerate(bad.values())], (7, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, failed_rules string")


def test_verdicts(docs):
    got = {r.doc_id: set(r._failed_rules) for r in quality_rules(docs).collect()}
    assert got[0] == got[9] == set()
    assert "length" in got[1] and "symbols" in got[2] and "shouting" in got[3] and "repetition" in got[4] and "length" in got[7]
    kept = keep_good(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 0, 9]


def test_empty_table_and_own_rules(docs):
    assert quality_rules(docs.limit(0)).collect() == []
    assert keep_good(docs, (Rule("none", "n_words", low=0),)).count() == docs.count()
    assert {r.metric.split(" ")[0] for r in RULES} <= set(COUNTS)


def test_language_without_stop_words(spark):
    polish = " ".join(f"słowo{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    rows = [(0, polish, "pl"), (1, polish, "en"), (2, polish, None), (3, "spam " * 80, "pl")]
    got = {r.doc_id: set(r.failed_rules) for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[0] == set() and got[1] == got[2] == {"stop_words"} and "repetition" in got[3] and "stop_words" not in got[3]


def test_query_and_sql_agree_on_other_languages(spark, tmp_path):
    """Languages without a list of stop words, and none at all."""
    words = [f"slowo{i}" for i in range(90)]
    rows = [(i, " ".join(words), lang) for i, lang in enumerate(["pl", None, "en", "", "de"])] + [(9, None, "pl"), (10, "x", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.op9_quality_rules(spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = db.execute(f"SELECT doc_id, {', '.join(COUNTS)}, base_failed, kept FROM ({queries.ORACLES['op9_quality_rules']})").fetchall()
    assert got == set(want) and {r[0] for r in got if r[-1]} == {0, 3}
