import html
import random
from html.entities import html5

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokenloom.config import CleaningConfig
from tokenloom.functions import text as tx
from tokenloom.operators.cleaning import clean_lines, cleaning_report, with_clean_text

CFG = CleaningConfig(min_length=5, max_length=1000)


def cleaned(lines, cfg):
    return [r.clean for r in with_clean_text(lines, cfg).orderBy("line_no").collect()]


def test_golden_rows(as_lines):
    given_ = [
        "Hello <b>World</b> <script>alert('test')</script>", "Hello! @#$%^& World?", "hi", "a" * 1001, "Short",
        "Hello <b>World</b>", "Test @#$ Text", None,
    ]
    expected = ["hello world alert test", "hello! world?", None, None, None, "hello world", "test text", None]
    assert cleaned(as_lines(given_), CFG) == expected


def test_entities_and_unicode_white_space(as_lines):
    rows = ["&lt;b&gt;word&lt;/b&gt; here", "x\u2003 y\u001cz1", None, "&#72;&eacute;llo &notit; &amp;lt;"]
    keep = CleaningConfig(remove_special_chars=False)
    assert cleaned(as_lines(rows), CleaningConfig()) == ["word here", "x y z1", None, "h llo it; lt;"]
    assert cleaned(as_lines(rows), keep) == ["word here", "x y z1", None, "héllo ¬it; &lt;"]


def test_rejected_lines_go_and_order_stays(as_lines):
    out = clean_lines(as_lines(["Hello <b>World</b>", "Test @#$ Text", "Short", None]), CFG)
    assert [(r.line_no, r.clean) for r in out.orderBy("line_no").collect()] == [(0, "hello world"), (1, "test text")]


LINE = " <b>Tom</b> &amp; JERRY\t(1 < 2)\u00a0"
# Tags removed, special characters masked, lower case: the line that each choice leaves.
TOGGLED = {
    (True, True, True): "tom jerry 1 2",
    (True, True, False): "Tom JERRY 1 2",
    (True, False, True): "tom & jerry (1 < 2)",
    (True, False, False): "Tom & JERRY (1 < 2)",
    (False, True, True): "b tom b jerry 1 2",
    (False, True, False): "b Tom b JERRY 1 2",
    (False, False, True): "<b>tom</b> & jerry (1 < 2)",
    (False, False, False): "<b>Tom</b> & JERRY (1 < 2)",
}


@pytest.mark.parametrize("toggles", TOGGLED)
def test_every_toggle(as_lines, toggles):
    want = TOGGLED[toggles]
    n = len(want)
    assert cleaned(as_lines([LINE]), CleaningConfig(*toggles)) == [want]
    bounds = [((n - 1, n), want), ((n, n + 5), None), ((0, n - 1), None)]
    for (low, high), kept in bounds:
        assert cleaned(as_lines([LINE]), CleaningConfig(*toggles, low, high)) == [kept]


ALPHABET = "aZ9 \t\n\x1c\x1f\x85\u2003\u3000<>&;#!?-éİΣßＡ\U0001f600/b"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(ALPHABET, max_size=25), min_size=1, max_size=80))
def test_properties_of_cleaned_lines(as_lines, rows):
    once = cleaned(as_lines(rows), CleaningConfig(min_length=2, max_length=12))
    assert len(once) == len(rows)
    for line in filter(None, once):
        assert 2 < len(line) <= 12 and line == line.lower() and "  " not in line and line[0] != " " != line[-1]
        assert set(line) <= set("abcdefghijklmnopqrstuvwxyz0123456789.,!?;:- ")
    again = cleaned(as_lines(once), CleaningConfig(min_length=2, max_length=12))
    assert again == once
    raw = cleaned(as_lines(rows), CleaningConfig(False, False, False, 0))
    for line, text in zip(raw, rows):
        assert "".join((line or "").split()) == "".join(html.unescape(text).split())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00")), min_size=1, max_size=60))
def test_single_steps_on_any_text(as_lines, rows):
    out = as_lines(rows).select(
        "line_no",
        tx.html_unescape(F.col("text")).alias("u"),
        tx.strip_text(F.col("text")).alias("s"),
        tx.strip_tags(F.col("text")).alias("t"),
        tx.mask_special_chars(F.col("text")).alias("m"),
        tx.collapse_ws(F.col("text")).alias("c"),
    )
    kept = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.,!?;:-")
    for row, text in zip(out.orderBy("line_no").collect(), rows):
        assert row.u == html.unescape(text)
        assert row.s == text.strip()
        assert row.c.split() == text.split() and row.c == " ".join(row.c.split())
        assert len(row.m) == len(text)
        assert all(a == b if b in kept or b.isspace() else a == " " for a, b in zip(row.m, text))
        opened, closed = text.find("<"), text.rfind(">")
        assert row.t == text if min(opened, closed) < 0 or closed < opened else len(row.t) <= len(text)


@pytest.mark.parametrize(
    "text, want",
    [("a<b>c", "a c"), ("<>", "<>"), ("a<>b>c", "a<>b>c"), ("<<x>y", " y"), ("1 < 2 > 3", "1   3"), ("x>y<z", "x>y<z"), ("<p\nq>r", " r")],
)
def test_tags(as_lines, text, want):
    assert as_lines([text]).select(tx.strip_tags(F.col("text")).alias("t")).first().t == want


def test_report(spark):
    rows = [("train", 0, 0, "One two  three"), ("train", 0, 1, "x"), ("val", 1, 0, "<i>only</i> four words here")]
    lines = spark.createDataFrame(rows, "split string, doc_id long, line_no int, text string")
    out = {r.split: (r.lines_in, r.lines_kept, r.tokens) for r in cleaning_report(lines).collect()}
    assert out == {"train": (2, 1, 3), "val": (1, 1, 4)}


def test_length_rule_does_not_repeat_the_regex(as_lines):
    plan = clean_lines(as_lines(["abc"]), CFG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(tx._UNWANTED) == 1
    assert "Python" not in plan


def test_character_references_equal_the_standard_library(as_lines):
    rng = random.Random(1)
    names, codes = list(html5), [0, 1, 8, 9, 10, 11, 13, 14, 31, 32, 65, 127, 128, 129, 150, 159, 160, 0xD800, 0xFDD0, 0xFFFE, 0x1FFFE, 0x10FFFF, 0x110000, 10**12]
    odd = ["&", "&#", "&#x", "&#xg;", "&;", "&&", "&#;", "& amp;", "&notit;", "&notin", "&" + "a" * 40 + ";", "&ampamp;", "text ", "é😀", "\n", "<b>"]

    def part():
        kind = rng.randrange(5)
        if kind == 0:
            return "&" + rng.choice(names) + rng.choice(["", "x", "x;", ";", "=1"])
        if kind == 1:
            return f"&#{rng.choice(codes)}{rng.choice([';', '', 'a'])}"
        if kind == 2:
            return f"&#{rng.choice('xX')}{rng.choice(['', '000'])}{rng.choice(codes):x}{rng.choice([';', '', 'g'])}"
        return rng.choice(odd)

    texts = ["".join(part() for _ in range(rng.randint(0, 8))) for _ in range(3000)]
    texts += [f"&{n}{end}" for n in names for end in ("", "q", ";")] + ["&" + n[:-1] for n in names]
    rows = as_lines(texts + [None]).select("line_no", tx.html_unescape(F.col("text")).alias("t")).orderBy("line_no").collect()
    assert [r.t for r in rows] == [*map(html.unescape, texts), None]
