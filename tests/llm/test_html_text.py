import pytest
from pyspark.sql import functions as F

from tokenloom.llm.html_text import extract_text, main_text

PARAS = [f"Paragraph {i} of the story, with enough words &amp; commas, to look like the running text of an article." for i in range(4)]
MENU = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in "home news sport culture travel money".split())
WANT = [p.replace("&amp;", "&") for p in PARAS]


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


CASES = {
    "semantic": (f"<nav><ul>{MENU}</ul></nav><article><h1>Head &copy; line</h1>{''.join(f'<p>{p}</p>' for p in PARAS)}</article><footer>f</footer>", ["Head © line", *WANT]),
    "no article element": (f"<div class='menu'><ul>{MENU}</ul></div><div id=content>{''.join(f'<p>{p}</p>' for p in PARAS)}</div><div class='footer'>Imprint</div>", WANT),
    "no class names": (f"<div><ul>{MENU}</ul></div><div>{''.join(f'<p>{p}</p>' for p in PARAS)}</div>", WANT),
    "sections": (f"<ul>{MENU}</ul><div><div>{''.join(f'<p>{p}</p>' for p in PARAS[:2])}</div><div>{''.join(f'<p>{p}</p>' for p in PARAS[2:])}</div></div>", WANT),
    "open tags": (f"<nav><ul>{MENU}</ul></nav><article><p><b>{PARAS[0]}<br><p>{PARAS[1]}<ul><li>one<li>two</ul><p>{PARAS[2]}</article>", [*WANT[:2], "one", "two", WANT[2]]),
    "inside the article": (
        f"<main><header><h1>Title</h1></header><p>{PARAS[0]}</p><div class='ad'>Buy!</div><aside>See also</aside><p>{PARAS[1]}</p><form><input value=x>Mail</form>"
        f"<section id=comments><article class=comment><p>First!</p></article></section></main><div class='cookie-notice'>We use cookies</div>",
        ["Title", *WANT[:2]],
    ),
    "layout classes": (f"<div class='layout has-sidebar'><div class=sidebar>{MENU}</div><article><p data-x='a hidden gem'>{PARAS[0]}</p></article></div>", WANT[:1]),
    "misnested": (f"<article><b><p>{PARAS[0]}</b> and  \n more</p><p>a &lt; b, 3 < 4 &amp;amp; &#8364;&nbsp;5</p></article>", [WANT[0] + " and more", "a < b, 3 < 4 &amp; € 5"]),
    "comment and cdata": (f"<article><!-- <p>no</p> --><p>{PARAS[0]}</p><!----><!--></article>--><p>x</p>", [WANT[0], "-->", "x"]),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(name):
    body, want = CASES[name]
    got = main_text(page(body)).split("\n\n")
    assert got == want


P = [f"<p>{p}</p>" for p in PARAS]
LAYOUTS = {
    "body inside the article": (f"<ul>{MENU}</ul><article><h1>Head</h1><p>Standfirst</p><div itemprop=articleBody>{''.join(P)}</div></article>", ["Head", "Standfirst", *WANT]),
    "article inside an article": (f"<ul>{MENU}</ul><article><h1>Head</h1>{P[0]}<article>{''.join(P[1:])}</article></article>", ["Head", *WANT]),
    "main with two articles": (f"<ul>{MENU}</ul><main><article>{''.join(P[:3])}</article><article>{P[3]}</article></main>", WANT),
    "two articles without a main": (f"<ul>{MENU}</ul><div><article>{''.join(P[:2])}</article><article>{''.join(P[2:])}</article></div>", WANT),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_articles_in_parts(name):
    body, want = LAYOUTS[name]
    assert main_text(page(body)).split("\n\n") == want


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("  \n") == main_text("<html></html>") == ""
    assert main_text("just text") == "just text"
    assert main_text("<p>cut <b") == "cut"  # a tag that the page's end cuts off is no text
    deep = "<div>" * 20_000 + "deep" + "</span>" * 20_000 + "</div>" * 20_000
    assert main_text(deep) == "deep"
    assert len(main_text("<p>" + "word " * 300_000)) == 5 * 300_000 - 1


def test_column(spark):
    rows = [(1, page(CASES["semantic"][0]), "x"), (1, page(CASES["semantic"][0]), "x"), (2, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract_text(pages)
    assert got.columns == ["page_id", "html", "text", "_text"]
    assert sorted(r._text for r in got.collect()) == ["", *["\n\n".join(CASES["semantic"][1])] * 2]
    assert extract_text(pages.limit(0)).select(F.max("_text")).first()[0] is None
