"""Main text of made-up pages of many layouts, and of the test pages against a plain reading of their markup."""

import html as H
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipyard.llm.html_text import content_clusters, extract_text, main_text, named_furniture, smoothed

WORDS = "river stone market village evening window harbour letter garden winter bridge morning teacher engine summer".split()


def sentence(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) for _ in range(n)).capitalize() + "."


def menu(r: random.Random) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{r.choice(WORDS)}</a></li>' for i in range(8)) + "</ul>"


FURNITURE = [
    lambda r: f"<nav>{menu(r)}</nav>",
    lambda r: f'<div class="main-menu">{menu(r)}</div>',
    lambda r: f'<header class="site"><h2>{sentence(r, 3)}</h2>{menu(r)}</header>',
    lambda r: f'<aside>{"".join(f"<p>{sentence(r, 20)}</p>" for _ in range(3))}</aside>',
    lambda r: f'<div id="sidebar-left"><h3>{sentence(r, 2)}</h3><p>{sentence(r, 25)}</p></div>',
    lambda r: f'<div class="ad"><p>{sentence(r, 30)}</p></div>',
    lambda r: f'<section class="adBanner wide">{sentence(r, 12)}</section>',
    lambda r: f'<div class="cookie_notice" role="dialog">{sentence(r, 15)}<button>OK</button></div>',
    lambda r: f'<form action="/s"><label>{sentence(r, 3)}</label><input name="q"><textarea>{sentence(r, 9)}</textarea><select><option>a<option>b</select></form>',
    lambda r: f'<script>if (a < b) {{ x = "<p>{sentence(r, 9)}</p>"; }}</script><style>p {{ color: red }}</style><noscript>{sentence(r, 5)}</noscript>',
    lambda r: f'<section id="comments"><article class="comment"><p>{sentence(r, 40)}</p></article><article class="comment"><p>{sentence(r, 30)}</p></article></section>',
    lambda r: f'<div hidden>{sentence(r, 20)}</div><p style="display: none">{sentence(r, 20)}</p>',
    lambda r: f"<footer><p>&copy; {sentence(r, 8)}</p></footer>",
    lambda r: f"<!-- {sentence(r, 9)} <p>no</p> -->",
]


def article(r: random.Random) -> tuple[str, list[str]]:
    """Markup and its blocks."""
    blocks, out = [sentence(r, 5)], []
    out.append(f"<header><h1> {blocks[0]} </h1></header>" if r.random() < 0.5 else f"<h1>{blocks[0]}</h1>")
    for _ in range(r.randrange(2, 9)):
        a, b = sentence(r, r.choice([1, 2, 20, 60])), sentence(r, 12)
        kind = r.randrange(6)
        if kind == 0:
            out.append(f"<p>{a}<br><br>{b}</p>")
            blocks += [a, b]
        elif kind == 1:
            out.append(f"<ul><li>{a}<li>{b}</ul>")
            blocks += [a, b]
        elif kind == 2:
            out.append(f'<p>{a} <a href="#">link &amp; more</a>,\n\t <b>{b}</b>')
            blocks.append(f"{a} link & more, {b}")
        elif kind == 3:
            out.append(f"<blockquote><p>{a}</p></blockquote><h2>{b}</h2>")
            blocks += [a, b]
        elif kind == 4:
            out.append(f"<table><tr><td>{a}</td><td>{b}</td></tr></table>")
            blocks.append(f"{a} {b}")
        else:
            out.append(f"<p>caf&eacute;&nbsp;&#8212; {a}&lt;b&gt;</p>")
            blocks.append(f"café — {a}<b>")
    return "".join(out), blocks


@pytest.mark.parametrize("seed", range(60))
def test_articles_among_furniture(seed):
    r = random.Random(seed)
    body, blocks = article(r)
    wrap = r.choice(["<article>{}</article>", "<main>{}</main>", '<div class="layout has-sidebar"><article class="post">{}</article></div>', '<div role="main"><div>{}</div></div>', "<main><article>{}</article></main>"])
    around = [f(r) for f in r.sample(FURNITURE, 8)]
    inner = body.replace("<h1>", r.choice(FURNITURE[4:9])(r) + "<h1>", 1) if r.random() < 0.3 and "<header>" not in body else body
    page = f"<!DOCTYPE html><html><head><title>{sentence(r, 4)}</title></head><body>{''.join(around[:4])}{wrap.format(inner)}{''.join(around[4:])}</body></html>"
    assert main_text(page) == "\n".join(blocks)


@pytest.mark.parametrize("seed", range(20))
def test_articles_without_an_element_of_their_own(seed):
    r = random.Random(100 + seed)
    blocks = [sentence(r, 4)] + [sentence(r, r.randrange(25, 60)) for _ in range(5)]
    body = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
    links = lambda: "<div>" + "".join(f'<a href="/{i}">{r.choice(WORDS)}</a> | ' for i in range(9)) + "</div>"
    page = f"<html><body><div>{links()}</div><div><div>{body}</div></div><div>{links()}</div>{FURNITURE[5](r)}</body></html>"
    assert main_text(page) == "\n".join(blocks)


def test_broken_and_empty_pages():
    assert main_text("") == main_text("<html><body><nav><a>x</a></nav></body></html>") == main_text("<script>x") == ""
    assert main_text("plain text & more") == "plain text & more"
    assert main_text("<article><p>one<p>two &amp three</article><footer>no") == "one\ntwo & three"
    assert main_text("<article><p>one</p><p>two</p><div class='a") == "one\ntwo"
    assert main_text("<article><p>one</p><!-- cut off") == "one"
    assert main_text("<article><div>one<p>two</article></div></b></article><div class=ad>no</div>") == "one\ntwo"
    assert main_text("<div class='page-nav'><article>kept</article><p>not</p></div>") == "kept"
    assert main_text("<html><head><title>no</title><style>no</style><body><p>one <ruby>two<rt>three</ruby> four") == "one twothree four"
    assert main_text('<div id="page" class="no-sidebar"><p>only text</p></div><nav>no</nav>') == "only text"
    assert main_text("<article>" + "<p>word</p>" * 20_000 + "</article>").count("\n") == 19_999


def test_clusters():
    x = np.array([0, 0, 40, 300, 5, 280, 0, 0], float)
    weight = lambda d: math.exp(-0.5 * d * d)
    by_hand = [sum(weight(j - i) * x[j] for j in range(8) if abs(i - j) <= 3) / sum(weight(j - i) for j in range(8) if abs(i - j) <= 3) for i in range(8)]
    assert np.allclose(smoothed(x), by_hand)
    assert content_clusters(x, np.ones(8)).tolist() == [False, False, True, True, True, True, False, False] or content_clusters(x, np.ones(8))[3:6].all()
    assert named_furniture({"class": "topAd"}) and named_furniture({"id": "site-footer"}) and not named_furniture({"class": "shadow heading badge"})


def test_pages_and_odd_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extract_text(pages.withColumn("text", F.lit("old")).withColumn("raw", F.col("html"))).collect():
        inside = re.search("<article>(.*?)(</article>|$)", r["raw"], re.S)[1]
        blocks = [" ".join(H.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?p>|</?h1>|<br>", inside)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])
    odd = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6), (2, "<article>😀 é</article>".encode("utf-16", "surrogatepass").decode("utf-16"), 7)], "page_id long, html string, `a.b` long")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"], r["a.b"]) for r in extract_text(odd).collect()) == [(0, "", 0, 6), (1, "", 0, 5), (1, "", 0, 5), (2, "😀 é", 3, 7)]
    assert extract_text(odd.limit(0)).columns == ["page_id", "a.b", "text", "n_chars"] and extract_text(odd.limit(0), carry=[]).count() == 0
