"""HTML extraction: wrappers, planted articles in templates of several kinds, odd pages."""

import random
import time

import pytest
from pyspark.sql import functions as F

from demandspark.llm import html_extract as H

WORDS = "river stone market winter letter garden señal übung été cloud engine paper light window table".split()


def prose(draw, n):
    return " ".join(draw.choice(WORDS) for _ in range(n)).capitalize() + "."


def semantic(draw, blocks):
    body = "".join(f"<h2>{b}</h2>" if len(b) < 40 else f"<p class='lead'>{b}</p>" for b in blocks)
    comments = "".join(f"<article class='comment'><p>{prose(draw, 30)}</p></article>" for _ in range(draw.randint(0, 4)))
    return (
        f"<!doctype html><html><head><title>{prose(draw, 3)}</title><style>p{{}}</style></head><body><div id=cookie-notice><p>We use cookies.</p></div><header><h1>Site</h1></header>"
        f"<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav><main><article><header>By someone</header>{body}<aside><p>{prose(draw, 60)}</p></aside>"
        f"<form><label>Mail</label><input name=a><button>Go</button></form></article></main><section class='comments'>{comments}</section><div class=sidebar>{prose(draw, 90)}</div><footer>&copy; us</footer></body></html>"
    )


def plain(draw, blocks):
    """Divisions without names, tables, unclosed paragraphs; a notice that is the same everywhere."""
    body = "".join(f"<p>{b}\n" if i % 2 else f"<div><p>{b}</p></div>" for i, b in enumerate(blocks))
    links = "".join(f"<li><a href='/{draw.randint(0, 99)}'>{prose(draw, 2)}</a></li>" for _ in range(draw.randint(3, 6)))
    return (
        f"<html><body><table><tr><td><ul>{links}</ul><td><div><div><blockquote>Reprint only with leave of the publisher.</blockquote>{body}</div></div></table>"
        f"<div><a href='/x'>imprint</a> <a href='/y'>contact us now</a></div><script>if (a < b) {{ document.write('<p>no</p>') }}</script></body></html>"
    )


@pytest.mark.parametrize("template", [semantic, plain])
def test_planted_articles(spark, template):
    draw = random.Random(3)
    rows, want = [], {}
    for i in range(80):
        blocks = [prose(draw, draw.choice([3, 25, 60])) for _ in range(draw.randint(2, 9))]
        if all(len(b) < 200 for b in blocks):
            blocks.append(prose(draw, 60))
        rows.append((i, f"https://Site.example/{i}?x#y", template(draw, blocks)))
        want[i] = " ".join(blocks)
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    assert got == want


ODD = {
    None: "",
    "": "",
    "<p></p>": "",
    "just   text &amp; no &lt;tag&gt;\n": "just text & no <tag>",
    "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
    "<article>a<b>b</b>c<br>d<!-- x --><p>e&nbsp; f&#x41;&ampg &bogus; &am</p></article>": "abc d e fA&g &bogus; &am",
    "<article><p>one<p>two<div>three</article><footer>no</footer>": "one two three",
    "<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>": "one two a b",
    "<body><article>x <span class='ad'>buy</span> y</article>": "x y",
    "<article><p>open": "open",
    "<article><p title='a > b' hidden>in</p><![CDATA[raw <x>]]></article": "in raw <x>",
    "<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + "<p>end</article>": "deep end",
    "<a 'b": "",
    "<script>only code": "",
}


def test_odd_pages(spark):
    rows = [(i, f"http://h{i}.example/" if i % 4 else None, page) for i, page in enumerate(ODD)]
    rows += rows[:3] + [(None, "no scheme", "<article>z</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "text", "plan", "salt", "shard", "n_chars", "wrapper")})
    out = H.extract(df.repartition(2))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    wanted = list(ODD.values())
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in out.collect()) == sorted((str(i), t, len(t)) for i, t in [*enumerate(wanted), *list(enumerate(wanted))[:3], (None, "z")])


def test_empty(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_shuffled_plans_give_the_same(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    before = sorted(map(tuple, H.extract(pages).collect()))
    monkeypatch.setattr(H, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(H, "SHARD", 2)
    assert sorted(map(tuple, H.extract(pages.repartition(7)).collect())) == before


def wrapper(*pages):
    out = H.wrapper_of(H.parse(pages[0]))
    for p in pages[1:]:
        H.absorb(out, H.parse(p))
    return out.expression()


def test_repeats_become_groups():
    assert wrapper("<div><p>a<p>b<p>c</div>") == "<#root><div>(<p>#</>)+</></>"
    assert wrapper("<div><h2>a</h2><p>b<p>c<h2>d</h2><p>e</div>") == "<#root><div>(<h2>#</> (<p>#</>)+)+</></>"


def test_mismatches_become_optional():
    assert wrapper("<div><p>a</div>", "<div><h2>t</h2><p>a</div>") == "<#root><div><h2>#</>? <p>#</></></>"
    assert wrapper("<div><h2>t</h2><p>a</div>", "<div><p>b</div>") == "<#root><div><h2>#</>? <p>#</></></>"
    assert wrapper("<div><p>a</div>", "<div><p>a<ul><li>x</ul></div>") == "<#root><div><p>#</> <ul><li>#</></>?</></>"


def test_alignment_of_wrappers_is_that_of_their_pages():
    pages = ["<div><h2>a</h2><p>b</div>", "<div><p>x<p>y</div>", "<div><h2>a</h2><p>b<h2>c</h2><p>d</div>"]
    left, right = H.wrapper_of(H.parse(pages[0])), H.wrapper_of(H.parse(pages[1]))
    H.absorb(right, H.parse(pages[2]))
    H.absorb(left, H.thawed(H.frozen(right)))
    assert left.pages == 3 and left.expression() == wrapper(*pages)


def test_same_texts_are_template_only_on_many_pages():
    def text(n):
        trees = [H.parse(f"<article><div>Same in all.</div><p>{'x' * (i + 1)}</p></article>") for i in range(n)]
        w = H.wrapper_of(trees[0])
        for t in trees[1:]:
            H.absorb(w, t)
        return " ".join(H.matched(trees[1], H.Plan(H.plan_of(w))))

    assert text(H.SAME_PAGES - 1) == "Same in all. xx"
    assert text(H.SAME_PAGES) == "xx"


@pytest.mark.parametrize("piece", ["<div>", "<ul><li>", "<script>", "<p a=\"b' ", "<!x ", "</p>", "<![CDATA[", "<a 'x ", "<div><p>"])
def test_hostile_pages_take_little_time(piece):
    began = time.time()
    H.main_text(piece * 20_000, None)
    assert time.time() - began < 10


def test_very_long_page():
    page = "<article>" + "<p>word &amp; word</p>" * 100_000 + "</article>"
    assert H.main_text(page, None) == " ".join(["word & word"] * 100_000)
