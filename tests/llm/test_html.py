"""Main text: leaves of odd markup, slopes by differences, accuracy on held-out and unseen pages."""

import html as entities
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from triplens.llm import html

PAGES = "/root/testdata/sf0.01/pages.parquet"


def plain_article(page):
    """The article of the given pages, which all name it."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1|article)>", inner)
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.read.parquet(PAGES)
    return html.train(pages.where("page_id % 2 = 0"))


def extracted(labeller, page):
    found = html.leaves(page)
    return html.main_text(found, labeller.probabilities([found])[0])


def test_leaves():
    page = "<body><p>a &amp; b<br>c <b>d<p>e\n f</b><ul><li>x<li><a href='>'>y</a> z</ul><script>if (a<b) '</p>'</script><!-- <p>q --><div CLASS='Site-Nav' id=top>1 < 2</div>tail"
    got = html.leaves(page)
    assert [t for _, t, _ in got] == ["a & b c d", "e f", "x", "y z", "1 < 2", "tail"]
    assert {".site", ".nav", ".top"} <= set(got[4][0]) and got[3][2] == pytest.approx(1 / 3)
    for odd in (None, "", "   ", "<", "<p", "<a b=\"", "</p></p>", "<!--", "<script>", "<p>&#0;&#xZ;&bogus;", "<p <p <p>x"):
        html.leaves(odd)


def test_long_pages_take_linear_time():
    for part in ("<p>x", "<a '", "<b>x</i>", "<!--", "<", "&#", "<div>x", "<b><p>x", "<i>"):
        html.leaves(part * 30_000)


def test_slopes_by_differences():
    net = html.BlockLabeller(1)
    rng = np.random.default_rng(0)
    pages = [[(("p", f".c{i}"), "word " * int(rng.integers(1, 9)), 0.1 * i) for i in range(n)] for n in (3, 5, 1)]
    labels = [[1, 0, 1], [0, 0, 1, 1, 0], [1]]

    def loss():
        net._paths.clear()
        p = np.concatenate(net.probabilities(pages))
        y = np.concatenate(labels)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, slope in net._slopes(pages, labels).items():
        at = np.unravel_index(np.argmax(np.abs(slope)), slope.shape)
        keep = net.p[name][at]
        net.p[name][at] = keep + 1e-5
        up = loss()
        net.p[name][at] = keep - 1e-5
        down = loss()
        net.p[name][at] = keep
        assert slope[at] == pytest.approx((up - down) / 2e-5, rel=1e-3), name


def test_held_out_pages(spark, labeller):
    pages = spark.read.parquet(PAGES).where("page_id % 2 = 1")
    got = {r.page_id: r.text for r in html.extract(pages, labeller).collect()}
    rows = pages.collect()
    right = sum(got[r.page_id] == plain_article(r.html) for r in rows)
    assert right >= 0.99 * len(rows)


def test_unseen_templates(labeller):
    words = "The onner thand of ethe and reati in the shat with erenes oned."
    body = f"<p>{words}</p><p>{words} {words}</p><h2>Thand reati</h2><p>{words}</p>"
    want = "\n".join(["Onner thand", words, f"{words} {words}", "Thand reati", words])
    clutter = [
        f"<div class='cookie-notice'><p>{words}</p></div>", "<form><label>Name</label><p>Send us a word.</p></form>",
        f"<aside><p>{words}</p></aside>", f"<section id='comments'><div class='comment'><p>{words}</p></div></section>",
        "<ul class='menu'><li><a href='/'>Home</a><li><a href='/x'>News</a></ul>", f"<div class='sidebar'>{words}</div>", f"<div class='advert'>{words}</div>",
    ]
    mains = ["<main>{}</main>", "<div class='content'>{}</div>", "<div id='wrapper'><article class='post'>{}</article></div>", "<div class='entry-content'>{}</div>"]
    right = total = 0
    for main in mains:
        for extra in clutter:
            page = f"<html><head><title>x</title></head><body><header><p>Site</p></header>{extra}" + main.format(f"<h1>Onner thand</h1>{body}") + f"{extra}<footer>&copy; x</footer></body></html>"
            total += 1
            right += extracted(labeller, page) == want
    assert right >= 0.85 * total, (right, total)


def test_edge_rows(spark, labeller):
    rows = [(1, None, None, "c"), (2, "u", "", "c"), (3, "u", "no tags at all", "c"), (None, "u", "<article><p>a  b</article>", "c"), (4, "u", "<nav>x</nav>" * 9000, "c")]
    docs = spark.createDataFrame([*rows, rows[3]], "page_id long, url string, html string, text string")
    got = html.extract(docs, labeller).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 6 and texts[1] == texts[2] == texts[4] == "" and texts[None] == "a b"
    empty = docs.limit(0)
    assert html.extract(empty, html.train(empty)).count() == 0
    assert html.extract(docs, labeller).select(F.length("text")).count() == 6


def test_head_without_end_tag():
    heads = [
        "<html><head><title>t</title><body>", "<head><meta charset=utf-8><style>b{}</style><script>x</script>", "<head><head><link rel=a>\n",
        "<html><head><title>t</title><base href=/></body>", "<head><noframes>old <p>page</noframes><noscript>n</noscript>", "<head><bgsound src=a>",
    ]
    for head in heads:
        for body, want in (("<p>one<p>two", ["one", "two"]), ("<a href=x>one</a>", ["one"]), ("<!-- c -->one<div>two", ["one", "two"]), ("<custom-part>one", ["one"])):
            assert [t for _, t, _ in html.leaves(head + body)] == want, head + body
            assert not any("head" in path for path, _, _ in html.leaves(head + body))
    assert [t for _, t, _ in html.leaves("<html><head><title>t</title></head><body><p>one<head>two")] == ["one", "two"]


def test_text_of_page_without_head_end(labeller, spark):
    page = spark.read.parquet(PAGES).where("page_id = 1").first().html
    assert "</head>" in page and extracted(labeller, page)
    assert extracted(labeller, page.replace("</head>", "")) == extracted(labeller, page)


def test_a_repeated_page_reaches_the_driver_once(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(html, "variants", lambda found, seed: (taken.extend(found), ([], []))[1])
    rows = [(1, "u", "<p>the same page</p>")] * 500 + [(i, f"u{i}", f"<p>page {i}</p>") for i in range(2, 9)]
    html.train(spark.createDataFrame(rows, "page_id long, url string, html string"), sample=10**6)
    assert len(taken) == 8
