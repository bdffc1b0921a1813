"""Leaf blocks, the conditional random field and the extraction of main text."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from vitalgauge.llm import queries
from vitalgauge.llm.html_blocks import leaf_blocks
from vitalgauge.llm.html_extraction import Crf, extracted, features, fit_crf, fit_extraction, labelled_pages, main_text
from vitalgauge.llm.html_layouts import Layouts


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a<b>b</b>c<p>d<br>e</p>f", ["abc", "d e", "f"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<script>var t='</p><p>x';</script>a<style>p{}</style>b", ["ab"]),
        ("a<!-- <p>b --> c<!--> d <!-- e", ["a c d"]),
        ("<div title='a > b' class=\"x\">c</div><p title=it's>d", ["c", "d"]),
        ("x &lt;b&gt; &amp;amp; &eacute;&#233;&#xe9; &nbsp; y &am &noentity;", ["x <b> &amp; ééé y &am &noentity;"]),
        ("1 < 2 <3 a</>b", ["1 < 2 <3 ab"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("<dl><dt>a<dd>b<p>c<dt>d</dl>", ["a", "b", "c", "d"]),
        ("</p></div>a</span><p>b</div>c", ["a", "bc"]),
        ("<title>no</title><textarea>no <p></textarea><p>yes<script>no", ["yes"]),
        ("<SCRIPT>a</SCRIPT ><P>b</P>", ["b"]),
        ("a<p", ["a"]),
        ("<a href=x>li<p>nk</a> no", ["li", "nk no"]),
        ("<p>" * 3000 + "<div>" * 3000 + "deep", ["deep"]),
    ],
)
def test_leaf_blocks(page, texts):
    assert [b.text for b in leaf_blocks(page)] == texts


def test_places_and_links():
    page = '<body class=header><article class="mainText post_1"><p>a <a href=x>b c</a></p><aside id="relatedLinks" hidden><p>d</aside>e</article>f'
    a, d, e, f = leaf_blocks(page)
    assert (a.tag, a.link_characters) == ("p", 2)
    assert a.place == {"in=html", "in=body", "in=article", "in=p", "name=main", "name=text", "name=post"}
    assert {"in=aside", "name=related", "name=links", "hidden"} <= d.place
    assert e.place == a.place - {"in=p"} and f.place == {"in=html", "in=body"}


def test_layouts_are_read_as_written():
    layouts = Layouts(["One <b> & two, " * 8, "x  y" * 30], ["a", "&lt; b"], seed=5)
    for _ in range(400):
        page, found = layouts.page()
        assert [b.text for b in leaf_blocks(page)] == [text for text, _ in found]


def random_field(rng):
    weights = {f: tuple(rng.gauss(0, 1) for _ in "ab") for f in "pqrs"}
    return Crf(weights, *(np.array([rng.gauss(0, 1) for _ in range(n)]) for n in (2, 2)), np.array([[rng.gauss(0, 1) for _ in "ab"] for _ in "ab"]))


def score(model, row, labels):
    emit = model.scores(row)
    inner = sum(model.follow[i, j] for i, j in itertools.pairwise(labels))
    return model.first[labels[0]] + model.last[labels[-1]] + inner + sum(e[y] for e, y in zip(emit, labels, strict=True))


def test_viterbi_against_all_rows_of_labels():
    rng = random.Random(1)
    for _ in range(200):
        model, n = random_field(rng), rng.randint(1, 7)
        row = [rng.sample("pqrst", rng.randint(0, 5)) for _ in range(n)]
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: score(model, row, y))
        assert model.labels(row) == list(best)
    assert model.labels([]) == []


def test_fit_reaches_the_greatest_likelihood():
    """At the optimum the gradient, here by enumeration, vanishes."""
    rng = random.Random(2)
    rows = [[rng.sample("pqrs", rng.randint(0, 3)) for _ in range(rng.randint(1, 5))] for _ in range(30)]
    labels = [[int("p" in own) if rng.random() < 0.8 else rng.randint(0, 1) for own in row] for row in rows]
    model = fit_crf([*rows, []], [*labels, []], steps=1500, rate=0.05)

    def objective(weights, first, last, follow):
        changed = Crf({f: tuple(w) for f, w in zip(model.weights, weights, strict=True)}, first, last, follow)
        total = -0.5 * sum(float((x**2).sum()) for x in (weights, first, last, follow))
        for row, own in zip(rows, labels, strict=True):
            every = np.logaddexp.reduce([score(changed, row, y) for y in itertools.product((0, 1), repeat=len(row))])
            total += score(changed, row, own) - every
        return total

    at = [np.array(list(model.weights.values())), model.first, model.last, model.follow]
    best = objective(*at)
    for k, x in enumerate(at):
        for i in np.ndindex(x.shape):
            for step in (-0.05, 0.05):
                moved = [y.copy() for y in at]
                moved[k][i] += step
                assert objective(*moved) < best + 1e-6


@pytest.fixture(scope="module")
def model(table):
    return fit_extraction(table("pages"), layouts=500)


def test_layouts_not_fitted_on(model, table):
    blocks = [b.text for r in table("pages").collect() for b in leaf_blocks(r.html)]
    layouts = Layouts([b for b in blocks if len(b) >= 80], [b for b in blocks if len(b) < 80], seed=99)
    right = total = 0
    for _ in range(300):
        page, found = layouts.page()
        labels = model.labels([features(b) for b in leaf_blocks(page)])
        right += sum(bool(x) == main for x, (_, main) in zip(labels, found, strict=True))
        total += len(found)
    assert right / total > 0.97


def test_a_page_without_an_article_element(model):
    text = "This is the first paragraph of the story, and it goes on for a while. " * 3
    page = f"""<html><body><div id=cookie-notice>We use cookies. <a href=x>Accept all</a></div><div class=topnav><a href=1>Home</a>
      <a href=2>News</a></div><div class=wrapper><div class="post-content"><h1>A headline of this page</h1><p>{text}</p><p>{text}</p>
      <div class="ad-slot">Buy now and save!</div><p>{text}</p></div><div class=comments><p>Great post, thanks!</p></div>
      <form class=newsletter><label>Your e-mail address</label></form></div><div id=footer>&copy; 2021 All rights reserved.</div>"""
    line = " ".join(text.split())
    assert main_text(page, model) == "\n".join(["A headline of this page", line, line, line])


def test_query_and_odd_rows(spark, sf_dir, table, model):
    got = {r.page_id: r for r in queries.op11_html_extraction(spark, sf_dir).collect()}
    rows = table("pages").collect()
    assert len(got) == len(rows) and got[rows[0].page_id].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    for row in rows:
        article = "\n".join(b.text for b in leaf_blocks(row.html) if "in=article" in b.place)
        assert (got[row.page_id].text, got[row.page_id].n_chars, got[row.page_id].url) == (article, len(article), row.url)
    long = "<article>" + "<p>This is one of very many paragraphs, all of which stay.</p>" * 20_000 + "</article>"
    odd = [(1, "u", None), (1, None, ""), (2, "u", "<p"), (None, "u", long), (2, "u", "<nav><li>a</nav>"), (2, "u", "<nav><li>a</nav>")]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in odd], "page_id long, url string, html string, text string, id string")
    texts = [(r.page_id, r.url, len(r.text)) for r in extracted(frame, model).collect()]
    expected = [(1, "u", 0), (1, None, 0), (2, "u", 0), (None, "u", 20_000 * 56 - 1), (2, "u", 0), (2, "u", 0)]
    assert sorted(texts, key=str) == sorted(expected, key=str)
    assert extracted(frame.limit(0), fit_extraction(frame.limit(0), layouts=60)).collect() == []


def test_labels_of_sample_pages():
    pages = ["<nav><p>a</nav><article><p>b<aside>c</aside></article>", "<div>no element</div>", "<main><p>d</main>", "<article>e</article><article>f</article>"]
    rows, labels = labelled_pages(pages, layouts=0)
    assert [[b.text for b in r] for r in rows] == [["a", "b", "c"], ["d"]] and labels == [[0, 1, 0], [1]]
