import html as entities
import itertools
import random
import re

import numpy as np
import pytest

from conftest import SMALL
from tapework.llm import extraction as X


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SMALL}/pages.parquet")


@pytest.fixture(scope="module")
def field(pages):
    return X.train(pages, rows=60)


def brute(field, scores, same):
    """Every labelling of a page with its score."""
    return {y: sum(scores[t][y[t]] for t in range(len(y))) + sum(field.moves[same[t]][y[t - 1], y[t]] for t in range(1, len(y)))
            for y in itertools.product((0, 1), repeat=len(scores))}


def test_decoding_and_likelihood_match_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 9):
        field = X.Field(moves=rng.normal(size=(2, 2, 2)))
        scores, same = rng.normal(size=(n, 2)) * 2, rng.integers(0, 2, n)
        every = brute(field, scores, same)
        assert tuple(field.viterbi(scores, same)) == max(every, key=every.get)
        total, single, pairs = field.expectations(scores, same)
        weight = {y: np.exp(v - total) for y, v in every.items()}
        assert abs(sum(weight.values()) - 1) < 1e-9
        for t in range(n):
            assert abs(single[t, 1] - sum(w for y, w in weight.items() if y[t])) < 1e-9
            if t:
                assert abs(pairs[t - 1, 1, 0] - sum(w for y, w in weight.items() if y[t - 1] and not y[t])) < 1e-9


def test_labels_of_held_out_pages(pages):
    sources = [X.marked(r.html) for r in pages.orderBy("page_id").collect()]
    rng, stock = random.Random(9), [t for _, others in sources for t in others]
    cut = len(sources) * 3 // 4
    def drawn(part):
        for main, _ in part:
            for _ in range(6):
                blocks = X.blocks_of(X.layout(rng, main[:rng.choice([2, 6, 30])], stock), labelled=True)
                yield *X.features(blocks), np.array([int(b[6] == "1") for b in blocks])
    field = X.Field().fit(list(drawn(sources[:cut])))
    good = total = found = real = 0
    for slots, same, labels in drawn(sources[cut:]):
        got = field.viterbi(field.scores(slots), same)
        good, total, found, real = good + (got == labels).sum(), total + len(labels), found + got[labels == 1].sum(), real + labels.sum()
    assert good / total > 0.97 and found / real > 0.97


def test_articles_of_the_table(spark, pages, field):
    got = {r.page_id: r for r in X.extract(pages, field).collect()}
    same = 0
    for r in pages.collect():
        article = re.search("<article>(.*?)(</article>|$)", r.html, re.S)[1]
        want = " ".join(entities.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert got[r.page_id].url == r.url and got[r.page_id].n_chars == len(got[r.page_id].text)
        same += got[r.page_id].text == want
    assert same >= 0.97 * len(got) and len(got) == pages.count()


PAGE = """<html><head><title>Storm</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
<div id="cookie-banner"><p>We use cookies to improve this site. By continuing you accept.</p><button>Accept</button></div>
<header class="site-header"><a href="/">Daily Post</a></header>
<nav class="menu"><ul><li><a href="/a">Home</a><li><a href="/b">World</a><li><a href="/c">Sport</a></ul></nav>
<div class="content"><h1>A storm  &amp; a&nbsp;harbour</h1>
<p>The storm came in <b>over</b>night,\n and by morning the harbour was closed to all ships of the line.<p>Nobody was hurt, the town said, but three boats were lost &lt;so far&gt;.
<div class="ad"><p>Buy now: boats at half the price</p></div>
<p>The mayor, who had been away for a week, returned at noon and thanked those who had helped through the night.</p></div>
<div class="sidebar"><h3>Related</h3><ul><li><a href="/1">Ten storms</a></li><li><a href="/2">More boats</a></li></ul></div>
<section class="comments"><h3>Comments</h3><div class="comment"><b>Anna</b> says<p>I was there and it was a terrible night, we all stood at the pier and waited for them.</p><a href="#">Reply</a></div></section>
<form class="newsletter"><label>Subscribe</label><input name="q"><button>Send</button></form>
<footer>&copy; 2020 Daily Post. All rights reserved. <a href="/t">Terms</a></footer></body></html>"""


def test_an_article_among_other_parts(field):
    assert X.main_text(PAGE, field) == (
        "A storm & a harbour The storm came in overnight, and by morning the harbour was closed to all ships of the line. "
        "Nobody was hurt, the town said, but three boats were lost <so far>. "
        "The mayor, who had been away for a week, returned at noon and thanked those who had helped through the night.")


def test_blocks_of_broken_markup():
    def texts(html):
        return [b[0] for b in X.blocks_of(html)]
    assert texts("<p>a<p>b<div>c</p>d</div>e") == ["a", "b", "c", "d", "e"]
    assert texts("<ul><li>a<ul><li>b<li>c</ul><li>d") == ["a", "b", "c", "d"]
    assert texts("<p>x &lt; y &#233;&hellip;</p><!-- <p>no</p> --><script>if (a < b) {}") == ["x < y é…"]
    assert texts("a<br>b<b>c</b>d &amp") == ["a", "bcd &"]
    assert texts("<div hidden>x</div><p style='display:none'>y</p>z") == ["z"]
    assert texts("</div></p>") == [] and texts("") == [] and texts("<") in ([], ["<"])
    deep = X.blocks_of("<div>" * 20_000 + "x")
    assert len(deep) == 1 and deep[0][0] == "x"


def test_odd_pages(spark, field):
    long = "<article>" + "<p>One two three, four five.</p>" * 30_000 + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "   ", "x"), (4, "v", long, None), (None, "w", "<article><p>Some text here.</p></article>", "x"), (3, "u", "   ", "x")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("n_chars", X.F.lit("x"))
    got = X.extract(odd, field)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    assert [(r[0], r[3]) for r in got if r[0] != 4] == [(1, 0), (2, 0), (3, 0), (3, 0), (None, len("Some text here."))]
    assert next(r for r in got if r[0] == 4)[2] == " ".join(["One two three, four five."] * 30_000)
    nothing = X.train(odd.limit(0))
    assert X.extract(odd.limit(0), nothing).collect() == [] and X.main_text(PAGE, nothing) == ""
