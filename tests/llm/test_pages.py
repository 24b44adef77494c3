"""Main text of pages: parsing, decoding against all labellings, held-out pages, the given pages."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from activity_engine.llm import pages


@pytest.fixture(scope="module")
def model():
    return pages.train()


def test_blocks():
    page = (
        "<!DOCTYPE html><head><title>T &amp; t</title><script>var t='</p>';</script></head><body><!-- <p>no</p> -->"
        "<nav><ul><li><a href='/a'>One</a><li>Two</ul></nav><p class='x y' id=z>A <b>bo</b>ld &lt;tag&gt;<br>line<p>Next&nbsp; \n one"
        '<div data-x="a>b">In<textarea>no</textarea></div><p>End'
    )
    found = pages.blocks_of(page)
    assert [b.text for b in found] == ["T & t", "One", "Two", "A bold <tag>", "line", "Next one", "In", "End"]
    assert found[1].linked == 1 and found[1].ancestors[-2:] == ("ul", "li") and found[3].names == ("x", "y", "z")
    assert pages.blocks_of(None) == pages.blocks_of("") == pages.blocks_of("<p> </p><!-- x") == []


def test_quotes_that_open_no_value():
    texts = lambda page: [b.text for b in pages.blocks_of(page)]
    assert texts("<p title=it's>Hello there friend.</p><p>World is round.</p>") == ["Hello there friend.", "World is round."]
    assert texts("<p 'x\">One</p><p a= 'b>c' d=\"'>\">Two</p><p class='never closed>Three</p>") == ["One", "Two"]
    assert pages.blocks_of("<p class=it's id='a b'>x")[0].names == ("a", "b", "it", "s")


def test_deep_pages_take_linear_time():
    page = "".join(f"<div class='a b{i % 7}'>t{i} <i>" for i in range(100_000))
    found = pages.blocks_of(page)
    assert len(found) == 100_000 and found[-1].ancestors == ("div",) and found[-1].names == ("a", "b")
    assert len(pages.features(found[:50])) == 50


def test_viterbi_and_marginals_match_all_labellings():
    rng = np.random.default_rng(2)
    for n in range(1, 7):
        field = pages.Field({f"f{k}": float(rng.normal()) for k in range(n)}, rng.normal(size=(2, 2)))
        named = [[f"f{k}"] for k in range(n)]
        scores = np.array(field.scores(named))

        def weight(labels):
            return sum(s for s, y in zip(scores, labels) if y) + sum(field.change[a, b] for a, b in zip(labels, labels[1:]))

        every = list(itertools.product((0, 1), repeat=n))
        assert weight(field.decode(named)) == pytest.approx(max(map(weight, every)))
        single, pair = field.marginals(scores)
        total = sum(np.exp(weight(y)) for y in every)
        for t in range(n):
            assert single[t] == pytest.approx(sum(np.exp(weight(y)) for y in every if y[t]) / total)
        for t in range(n - 1):
            assert pair[t, 1, 0] == pytest.approx(sum(np.exp(weight(y)) for y in every if y[t : t + 2] == (1, 0)) / total)


def test_held_out_pages(model):
    right = seen = 0
    for page, article in pages.labelled_pages(150, seed=77):
        wanted = set(article)
        blocks = pages.blocks_of(page)
        labels = model.decode(pages.features(blocks))
        seen += len(blocks)
        right += sum((b.text in wanted) == bool(y) for b, y in zip(blocks, labels))
    assert right / seen >= 0.97


def test_given_pages(spark, model):
    """On the given pages the article element is known; its blocks are the expected text."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html", pages.extract(F.col("html"), model).alias("r")).collect()
    same = 0
    for r in rows:
        wanted = " ".join(b.text for b in pages.blocks_of(r.html) if "article" in b.ancestors)
        same += r.r.text == wanted
        assert r.r.n_chars == len(r.r.text)
    assert same / len(rows) >= 0.98


def test_odd_pages(spark, model):
    rng = random.Random(1)
    junk = ["".join(rng.choice("<>/&;\"'= abp!-") for _ in range(200)) for _ in range(30)]
    texts = [None, "", "<", "&#x110000;&amp", "<article><p>Aé😀 b</p></article>", "<p>x" * 40_000, *junk]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "page_id int, html string, text string")
    found = {r.page_id: r.r for r in df.select("page_id", pages.extract(F.col("html"), model).alias("r")).collect()}
    assert len(found) == len(texts) and found[0].text == found[1].text == "" and found[0].n_chars == 0
    assert (found[4].text, found[4].n_chars) == ("Aé😀 b", 5)
    assert df.where("false").select(pages.extract(F.col("html"), model)).count() == 0
