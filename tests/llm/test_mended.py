"""Cases that once went wrong: deep pages, pages in one form, rows of one doc_id, labels of other types."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forgemeter.llm import htmltext, lattice

ARTICLE = "<p>" + "Long article text here, quite long indeed. " * 12 + "</p>"


def own_text(page):
    return htmltext.text_of(htmltext.blocks(page), [])


@pytest.mark.parametrize(
    "page",
    ["<div>w " * 20_000, "<span>" * 20_000 + "<div></div></p>" * 20_000, "<a b=\" c='" * 20_000,
     "<a b=\" > c='" * 20_000, "< " * 50_000, "<script " * 20_000, "<!--" * 20_000, "<p>x<li>" * 20_000],
)
def test_hostile_pages_take_linear_time(page):
    start = time.perf_counter()
    own_text(page)
    assert time.perf_counter() - start < 3


@pytest.mark.parametrize(
    "page",
    ["<body><form id=page>{}</form>", "<body><nav><a href=x>Home</a>{}", "<body><select><option>a<div>{}</div>",
     "<nav><a href=x>Home</a></nav><main>{}</main>", "<nav><ul><li>menu entry<main>{}</main>"],
)
def test_an_article_in_a_dropped_element_is_kept(page):
    assert "Long article text here" in own_text(page.format(ARTICLE))


@pytest.mark.parametrize(
    "comments",
    ["<div id='disqus_thread'>{}</div>", "<section class='reader-comments'>{}</section>",
     "<div class='user-reviews'>{}</div>", "<div class=comments>{0}{0}{0}{0}{0}{0}{0}{0}</div>"],
)
def test_reader_comments_go(comments):
    assert "nice post" not in own_text(f"<article>{ARTICLE}" + comments.format("<p>nice post, really</p>" * 9))


def test_small_forms_and_closed_menus_go():
    assert own_text("<form><p>Name, password</p></form><article></article>") == ""
    assert own_text(f"<nav><p>{'menu text ' * 90}</p></nav><article><p>Short.</p></article>") == "Short."


def test_a_quote_never_closed_ends_no_page():
    assert own_text(f'<p title="odd>one</p>{ARTICLE}').startswith("one Long article")


def test_texts_of_one_doc_id_are_documents_of_their_own(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, one), (5, two), (6, two), (4, two + " end"), (7, one), (None, one), (8, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("number", F.lit("clash"))
    kept = sorted(((r.doc_id or 0), r.text or "") for r in corpus_pipeline.drop_near_copies(spark, frame, "").collect())
    assert kept == sorted([(5, one), (4, two + " end"), (0, one), (8, ""), (8, "")])
    assert corpus_pipeline.drop_near_copies(spark, frame.filter("false"), "").isEmpty()


@pytest.mark.parametrize(("a", "b", "kind"), [(1.2, 1.7, "double"), ("red", "blue", "string"), (True, False, "boolean")])
def test_labels_are_compared_as_they_are(spark, a, b, kind):
    v = np.random.default_rng(0).standard_normal(16)
    near = (v + 1e-3).tolist()
    rows = [(1, v.tolist(), a), (2, near, b), (3, near, a), (3, near, a), (4, near, None)]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}").withColumn("n", F.lit(9))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in lattice.near_embeddings(frame).collect())
    assert got == [(1, 2, 1), (2, 0, 2), (3, 2, 1), (3, 2, 1), (4, 0, 4)]
