"""Cases in which the operators once did less than the whole job."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import html_text, line_templates, toxicity


def main_texts(spark, rows):
    return {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_pages_with_articles_are_compared(spark):
    """Furniture inside articles and the layout around them goes, text outside them stays."""
    page = "<div>Site name</div><p>Lead {i} of the story</p><article><p>Story {i} and all that is told in it at some length</p><p>Tell your friends</p></article><p>Note {i} on it</p>"
    got = main_texts(spark, [(i, f"http://s.x/p/{i}", page.format(i=i)) for i in range(6)])
    assert got == {i: f"Lead {i} of the story\n\nStory {i} and all that is told in it at some length\n\nNote {i} on it" for i in range(6)}


def test_copied_articles_stay(spark):
    page = "<div>Layout of {i} pages</div><p>Own words {i}, which are longer than what this page shares with others</p><article><p>The same story</p></article>"
    got = main_texts(spark, [(i, f"http://s.x/p/{i}", page.format(i=i)) for i in range(4)])
    assert all("The same story" in t for t in got.values())


def test_large_layout_goes_and_copies_are_passed_over(spark):
    """Layout of most of the page goes, whatever stands beside the page: copies by other query strings, or many of them."""
    menu = "".join(f"<div>Entry {k} of the long list on every page</div>" for k in range(9))
    rows = [(10 * i + k, f"http://s.x/p/{i}?from={k}", f"{menu}<p>Story {i}</p>") for i in range(5) for k in range(40 if i == 2 else 3)]
    assert main_texts(spark, rows) == {p: f"Story {html[-5]}" for p, _, html in rows}
    assert main_texts(spark, rows[:1] + rows[3:4]) == {0: "Story 0", 10: "Story 1"}


def test_an_edited_copy_is_no_layout(spark):
    body = "<p>Site name</p>" + "".join(f"<p>Sentence {k} of the first story, which has a copy</p>" for k in range(9))
    rows = [(1, "http://s.x/a/1", f"{body}<p>Printed today</p>"), (2, "http://s.x/a/1?v=2", f"{body}<p>Printed yesterday</p>"), (3, "http://s.x/b", "<p>Site name</p><p>Another story</p>"), (4, "http://s.x/A", "<p>Site name</p><p>An early story</p>")]
    got = main_texts(spark, rows)
    assert got[3] == "Another story" and got[4] == "An early story" and all(got[i].startswith("Sentence 0") and got[i].count("\n\n") == 9 for i in (1, 2))


def words(*seed):
    return " ".join(hashlib.md5(f"{seed}-{k}".encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop"))[:7] for k in range(9))


def test_a_passage_of_several_lines_goes_and_near_copies_stay(spark):
    """Notices of eight lines in documents of four, and a story of thirty lines copied with one line edited in each copy."""
    notice = [words("notice", k) for k in range(8)]
    story = [words("story", k) for k in range(30)]
    own = {i: [words("own", i, k) for k in range(4)] for i in range(60)}
    rows = [(i, "\n".join(lines[:2] + notice + lines[2:])) for i, lines in own.items()] + [(100 + i, "\n".join(story[:i] + [words("edit", i)] + story[i + 1 :])) for i in range(20)]
    out = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: "\n".join(own[i]) if i < 100 else t for i, t in rows}


def test_texts_without_telling_terms_are_compared(spark):
    """Words of single examples count: a copy of a toxic example has it as evidence, and scores above other texts."""
    rows = [(i, " ".join(words("text", i, k) for k in range(3))) for i in range(400)]
    docs = spark.createDataFrame([*rows, *[(1000 + i, t) for i, t in rows]], "doc_id long, text string")
    labels = docs.where("doc_id < 400").select("doc_id", (F.col("doc_id") % 8 == 0).cast("int").alias("toxic"))
    out = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    fitted = [i for i, _ in rows if not out[i]["held_out"]]
    assert all(out[1000 + i]["evidence"][0] == i for i in fitted)


@pytest.mark.parametrize("seed", range(5))
def test_pruned_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    often = rng.random(300) ** 4
    vectors = (rng.random((900, 300)) < often) * rng.random(300) ** 3 * 9 + 1e-3 * (np.arange(900)[:, None] % 300 == np.arange(300))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = toxicity.BlockMaxIndex([[(int(t), float(v[t])) for t in np.flatnonzero(v)] for v in vectors], 300)
    for q in vectors[:40]:
        near = index.nearest([(int(t), float(q[t])) for t in np.flatnonzero(q)], np.ones(900), 30)
        assert np.allclose([s for s, _ in near], np.sort(vectors @ q)[::-1][:30], atol=1e-6)
