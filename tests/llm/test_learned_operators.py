"""Ops 1, 3 and 8 and the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from siltstone.llm import html_blocks, language_mixture, line_crf, page_difference
from siltstone.llm.page_difference import common_lines, extract_pages
from tests.llm.helpers import (
    SAMPLE, documents, held_out, no_documents, odd_documents, sample_documents, sample_labels,
)

RICH = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style></head><body>
<header class="site-header"><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="sidebar">Side <p>bar</p></div>
<main><article><header><h1>Head&shy;line &eacute;&#233;</h1><span>by X</span></header>
<p>First <b>bold</b>text<br>line &lt;tag&gt; &amp;amp; a &#x1F389;<p>Second
   para <a href="#">with link</a></p><ul><li>one<li>two</ul>
<div class="ad banner">Buy</div><script>var p="<p>no</p>";</script><!-- no <p>no -->
<form><label>Name</label><input></form><table><tr><td>c1<td>c2</table>
<aside>also read</aside></article>
<section id="comments"><h3>Comments</h3><p>first!</p></section></main>
<footer>&copy; foot</footer></body></html>"""


def test_blocks_of_a_rich_page(spark):
    rows = [(1, "http://h/a", RICH), (2, None, None), (3, "http://h/b", ""), (4, "http://[bad", "plain")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, key string")
    found = {r.page_id: r for r in extract_pages(pages).collect()}
    assert found[1].text == (
        "Head­line éé First boldtext line <tag> &amp; a 🎉 Second para with link one two c1 c2"
    )
    assert found[1].n_chars == len(found[1].text)
    assert found[2].text == "" and found[2].n_chars == 0 and found[3].text == ""
    assert found[4].text == "plain"
    assert extract_pages(pages.limit(0)).count() == 0


def template(i, body):
    return (
        "<html><body><div><span>The Daily Name, since 1900</span></div><div>Top stories today</div>"
        f"<div><div>{body}</div></div><div>Read more of this below</div><div>All rights kept</div></body></html>"
    )


def test_shared_lines_of_unmarked_pages_go(spark):
    bodies = [f"<p>Story {i} tells of {i * 7} things at length.</p><p>It ends with {i}.</p>" for i in range(90)]
    rows = [(i, f"http://Host{i % 3}.example/news/{i:03d}", template(i, b)) for i, b in enumerate(bodies)]
    rows += [(200, "http://alone.example/x", template(200, bodies[5])), rows[7]]
    mirror = [(300 + i, "http://host0.example/news/006", rows[6][2]) for i in range(2)]
    pages = spark.createDataFrame(rows + mirror, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract_pages(pages.repartition(5)).collect()}
    for i in range(90):
        assert found[i] == f"Story {i} tells of {i * 7} things at length. It ends with {i}."
    assert found[200].startswith("The Daily Name")
    assert found[300] == found[301] == found[6]
    assert extract_pages(pages).count() == len(rows) + 2


def test_sample_pages_equal_their_articles(spark):
    pages = spark.read.parquet(f"{SAMPLE}/pages.parquet")
    import html
    import re
    for r in extract_pages(pages).join(pages.select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inner))
        assert r.text == " ".join(plain.split())


def test_unclosed_and_broken_markup():
    assert html_blocks.lines_of("a < b <p>c") == [("a < b", 0), ("c", 0)]
    assert html_blocks.lines_of('<p class="x>y') == [("y", 0)]
    assert html_blocks.lines_of("<script>never ends") == []
    assert html_blocks.lines_of("<p hidden>no<p>yes") == [("no", 2), ("yes", 0)]
    assert html_blocks.lines_of('<span class="ad">no</span>yes') == [("no", 2), ("yes", 0)]
    assert html_blocks.lines_of("<ul><li><a>x</a></li></ul>") == [("x", 2)]
    assert html_blocks.lines_of("<b><div>" * 30_000 + "deep")[0][0] == "deep"


def test_common_lines_is_a_longest_common_subsequence():
    r = random.Random(3)
    for _ in range(1500):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 11))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = common_lines(a, b)
        assert len(found) == best[-1][-1] and all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))


def test_groups_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(page_difference, "GROUP", 4)
    rows = [(i, f"http://h/{i:03d}", template(i, f"<p>Only here {i}.</p>")) for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one, two = (sorted(map(tuple, extract_pages(pages.repartition(n)).collect())) for n in (1, 7))
    assert one == two and all(r[2] == f"Only here {r[0]}." for r in one)


def test_language_of_held_out_rows(spark):
    docs = sample_documents(spark)
    rows = language_mixture.identify_documents(docs).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(lang) and all(r.held_out == held_out(r.doc_id) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    found = {r.doc_id: r for r in language_mixture.identify_documents(odd_documents(spark)).collect()}
    assert len(found) == 9
    assert found[1].lang_pred == found[2].lang_pred == found[3].lang_pred == "und"
    assert found[5].lang_pred != "und" and not found[None].held_out
    assert language_mixture.identify_documents(no_documents(spark)).count() == 0
    blank = documents(spark, [(3, "12 34", "en", None), (4, "words", None, None)])
    assert {r.lang_pred for r in language_mixture.identify_documents(blank).collect()} == {"und"}


def languages(texts):
    counts = np.stack([language_mixture.trigrams(t) for t in texts])
    return language_mixture.Languages([f"l{i}" for i in range(len(texts))], counts)


def words(letters, n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(n))


def test_mixture_gives_proportions_and_the_set_of_languages():
    model = languages([words("abcd", 4000, 1), words("mnop", 4000, 2), words("wxyz", 4000, 3)])
    mixed = model.mixture(words("abcd", 300, 4) + " " + words("wxyz", 100, 5))
    assert [name for name, _ in mixed] == ["l0", "l2"]
    assert mixed[0][1] == pytest.approx(0.75, abs=0.03)
    assert model.mixture(words("mnop", 50, 6)) == [("l1", 1.0)]


def test_expectation_maximisation_does_not_lower_the_likelihood():
    r = np.random.default_rng(2)
    p, n = r.dirichlet(np.ones(30), 3).T, r.integers(1, 9, 30).astype(float)
    weights, fit = language_mixture._proportions(n, p, np.full(3, 1 / 3))
    assert fit >= n @ np.log(p @ np.full(3, 1 / 3)) and weights.sum() == pytest.approx(1)


def test_quality_of_held_out_rows(spark):
    larger = SAMPLE.replace("0.001", "0.01")  # the smallest sample has ten bad documents
    docs, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    rows = line_crf.score_documents(docs, labels).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    out = [r for r in rows if r.held_out and r.doc_id in quality]
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == quality[r.doc_id] for r in out]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame(
        [(4, 1), (5, 1), (5, 1), (9, 0), (6, None), (None, 0)], "doc_id long, quality int"
    )
    found = line_crf.score_documents(odd_documents(spark), labels).collect()
    assert len(found) == 10 and all(r.score == 0.0 for r in found if r.doc_id in (1, 2, 3))
    alike = line_crf.score_documents(odd_documents(spark), labels.limit(0)).collect()
    assert {r.score for r in alike} == {0.0, 1.0}
    assert line_crf.score_documents(no_documents(spark), labels).count() == 0


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(4)
    emissions, follow = [r.normal(size=n) for n in (1, 4, 3)], r.normal(size=(2, 2))
    found, pairs = line_crf._forward_backward(emissions, follow)
    expected_pairs = np.zeros((2, 2))
    for e, marginal in zip(emissions, found):
        total, good = 0.0, np.zeros(len(e))
        counted = np.zeros((2, 2))
        for code in range(2 ** len(e)):
            y = np.array([code >> i & 1 for i in range(len(e))])
            weight = np.exp(e @ y + follow[y[:-1], y[1:]].sum())
            total += weight
            good += weight * y
            np.add.at(counted, (y[:-1], y[1:]), weight)
        assert np.allclose(marginal[:, 1], good / total)
        expected_pairs += counted / total
    assert np.allclose(pairs, expected_pairs)


def test_pipeline_stages(spark):
    docs = sample_documents(spark)
    labels = {r.doc_id: r.quality for r in sample_labels(spark).collect()}
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SAMPLE).cache()
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert after.keys() <= before.keys()
        if name != "substring dedup":
            assert all(before[d] == t for d, t in after.items())
        sizes.append(len(after))
        if name == "quality classifier":
            good = [d for d in before if labels.get(d) == 1]
            assert np.mean([d in after for d in good]) > 0.98
            assert np.mean([d in after for d in before if labels.get(d) == 0]) < 0.2
        if name == "near duplicates":
            from tests.llm.test_text_operators import brute_components
            names = {c for _, _, c in brute_components(list(before.items()), 5, 80)}
            assert after.keys() == names
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SAMPLE)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    assert sizes == sorted(sizes, reverse=True)


def test_pipeline_stages_take_odd_rows(spark):
    for table in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, table, SAMPLE)
            n = found.count()
            if name != "best-fit packing":
                assert found.columns == table.columns and n <= table.count()
            else:
                assert n >= table.count()


def test_pipeline_stages_leave_columns_of_any_name(spark):
    """Columns named like those that the stages use for themselves."""
    names = ["_text", "_score", "_row_key", "_n", "_doc", "_hash", "_places", "removed_spans", "removed_bytes", "row_key", "root"]
    wide = sample_documents(spark).limit(40).selectExpr("*", *(f"doc_id * {i} AS {n}" for i, n in enumerate(names)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, wide, SAMPLE)
        assert found.columns == wide.columns, name
        rows = found.collect()
        assert rows and all(r[n] == r.doc_id * i for r in rows for i, n in enumerate(names)), name


def test_near_duplicates_keep_a_document_of_every_group(spark):
    """Groups without doc_ids and unlinked texts that share one."""
    def text(name, end):
        return " ".join(f"{name}{i}" for i in range(40)) + " " + end

    rows = [
        (None, text("a", "x")), (None, text("b", "x")), (None, text("b", "y")), (1, text("c", "x")),
        (1, text("d", "x")), (1, text("d", "x")), (None, text("e", "x")), (3, text("e", "y")),
        (2, text("e", "z")), (4, " \t\x0b\n"), (None, None), (None, None),
    ]
    docs = documents(spark, [(*r, None, None) for r in rows])
    found = corpus_pipeline.near_duplicates(spark, docs.repartition(3), SAMPLE)
    assert found.columns == docs.columns
    kept = sorted(((r.doc_id, (r.text or "").strip()[:1]) for r in found.collect()), key=repr)
    assert kept == sorted(
        [(None, "a"), (None, "b"), (1, "c"), (1, "d"), (2, "e"), (4, ""), (None, ""), (None, "")], key=repr
    )
