"""Main text and license scan."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retailoom.llm.licenses import CUES, TEMPLATES, VERSION, WORD, license_scan, version_of_license
from retailoom.llm.main_text import low_branches, main_text, main_texts, style_rows

NESTED = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li>Menu<li>More</ul></nav>
<div class="cookie-notice">We use cookies</div>
<main><article><header><h1>Title &amp; more</h1></header>
<p>First <b>bold</b>
 text&nbsp;here.<br>Next<p>Second<script>var x = "<p>no</p>";</script> one
<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>
<aside>aside</aside><form><input><button>Send</button></form><!-- <p>comment</p> -->
<div class="share-buttons">Share</div></article></main>
<section id="comments"><article class="comment"><p>Reader says</p></article></section>
<div class="sidebar">Side</div><footer>Foot</footer></body></html>"""


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (NESTED, "Title & more\n\nFirst bold text here. Next\n\nSecond one\n\na\n\nb\n\n1 2"),
        (None, ""), ("", ""), ("<p></p>", ""), ("plain &lt;text&gt;", "plain <text>"),
        ("<p>a<p>b</p>c", "a\n\nb\n\nc"), ("<div>x<div hidden>y</div>z", "x\n\nz"), ("<script>never closed <p>x", ""),
        ("<div>a<!-- b", "a"), ("<p title='a>b'>x</p>", "x"), ("</p></div>x</b>", "x"), ("a < b", "a < b"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>" + "w " * 100_000 + "</p>", ("w " * 100_000).strip()),
    ],
)
def test_text_of_one_page(source, text):
    assert main_text(source) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<div class='layout has-sidebar'><article><p>Text</p></article></div>", "Text"),
        ("<div id='page' class='no-footer'><main><p>Text</p></main></div>", "Text"),
        ("<div class='sidebar-layout'><div><article><p>Text</p></article><div>Side</div></div></div>", "Text"),
        ("<article class='post tag-search category-social'><p>Text</p></article>", "Text"),
        ("<div class='content-with-comments'><p>Text</p></div>", "Text"),
        ("<div class='promo-free'><p>Text</p></div><div class='legal-news'><p>More</p></div>", "Text\n\nMore"),
        ("<body><form><div><input value='x'><h1>T</h1><p>Text</p><select><option>a</select></div></form></body>", "T\n\nText"),
        ("<p>Text of a page</p><form><p>Leave a reply</p><button>Send</button></form>", "Text of a page"),
        ("<article class='teaser'>Card</article><div id='story'><p>A story that is longer</p></div>", "Card\n\nA story that is longer"),
        ("<article><p>Text</p><section id='comments'><article><p>Reader</p></article></section></article>", "Text"),
        ("<div class='related-posts'><article><p>Other</p></article></div><p>Text</p>", "Text"),
        ("<div class='main-nav'>Menu</div><div class='siteFooter'>Foot</div><p>Text</p>", "Text"),
        ("<article><nav>Menu</nav><div class='share-buttons'>Share</div><p>Text</p></article>", "Text"),
        ("<nav><article><p>Menu</p></article></nav><p>Text</p>", "Text"),
    ],
)
def test_names_do_not_cut_articles(source, text):
    assert main_text(source) == text


def site(n):
    """Pages of one host whose unnamed boxes at the top and the end are always the same."""
    return f"""<body><div><div>All our offers</div></div><div><h1>Story {n}</h1><p>Once {n} upon {n * 7} a time.</p><p>End {n * 3}.</p></div>
<table><tr><td>Call us now</td></tr></table></body>"""


def test_style_tree_cuts_what_repeats(spark):
    pages = [(n, f"http://Site.example/{n}", site(n), "host", 1) for n in range(12)]
    pages += [(100, "http://other.example/", site(100), "h", 1), (101, None, site(101), "h", 1), (102, "http://site.example/x", None, "h", 1)]
    pages += [(200, "http://copies.example/", site(200), "h", 1)] * 30 + [(None, "http://site.example/y", "", "h", 1)]
    found = main_texts(spark.createDataFrame(pages, "page_id long, url string, html string, host string, text int"))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == len(pages)
    texts = {r.page_id: r.text for r in found.collect()}
    assert texts[3] == "Story 3\n\nOnce 3 upon 21 a time.\n\nEnd 9."
    # no other pages of the site to learn from: nothing is known to be common, and copies are one page
    for n in (100, 101, 200):
        assert texts[n] == f"All our offers\n\nStory {n}\n\nOnce {n} upon {n * 7} a time.\n\nEnd {n * 3}.\n\nCall us now"
    assert texts[102] == texts[None] == ""
    assert all(r.n_chars == len(r.text) for r in found.collect())


def test_a_page_is_never_emptied_by_its_site(spark):
    pages = [(n, f"http://a.example/{n}", f"<body><div>Same on all</div><p>{'' if n else 'x'}</p><i></i><!--{n}--></body>") for n in range(9)]
    found = main_texts(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert all("Same on all" in r.text for r in found.collect() if r.page_id)


def test_importance_against_brute_force(spark):
    pages = [(f"<div><p>{'same' if n % 4 else n}</p></div><ul><li>x</li></ul><!--{n}-->", n) for n in range(8)]
    rows = style_rows(spark.createDataFrame([("h", s) for s, _ in pages], "host string, html string"))
    importance = {}
    for least in (0.001, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 1.01):
        for r in low_branches(rows, least, 2).collect():
            importance.setdefault(r.node, least)
    values = sorted(importance.values())
    # li and ul: one shape, one text on every page: 0; p and div: one shape, and texts of entropy (6 log 6) / (8 log 8)
    leaf = 0.9 * (1 - 6 * math.log(6) / (8 * math.log(8)))
    above = next(x for x in (0.001, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 1.01) if x > leaf)
    assert values == [0.001, 0.001, above, above]


def test_empty_pages(spark):
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- licenses -----------------------------------------------------------------------------------


def slow_cosines(text, whole=False):
    units = [(name, t) for name, texts in TEMPLATES.items() for t in texts]
    counts = [Counter(re.findall(WORD, t.lower())) for _, t in units]
    df = Counter(w for c in counts for w in c)
    idf = {w: math.log((1 + len(units)) / (1 + n)) + 1 for w, n in df.items()}
    rare = math.log(1 + len(units)) + 1
    if whole:
        units = [(name, " ".join(texts)) for name, texts in TEMPLATES.items()]

    def vector(t):
        v = {w: n * idf.get(w, rare) for w, n in Counter(re.findall(WORD, t.lower())).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if v else {}

    mine = vector(text)
    versions = {v.removesuffix(".0") for v in re.findall(VERSION, text.lower())}
    units = [(n, t) for n, t in units if not versions or version_of_license(n) is None or version_of_license(n) in versions]
    return max((round(sum(x * vector(t).get(w, 0) for w, x in mine.items()), 6), name) for name, t in units)


def test_license_scan(spark):
    apache, mit = "\n".join(TEMPLATES["Apache-2.0"]), " ".join(TEMPLATES["MIT"])
    rows = [
        (1, "LICENSE", apache), (2, "src/a.c", "code\nReleased under the MIT License."), (3, "src/deep/er/b.c", "code"),
        (4, "lib/COPYING.txt", mit), (5, "lib/x/y/c.c", "int licence;"), (6, "lib/x/LICENSE", "nothing known"), (7, None, "code"),
        (8, "src/n.c", None), (9, "lib/e.c", ""), (10, "a.c", "words " * 50_000), (11, "src/d/f.c", "This file is licensed as MIT, or so they say, by its license"),
        (2, "src/a.c", "code\nReleased under the MIT License."), (None, "lib/q.c", "code"), (12, None, "Licensed under CC BY-NC 4.0."),
        (13, "note/t.c", "Licensed under the Mozilla Public License, version 2.0."), (14, "note/u.c", "x"), (15, "/abs/u.c", "x"),
    ]
    files = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, where string, text string, license string, path int")
    found = license_scan(files, F.col("where")).collect()
    assert len(found) == len(rows)
    out = {r.doc_id: (r.own_license, r.license, r.inherited_from) for r in found}
    assert out[1] == ("Apache-2.0", "Apache-2.0", None) and out[2] == ("MIT", "MIT", None)
    # the notice is most of src/a.c, so it speaks for src
    assert out[3] == (None, "MIT", "src") and out[8] == (None, "MIT", "src")
    assert out[5] == (None, "MIT", "lib") and out[6] == (None, "MIT", "lib") and out[9] == (None, "MIT", "lib") and out[None] == (None, "MIT", "lib")
    assert out[7] == (None, None, None) and out[10] == (None, "Apache-2.0", "") and out[12] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None)
    assert out[13][0] == "MPL-2.0" and out[14] == (None, "MPL-2.0", "note") and out[15] == (None, "Apache-2.0", "")
    for r in found:
        if r.doc_id in (1, 4):
            assert (r.cosine, r.own_license) == slow_cosines(dict((i, t) for i, _, t in rows)[r.doc_id], whole=True)


def test_cosines_against_brute_force(spark):
    lines = [t for texts in TEMPLATES.values() for t in texts]
    lines += [" ".join(t.split()[::2]) + " license" for t in lines] + ["license", "LICENSE VERSION 2.0 mit", "licensed under the moon"]
    files = spark.createDataFrame([(n, f"p/{n}", "x\n" + t + "\ny") for n, t in enumerate(lines)], "doc_id long, where string, text string")
    for r in license_scan(files, F.col("where"), notice_share=2.0).collect():
        line = lines[r.doc_id]
        if any(c in line.lower() for c in CUES):
            cosine, name = slow_cosines(line)
            if cosine >= 0.6 + 1e-6:
                assert (r.own_license, r.cosine) == (name, pytest.approx(cosine, abs=2e-6))
            elif cosine < 0.6 - 1e-6:
                assert r.own_license is None


GPL_NOTICE = """/*
 * Frobnicate, a program.
 *
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 */
int main() {}
"""


def test_notices_of_many_forms(spark):
    wrapped = GPL_NOTICE.replace(";", ",").replace("software,", "software:")
    notices = {
        GPL_NOTICE: "GPL-2.0",
        GPL_NOTICE.replace("\n", "\r\n"): "GPL-2.0",
        wrapped.replace("version 2", "version 3"): "GPL-3.0",
        wrapped.replace("version 2", "version 3").replace("GNU General", "GNU Affero General"): "AGPL-3.0",
        GPL_NOTICE.replace("General", "Lesser General").replace("version 2", "version 2.1").replace("program", "library"): "LGPL-2.1",
        "# SPDX-License-Identifier: BSD-2-Clause\nx = 1": "BSD-2-Clause",
        "# SPDX-License-Identifier: BSD-3-Clause\nx = 1": "BSD-3-Clause",
        "/*! lib v1.2.3 | (c) Foo Authors | Released under the MIT License */": "MIT",
        "A page of prose that goes on and on. Released under the MIT License. Then more is said, of other things.": "MIT",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided "
        "that the above\ncopyright notice and this permission notice appear in all copies.": "ISC",
        "Licensed under the Eclipse Public License, version 2.0.": "EPL-2.0",
        "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
        "Licensed under the Mozilla Public License, version 1.1.": None,
        "Licensed under CC BY 3.0.": None,
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "We license our cows to graze here.": None,
    }
    files = spark.createDataFrame([(n, f"d{n}/f", t) for n, t in enumerate(notices)], "doc_id long, where string, text string")
    found = {r.doc_id: r.own_license for r in license_scan(files, F.col("where")).collect()}
    assert [found[n] for n in range(len(notices))] == list(notices.values())


def test_a_line_of_a_million_words(spark):
    rng = random.Random(3)
    line = " ".join(f"w{rng.randrange(200_000)}" for _ in range(1_000_000)) + " license"
    files = spark.createDataFrame([(1, "a/b", line), (2, "c/LICENSE", line)], "doc_id long, where string, text string")
    began = time.monotonic()
    assert {r.own_license for r in license_scan(files, F.col("where")).collect()} == {None}
    assert time.monotonic() - began < 120


def test_no_files(spark):
    assert license_scan(spark.createDataFrame([], "doc_id long, where string, text string"), F.col("where")).count() == 0
