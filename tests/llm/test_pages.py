"""Wrapper induction: matching against brute force, deep and wide pages, what is template."""

import random
import time
from functools import cache

import pytest
from pyspark.sql import functions as F

from meshwork.llm import html_extract as h


def texts(spark, rows):
    got = h.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in got}


def random_page(rng, depth=0):
    out = ""
    for _ in range(rng.randint(0, 4)):
        kind = rng.choice(["div", "section", "p", "p"])
        out += f"<{kind}>" + (rng.choice("xyz") if kind == "p" or depth > 2 else random_page(rng, depth + 1)) + f"</{kind}>"
    return out


def slow_weight(a, b):
    """Largest weight over all alignments, tried one by one."""

    @cache
    def best(i, j):
        own = 1 + (a.name[i] == "#" and a.crc[i] == b.crc[j])
        return own + rows(tuple(a.kids[i]), tuple(b.kids[j]))

    @cache
    def rows(xs, ys):
        if not xs or not ys:
            return 0
        value = max(rows(xs[1:], ys), rows(xs, ys[1:]))
        if a.name[xs[0]] == b.name[ys[0]]:
            value = max(value, best(xs[0], ys[0]) + rows(xs[1:], ys[1:]))
        return value

    return best(0, 0)


def test_matching_is_the_largest_alignment():
    rng = random.Random(2)
    for _ in range(400):
        a, b = (h.Shape.of(h.parse(random_page(rng))) for _ in range(2))
        weight, pairs = h.match_trees(a, b)
        assert weight == slow_weight(a, b) == sum(1 + (a.name[x] == "#" and a.crc[x] == b.crc[y]) for x, y in pairs)
        assert all(a.name[x] == b.name[y] for x, y in pairs) and len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
        order = sorted(pairs)
        assert [y for _, y in order] == sorted(y for _, y in order)
        h.match_trees(a, b, 3)  # with few cells still an alignment


def test_matching_does_not_depend_on_its_size(monkeypatch):
    """Cells one by one, by arrays, and by arrays in blocks of rows give the same pairs."""
    rng = random.Random(5)
    held = h.HELD, h.WEIGHTS
    for k in range(300):
        a, b = (h.Shape.of(h.parse(random_page(rng) + random_page(rng))) for _ in range(2))
        weight, pairs = h.match_trees(a, b)
        assert weight == slow_weight(a, b)
        for cells, bits, kept in ((0, *held), (3, *held), (0, 40, 0), (3, 0, *held[1:]), (20, 200, 64)):
            monkeypatch.setattr(h, "HELD", bits)
            monkeypatch.setattr(h, "WEIGHTS", kept)
            got = h.match_trees(a, b, cells)
            assert (got[0], sorted(got[1])) == (weight, sorted(pairs))
        monkeypatch.setattr(h, "HELD", held[0])
        monkeypatch.setattr(h, "WEIGHTS", held[1])
    # more children than are filled one by one, with texts that meet again elsewhere
    made = lambda n: h.Shape.of(h.parse("<div>" + "".join(f"<section>{'<p>x</p>' * rng.randint(0, 3)}<p>{rng.randrange(400)}</p></section>" for _ in range(n)) + "</div>"))
    a, b = made(250), made(260)
    assert 250 * 260 > h.CELLS
    (weight, pairs), (want, whole) = h.match_trees(a, b), h.match_trees(a, b, 10**9)
    assert (weight, sorted(pairs)) == (want, sorted(whole))


def test_deep_and_wide_pages_take_seconds(spark):
    began = time.time()
    deep = "<div>" * 10_000 + "<p>down here</p>" + "</div>" * 10_000
    assert h.extract(deep) == "down here"
    wide = lambda k: "<article><table>" + "".join(f"<tr><td>row {k} {i}</td><td>{i * k}</td></tr>" for i in range(10_000)) + "</table></article>"
    a, b = (h.Shape.of(h.parse(wide(k))) for k in (1, 2))
    assert len(h.match_trees(a, b)[1]) == len(a.name)
    odd = "<b>" * 3000 + "<p>x</p>" * 3000 + "</i>" * 3000 + "<li>" * 3000 + "</div>" * 3000
    assert h.extract(odd)
    assert time.time() - began < 30
    rows = [(i, "http://a.example.org/", "<div>" * (1200 + i) + f"<p>text number {i}</p>") for i in range(4)] + [(9, "http://a.example.org/w", wide(3))]
    got = texts(spark, rows)
    assert [got[i] for i in range(4)] == [f"text number {i}" for i in range(4)] and got[9].startswith("row 3 0\n\n0\n\nrow 3 1")


def test_class_words_are_judged_by_the_host(spark):
    page = lambda i: f'<body><nav>menu</nav><article><h1>Title {i}</h1><div class="legal-history"><p>The legal history of port {i}.</p></div><p class="search">How to search {i}</p><div class="legal-footnote"><p>All rights are kept by the publisher.</p></div><div class="ad-slot"><p>Buy {i} now</p></div><p class="ad">Buy</p><p>{"Body text. " * 9}{i}</p><p>A passage that all pages share.</p></article><div id="comments"><p>Reader {i} says no</p></div></body>'
    body = ("Body text. " * 9).strip()
    for n in (2, 7):  # of two pages as of many
        got = texts(spark, [(i, f"http://h.example.org/{i}", page(i)) for i in range(n)])
        for i in range(n):
            assert got[i].split("\n\n") == [f"Title {i}", f"The legal history of port {i}.", f"How to search {i}", f"{body} {i}", "A passage that all pages share."]
    alone = h.extract(page(1)).split("\n\n")
    assert "All rights are kept by the publisher." in alone and "Buy" not in alone and "The legal history of port 1." in alone


def test_headings_and_leads_beside_the_text_stay(spark):
    page = lambda i: f'<body><div class="top"><p>The same name of the site</p></div><div id="content"><h1>Title {i}</h1><div class="text">{"".join(f"<p>paragraph {k} of {i} with some words</p>" for k in range(12))}</div></div><div class="bottom"><p>The same words below</p></div></body>'
    want = lambda i: "\n\n".join([f"Title {i}", *(f"paragraph {k} of {i} with some words" for k in range(12))])
    got = texts(spark, [(i, f"http://n.example.org/{i}", page(i)) for i in range(6)])
    assert got == {i: want(i) for i in range(6)}


def test_two_layouts_of_a_host(spark):
    one = lambda i: f"<body><div class='a'><p>same head</p></div><div class='story'><p>{f'first layout {i} ' * 20}</p></div></body>"
    two = lambda i: f"<body><table class='b'><tr><td>same cell</td></tr></table><div class='story'><p>{f'second layout {i} ' * 20}</p></div></body>"
    got = texts(spark, [(i, f"http://l.example.org/{i}", (one if i % 2 else two)(i)) for i in range(12)])
    assert got == {i: (f"first layout {i} " if i % 2 else f"second layout {i} ").strip() + (f" first layout {i}" if i % 2 else f" second layout {i}") * 19 for i in range(12)}


def test_a_form_around_the_article():
    assert h.extract("<body><form><div><article><p>inside</p></article></div></form><form><p>send</p></form></body>") == "inside"


@pytest.mark.parametrize("bound", [8 << 20, 0])
def test_large_trees_are_joined_by_host(spark, bound, monkeypatch):
    monkeypatch.setattr(h, "BROADCAST_BYTES", bound)
    monkeypatch.setattr(h, "FREQUENT", 10)
    rows = [(i, f"http://{'hot' if i % 3 else f'cold{i % 4}'}.example.org/{i}", f"<body><div><p>constant</p></div><div class=m><p>{f'words of {i} ' * 9}</p></div></body>") for i in range(60)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, n int").withColumn("wrapper", F.lit("w"))
    got = {r["page_id"]: r["text"] for r in h.main_texts(pages).collect()}
    assert got == {i: (f"words of {i} " * 9).strip() for i in range(60)}
