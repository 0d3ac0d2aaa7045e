"""Main text of pages whose adverts and notices have no telling names."""

import random

import numpy as np
import pytest

from tidewater.llm import extract

NOTICES = ["Buy two bottles, get one free! Order now", "Sponsored: the best deals of the week", "Sign up for our newsletter",
           "We use cookies to improve your visit. Accept all", "Great post, thanks! Reply", "Publicidad: compra ahora"]


def made(article, count=120):
    """Pages as (html, body texts): notices in plain elements beside or between the body's."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeilmnorstu") for _ in range(r.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    for _ in range(count):
        body = [text(5)] + [text(r.randint(15, 60)) for _ in range(r.randint(3, 8))]
        parts = [f"<h1>{body[0]}</h1>"] + [f"<p>{t}</p>" for t in body[1:]]
        notices = [f"<div>{t}</div>" for t in r.sample(NOTICES, 3)]
        if article:
            html = f"<main>{notices[0]}<article>{''.join(parts)}</article>{notices[1]}</main>{notices[2]}"
        else:
            for n in notices:
                parts.insert(r.randint(0, len(parts)), n)
            html = f"<div>{''.join(parts)}</div>"
        yield f"<html><body>{html}</body></html>", body


@pytest.mark.parametrize("article", [True, False])
def test_unnamed_notices_go(spark, article):
    pages = list(made(article))
    rows = [(i, "u", html, 1, "s") for i, (html, _) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int, n_chars string")
    got = {r.page_id: r.text for r in extract.extract(df).collect()}
    blocks = [(t in got[i], t in body) for i, (html, body) in enumerate(pages) for _, t in extract.leaves(html)]
    kept, main = np.array(blocks).T
    assert (kept & main).sum() >= 0.95 * main.sum()         # recall
    assert (kept & main).sum() >= 0.95 * kept.sum()         # precision


def test_quoted_attributes_are_no_text():
    page = ("<p title=\"x > y\">one</p><p a='>' b=\"u>\">two</p><p don't>three</p><p x=1>four</p>"
            "<div data-id=\"ad\" title='class=ad'>five</div><div class = 'Ad box'>six</div>")
    got = extract.leaves(page)
    assert [t for _, t in got] == ["one", "two", "three", "four", "five", "six"]
    assert extract.leaves('<p x="un>closed</p>') == [(["p"], "closed")]
    assert got[4][0] == ["div"] and got[5][0] == ["div", "ad", "box"]


def test_pages_advance_together_as_alone():
    rng = np.random.default_rng(1)
    shapes = [(extract.FEATURES, 4 * extract.HIDDEN), (extract.HIDDEN, 4 * extract.HIDDEN), (4 * extract.HIDDEN,)] * 2
    p = [rng.normal(0, 0.5, s) for s in shapes] + [rng.normal(0, 1, 2 * extract.HIDDEN), np.float64(0)]
    pages = [[(["html", "p"], f"word{i} other{j} {i * j}") for j in range(n)] for i, n in enumerate([3, 0, 7, 1, 3000, 7])]
    together = extract.predict(pages, p)
    assert [x.tolist() for x in together] == [extract.predict([page], p)[0].tolist() for page in pages]
    # the recurrence of training is the same as that of prediction
    x = extract.matrix(pages[2])[:, None]
    a, _ = extract.forward(x, *p[0:3])
    z, _ = extract.forward(x[::-1], *p[3:6])
    out = np.concatenate([a, z[::-1]], 2)[:, 0] @ p[6] + p[7]
    assert ((out >= 0) == together[2]).all()


def test_very_long_and_repeated_pages(spark):
    body = "<article>" + "<p>one two three</p>" * 20_000 + "<p>" + "long " * 200_000 + "</p></article><footer>foot</footer>"
    rows = [(1, "u", f"<html><body>{body}"), (None, None, "<article><p>x y z</p></article>"), (2, "a", ""), (2, "a", "")]
    rows += [(3, "b", "<html><body><nav>menu</nav><article><p>some words here</p></article>")] * 3
    got = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == 7 and text[2] == "" and text[3] == "some words here"
    assert text[1].count("one two three") == 20_000 and text[1].endswith("long long") and "foot" not in text[1]
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
