import itertools
import random

import numpy as np
import pytest

from lendspan.llm import html

TEXT = "Sentence number {} of this article, with a clause; and some more words in it."


def page(k, shape=0):
    rng = random.Random(k)
    body = "".join(f"<p>{TEXT.format(n * k)}</p>" for n in range(1, rng.randint(3, 7)))
    return (
        f"<html><head><title>t</title><script>var a='<p>';</script></head><body><nav><ul>"
        f"{''.join(f'<li><a href=/{n}>Item {n}</a></li>' for n in range(5))}</ul></nav><div class=ad>Buy {k} now!</div>"
        f"<article><h1>Title {k}</h1>{body}</article><footer>&copy; {k}</footer></body></html>"
    )


def truth(k):
    rng = random.Random(k)
    return "\n".join([f"Title {k}", *[TEXT.format(n * k) for n in range(1, rng.randint(3, 7))]])


@pytest.fixture(scope="module")
def extractor():
    return html.train([page(k) for k in range(1, 80)])


def test_held_out_pages_and_layouts_that_pages_do_not_show(extractor):
    assert extractor.extract([page(k) for k in range(200, 230)]) == [truth(k) for k in range(200, 230)]
    other = (
        "<body><header class='site-header'><a href=/>Home</a></header><div id=sidebar><h3>Popular</h3><ul><li><a href=x>A story"
        "<li><a href=y>B story</a></ul></div><div class='post-content'><h1>Heading</h1>"
        f"<p>{TEXT.format(1)}<div class='advertisement'>Buy this</div><p>{TEXT.format(2)}  <b>Bold</b>&amp; more<br>line"
        "<form><input><button>Send</button></form></div>"
        "<section class='comments'><div class=comment><p>Nice post, I liked it a lot. Thanks!</p></div></section></body>"
    )
    expected = f"Heading\n{TEXT.format(1)}\n{TEXT.format(2)} Bold& more line"
    assert extractor.extract([other]) == [expected]


def test_decoding_is_consistent_and_best():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = 8
        parent = [-1, *[int(rng.integers(0, k)) for k in range(1, n)]]
        margin = rng.normal(0, 2, n)
        keep, drop = -np.logaddexp(0, -margin), -np.logaddexp(0, margin)
        best = max(
            (c for c in itertools.product((True, False), repeat=n - 1) if all(not y or p == 0 or c[p - 1] for y, p in zip(c, parent[1:], strict=True))),
            key=lambda c: sum(keep[k + 1] if y else drop[k + 1] for k, y in enumerate(c)),
        )
        assert html.decode(parent, margin).tolist()[1:] == list(best)


def test_broken_markup_does_not_fail(extractor):
    sources = ["", "<", "<p", "</p></p>", "<script>never closed", "<!-- never closed", "<p>" * 3000 + "x", "<div>" * 3000 + "deep", "a & b &amp; c &#x41;"]
    found = extractor.extract(sources)
    assert len(found) == len(sources) and found[0] == "" and found[-1] == "a & b & c A"


def test_rows(spark):
    rows = [(k, f"http://x/{k}", page(k), "c") for k in range(1, 40)]
    rows += [(90, None, None, "c"), (None, "u", "", "c"), (5, "http://x/5", page(5), "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in html.main_texts(pages).collect()), key=str)
    expected = [(k, u, truth(k) if h else "", len(truth(k)) if h else 0) for k, u, h, _ in rows]
    assert got == sorted(expected, key=str)
    assert html.main_texts(pages.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, "u", None)], "page_id long, url string, html string")
    assert [tuple(r) for r in html.main_texts(empty).collect()] == [(1, "u", "", 0)]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        # tags that may be left out, and text right behind a head
        ("<html><head><title>t</title><meta charset=utf-8><article><p>{}</p></article>", ["{}"]),
        ("<head><title>t</title>{}", ["{}"]),
        ("<head><title>t</title></head><p>{}", ["{}"]),
        # closed within the tag
        ("<body><p>{}<svg/></p><iframe src='x' /><object data=x /><canvas/><p>{}</p>", ["{}", "{}"]),
        ("<body><svg><text>no</text></svg><p>{}</p><iframe>no</iframe>", ["{}"]),
        ("<body><p>{} <math><mi>x</mi><mo>+</mo><mn>1</mn></math> {}</p>", ["{} x+1 {}"]),
    ],
)
def test_no_text_is_lost_to_markup_left_out(source, expected):
    found = html.Page(source.replace("{}", TEXT))
    texts = {}
    for _, block, text in found.pieces:
        texts[block] = texts.get(block, "") + text
    assert [" ".join(t.split()) for t in texts.values() if t.strip()] == [e.replace("{}", TEXT) for e in expected]
