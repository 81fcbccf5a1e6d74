"""Page shapes, very long pages, and the equivalence classes against a plain version over one host."""

import time
from collections import Counter, defaultdict

import pytest

from probewatch.llm import pages

SHAPES = {
    "self-closing icon": ("<p>a <svg/> b</p><p>c</p>", "a b\nc"),
    "self-closing media": ("<p>a<audio controls/>b</p><iframe src='x'/><p>c</p>", "ab\nc"),
    "slash of a value": ("<p>a<audio src=http://h/>no</audio>b</p>", "ab"),
    "nested icon": ("<p>a <svg><title>t</title><svg>u</svg>v</svg> b</p>", "a b"),
    "frame without end": ("<p>a<iframe src=x>b</p><p>c</p>", "ab\nc"),
    "frame": ("<p>a<iframe src=x><p>no</p></iframe>b</p>", "ab"),
    "script without end": ("<p>a</p><script>var x='<p>no</p>'", "a"),
    "names of attributes": ("<div data-hidden='false' aria-hidden=x data-role='form'>t</div><div hidden>no</div>", "t"),
    "words of names": ("<div class='social-policy'>x</div><div id='content-form-letters'>y</div>", "x\ny"),
    "names of places": ("<div class='comments-area'>no</div><div id='left_sidebar'>no</div><div class='ad-slot-3'>no</div>y", "y"),
    "adverts in an article": ("<article><p>s</p><div class='ad'>no</div><div class='newsletter'>no</div>"
                              "<section id='comments'><article><p>no</p></article></section><p>e</p></article>", "s\ne"),
    "comment to the end": ("a<!-- no <p>no</p>", "a"),
    "comment after the last tag": ("<p>a</p><!-- no", "a"),
    "empty comment": ("a<!--><p>b</p>", "a\nb"),
    "declarations": ("<!DOCTYPE html><?xml x?></ b><p>c</>d</p>", "cd"),
    "signs": ("x < y and 3 <5 &lt;i&gt; <p>q", "x < y and 3 <5 <i>\nq"),
    "quote without end": ("<a x=\"<p>t</p>", "t"),
    "sign in a quote": ("<div title='a>b' class=\"ad\">no</div><p title=\"it's > that\">t</p>", "t"),
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(name):
    page, want = SHAPES[name]
    assert pages.main_text(page, frozenset()) == want


@pytest.mark.parametrize("page, n_chars", [
    ("<div>" * 200_000 + "x", 1), ("<div class=ad>" * 70_000 + "x", 0), ("<article>" + "<div class=sidebar>" * 50_000 + "x", 1),
    ("<a '" * 250_000, 1_000_000), ("<a '" * 250_000 + ">", 0), ("<a x='\"" * 140_000 + ">", 0), ("<svg>" * 200_000, 0),
    ("<svg><svg></svg>" * 60_000, 0), ("<div>" * 100_000 + "</section></p>" * 70_000, 0), ("<" * 1_000_000, 1_000_000),
    ("<iframe>" * 125_000 + "x", 1)])
def test_very_long_pages_are_read_once(page, n_chars):
    start = time.monotonic()
    assert len(pages.main_text(page, frozenset())) == n_chars
    assert time.monotonic() - start < 20


def _plain_template(htmls):
    """Words of the valid classes, from whole occurrence vectors in plain Python."""
    vectors = defaultdict(lambda: [0] * len(htmls))
    for at, html in enumerate(htmls):
        found, paths, _ = pages.blocks(html)
        for path, n in paths.items():
            vectors[path, None][at] = n
        for path in {b.path for b in found}:
            texts = [Counter(b.text.split()) for b in found if b.path == path]
            for word in set().union(*texts):
                if [t[word] for t in texts] == [1] * paths[path]:
                    vectors[path, word][at] = len(texts)
    classes = defaultdict(list)
    for token, vector in vectors.items():
        classes[tuple(vector)].append(token)
    most = max(sum(n > 0 for n in v) for v in classes)
    words = set()
    for vector, tokens in classes.items():
        on = sum(n > 0 for n in vector)
        if on >= pages.PAGES and on >= pages.SHARE * most and any(word is None for _, word in tokens):
            words |= {pages._key(path, word) for path, word in tokens if word is not None}
    return words


def test_classes_equal_the_plain_version(spark):
    def page(k):
        items = "".join(f"<li>Item {j} of {k % 3}</li>" for j in range(1 + k % 4))
        extra = f"<div class=box><p>Only sometimes {k}</p></div>" if k % 2 else ""
        return (f"<body><div class=top><p>Welcome to page {k}</p></div><ul>{items}</ul>{extra}<div class=wrap><p>By staff</p>"
                f"<p>Story {k} told the the way</p></div><div class=low><p>All kept {k % 5}</p></div></body>")
    htmls = [page(k) for k in range(23)]
    df = spark.createDataFrame([(f"http://h.example/{k}", h) for k, h in enumerate(htmls)] + [("http://h.example/again", htmls[3])],
                               "url string, html string").repartition(5)
    got = pages.templates(df).collect()
    assert [r["host"] for r in got] == ["h.example"]
    want = _plain_template(htmls)
    assert set(got[0]["tokens"]) == want and len(want) >= 5
