"""Page texts: broken markup, depth, names, and the ratios against a plain computation."""

import random
import time

import numpy as np
import pytest

from staywise.llm import page_text

PARAGRAPH = "<p>" + "The quick brown fox, as they say, jumps over the lazy dog. " * 5 + "</p>"


def size(html):
    return sum(map(len, page_text.main_blocks(html)))


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "comments-open", "share-price", "post-with-menu", "wrapper"])
@pytest.mark.parametrize("tag", ["div", "section", "article"])
def test_names_of_states_and_other_nouns_rule_nothing_out(name, tag):
    body = f"<{tag} class='{name}'><h1>Some title</h1>{PARAGRAPH * 4}</{tag}>"
    assert size(f"<body><nav>Home, sweet home.</nav>{body}</body>") == size(f"<body><div>{body.replace(name, 'x')}</div></body>") > 1000


@pytest.mark.parametrize("name", ["sidebar", "comments", "post-comments", "cookie-box", "ad", "site-footer", "nav-bar", "related"])
def test_names_of_small_elements_rule_them_out(name):
    html = f"<body><div class='{name}'>{PARAGRAPH.replace('fox', 'cat')}</div><div class=text><h1>Title</h1>{PARAGRAPH * 4}</div></body>"
    assert "cat" not in " ".join(page_text.main_blocks(html)) and size(html) > 1000


def test_comments_go_even_where_they_hold_most_of_the_page():
    html = f"<body><div><h1>T</h1>{PARAGRAPH * 2}</div><div class=comments>{PARAGRAPH.replace('fox', 'cat') * 9}</div></body>"
    assert "cat" not in " ".join(page_text.main_blocks(html)) and "fox" in " ".join(page_text.main_blocks(html))


def test_a_form_around_the_page_is_no_form():
    assert size(f"<body><form action=x><div><h1>T</h1>{PARAGRAPH * 3}</div></form></body>") == size(f"<body><div><h1>T</h1>{PARAGRAPH * 3}</div></body>")


def test_unnamed_menus_and_trailing_links_go_and_lists_of_the_text_stay():
    html = (
        "<body><ul><li><a href=a>Home</a><li><a href=b>News of today</a></ul><div><h1>Title</h1>"
        f"{PARAGRAPH * 2}<ul><li>first point<li>second point, too</ul>{PARAGRAPH}<h2>Steps</h2><ol><li>one<li>two</ol>"
        "<div>Next story <a href=z>More of it</a></div><h2>More stories</h2><ul><li><a>That</a><li><a>This</a></ul></div></body>"
    )
    got = [t if len(t) < 30 else "p" for t in page_text.main_blocks(html)]
    assert got[:6] == ["Title", "p", "p", "first point", "second point, too", "p"]
    assert not {"Home", "News of today", "Next story More of it", "More stories", "That", "This"} & set(got)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>a</p><![foo[ x ]]>", ["a"]),
        ("<p>a<![CDATA[ x ]]>b</p>", ["ab"]),
        ("<p>Hello &amp; bye.<!-- never closed <p>z", ["Hello & bye."]),
        ("<p>a<!-->b<!--->c<!-- x --!>d</p>", ["abcd"]),
        ("<p class='x>all of this is the name", []),
        ("<p title=\"a > b\">c < d, e.</p>", ["c < d, e."]),
        ("<script>if (a < b) document.write('</p>')</SCRIPT ><p>x</p>", ["x"]),
        ("<?xml version='1.0'?><!DOCTYPE html><p>x</p></bogus></ >", ["x"]),
        ("<table><tr><td>a, b<td>c, d<tr><td>e, f</table>", ["a, b", "c, d", "e, f"]),
    ],
)
def test_odd_markup_is_read_as_browsers_do(html, want):
    assert page_text.main_blocks(html) == want


def test_random_markup_never_fails():
    rng = random.Random(5)
    bits = "<p> </p> <div_class='a_b'> </div> <![ <!-- --> <a_href=\" \"> &amp; &#x text._ <li> <td> <tr> <table> </table> <header> <article> </article>"
    bits = [b.replace("_", " ") for b in (bits + " <h1> <script> </script> ' \" <? <!DOCTYPE ]]> <br/> <form> \x00 é <title> <textarea> = / >").split()]
    for _ in range(4_000):
        html = "".join(rng.choice(bits) for _ in range(rng.randrange(40)))
        assert all(isinstance(t, str) and t == " ".join(t.split()) != "" for t in page_text.main_blocks(html))


@pytest.mark.parametrize(
    "unit",
    ["<span>", "<div>", "<!--", '<a x="', "<![", "<", "</x><i></u>", "<table><tr><td>x", "<p>a<ul><li>b", "<h1><header>", "<b><p>x, y.</p>"],
)
def test_time_is_in_proportion_to_depth(unit):
    def seconds(n):
        start = time.process_time()
        page_text.main_blocks(unit * n + "text, here.")
        return time.process_time() - start

    small, large = seconds(5_000), seconds(40_000)
    assert large < 40 * max(small, 0.02)  # quadratic: 64 times


def test_ratios_equal_a_plain_computation():
    html = f"<body><div><h1>Head, line</h1>{PARAGRAPH}<p>Short.</p><ul><li>One, two<li>Three <a>four</a></ul></div><aside>{PARAGRAPH}</aside></body>"
    page, blocks, linked = page_text.page_blocks(html)

    def path(e):
        return [] if e is None else [*path(e.up), e.tag]

    size, marks = [], []
    for at, _ in blocks:
        same = [(t, k) for (a, t), k in zip(blocks, linked) if path(a) == path(at) and not a.out]
        size.append(0 if at.out else sum(len(t) - k for t, k in same) / len(same))
        marks.append(0 if at.out else sum(sum(c in ",.;" for c in t) for t, _ in same) / len(same))

    def smooth(x):
        x = [x[0], *x, x[-1]]
        return np.array([0.25 * a + 0.5 * b + 0.25 * c for a, b, c in zip(x, x[1:], x[2:])])

    want = smooth(size) * (1 + smooth(marks))
    assert np.allclose(page_text.block_ratios(blocks, linked), want)
    chosen = page_text.content_paths(blocks, want)
    mean = np.mean([r for (a, _), r in zip(blocks, want) if not a.out])
    by_path = {}
    for (a, _), r in zip(blocks, want):
        if not a.out:
            by_path.setdefault(a.path, []).append(r)
    assert chosen == {p for p, rs in by_path.items() if np.mean(rs) >= 0.5 * mean}
