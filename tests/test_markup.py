"""Trees of broken markup, as the HTML standard builds them."""

import random
import time

import pytest

from siltstone.operators.markdown import Node, convert, parse


def shown(n):
    return "".join(k if isinstance(k, str) else f"<{k.tag}>{shown(k)}</{k.tag}>" for k in n.kids)


CASES = [
    # content of tables outside of cells stands before them
    ("<table>x<tr>y<td>z</table>w", "xy<table><tr><td>z</td></tr></table>w"),
    ("<div><table><div>q</div><tr><td>r</div>s</td></tr></table>t</div>u", "<div><div>q</div><table><tr><td>rs</td></tr></table>t</div>u"),
    ("<table><b>x<tr><td>y</table>z", "<b>x</b><table><tr><td>y</td></tr></table><b>z</b>"),
    ("<table><td>a<td>b<tr><td>c</table>", "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>"),
    ("<table><tr><td>a<table><tr><td>i</table>b</table>c", "<table><tr><td>a<table><tr><td>i</td></tr></table>b</td></tr></table>c"),
    # formats closed out of order, or left open at the end of a block
    ("<p>1<b>2<i>3</b>4</i>5</p>", "<p>1<b>2<i>3</i></b><i>4</i>5</p>"),
    ("<b>1<p>2</b>3</p>", "<b>1</b><p><b>2</b>3</p>"),
    ("<p><b>x<p>y</b>z", "<p><b>x</b></p><p><b>y</b>z</p>"),
    ("<a href=x>1<a href=y>2</a>3", "<a>1</a><a>2</a>3"),
    ("<a>1<div>2<div>3</a>4</div>5</div>6", "<a>1</a><div><a>2</a><div><a>3</a>4</div>5</div>6"),
    ("<table><tr><td><b>x</td><td>y</td></tr></table>z", "<table><tr><td><b>x</b></td><td>y</td></tr></table>z"),
    ("<i><table><tr><td></i>q</table>r", "<i><table><tr><td>q</td></tr></table>r</i>"),
    # end tags
    ("<span>a<div>b</span>c</div>d</span>e", "<span>a<div>bc</div>d</span>e"),
    ("<h1>a<h2>b</h1>c", "<h1>a</h1><h2>b</h2>c"),
]


@pytest.mark.parametrize("html, tree", CASES)
def test_tree(html, tree):
    assert shown(parse(html)) == tree


def test_markdown_of_recovered_trees():
    assert convert("<main><p>a <b>bold<p>two</b> three</main>") == "a **bold**\n\n**two** three"
    assert convert("<main><table>note<tr><td>k<td>v</table></main>").startswith("note\n\n")


def test_any_markup_keeps_its_text_and_forms_a_tree():
    r = random.Random(7)
    bits = [f"<{c}{t}>" for t in "p b i a em strong div li ul td tr table th tbody caption h1 h2 span br details".split() for c in ("", "/")]
    for _ in range(3000):
        n = r.randrange(1, 40)
        html = "".join(r.choice(bits) + chr(97 + k % 26) for k in range(n))
        root = parse(html)
        assert sorted(root.text()) == sorted(chr(97 + k % 26) for k in range(n))
        seen = set()
        for node in root.walk():
            assert id(node) not in seen
            seen.add(id(node))
            assert all(k.up is node for k in node.kids if isinstance(k, Node))


def test_recovery_stays_linear():
    for html in ("<b><p>x" * 5000, "<b>x</i>" * 10000, "<div>" * 5000 + "</span>" * 5000, "<table><b>" * 3000, "<a><div>" * 3000, "<b><i>x</b></i>" * 5000):
        began = time.perf_counter()
        parse(html)
        assert time.perf_counter() - began < 10
