import random
import re
import time

import pytest

from lumbung.llm import markup, styles

HIDE = "{display:none}"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        # media
        ('<style media="print">p{display:none}</style><p>visible', "visible"), ('<style media="screen, print">p{display:none}</style><p>no</p>yes', "yes"),
        ("<style>@media (prefers-color-scheme: dark){p{display:none}}</style><p>visible", "visible"), ("<style>@media (min-resolution: 2dppx){p{display:none}}</style><p>visible", "visible"),
        ("<style>@media not all and (monochrome){p{display:none}}</style><p>visible", "visible"), ("<style>@media not print{p{display:none}}</style><p>no</p>yes", "yes"),
        ("<style>@media (width >= 600px) and (orientation: landscape){p{display:none}}</style><p>no</p>yes", "yes"), ("<style>@media (400px <= width <= 900px){p{display:none}}</style><p>visible", "visible"),
        ("<style>@media (max-width:10px) or (hover){p{display:none}}</style><p>no</p>yes", "yes"), ("<style>@media tv, (max-width: 20em){p{display:none}}</style><p>visible", "visible"),
        ("<style>@supports not (display:grid){p{display:none}} @container (min-width:1px){p{display:none}} @layer a{i{display:none}}</style><p>visible<i>no", "visible"),
        # selectors
        ("<style>p:not(.a){display:none}</style><p class=a>yes<p>no", "yes"), ("<style>:is(.a, i) b{display:none}</style><i><b>no</b></i><u><b>yes</b></u>", "yes"), ("<style>:where(.a, #b){display:none}</style><p class=a>no<p id=b>no<p>yes", "yes"),
        ("<style>.k+p{display:none}</style><p class=k>a<p>no<p>b", "a\n\nb"), ("<style>.k~p{display:none}</style><p>a<p class=k>b<i>x</i><p>no<p>no", "a\n\nbx"), ("<style>li:first-child,li:nth-child(2n+4),li:last-child{display:none}</style><ul><li>1<li>2<li>3<li>4<li>5<li>6", "- 2\n- 3\n- 5"),
        ("<style>[class*='ad-']{display:none}[data-x^=a]{display:none}[href$='.js' i]{display:none}[lang|=de]{display:none}[rel~=b]{display:none}</style><p class='x ad-1'>no<p data-x=ab>no<a href=y.JS>no</a><p lang=de-AT>no<p rel='a b'>no<p class=ad>yes", "yes"),
        ("<style>.a{color:red;.b{display:none} &.c{display:none} > i{display:none}}</style><div class=a>1<b class=b>no</b><i>no</i><u><i>2</i></u></div><div class='a c'>no</div><b class=b>3</b>", "12\n3"),
        ("<style>a:hover,a:focus,p::before,p:not(:hover) b{display:none}</style><p><a>x</a> <b>no</b>", "x"), ("<style>p:unknown-thing(3){display:none}</style><p>yes", "yes"), ("<style>p:nth-of-type(odd){display:none}</style><p>1<p>2<div>d</div><p>3", "2\n\nd"),
        ("<style>#a .b:not(#c){display:none} .b.b.b{display:block}</style><div id=a><p class=b>no</div>yes", "yes"), ("<style>:root{visibility:hidden} :root p{visibility:visible}</style>no<p>yes", "yes"), ("<style>p:empty{display:none}</style><p></p><p>x", "x"),
        ('<style>a[title="x, y > z"]{display:none}</style><a title="x, y > z">no</a>yes', "yes"), ("<style>.a\\:b{display:none}</style><p class='a:b'>no</p>yes", "yes"),
        # layout
        ("a<span style=display:block>b</span>c", "a\nb\nc"), ("a <div style='display:inline'>b</div> c", "a b c"), ("<ul><li style='display:inline-block'>a</li> <li style=display:inline>b</li></ul>", "a b"),
        ("<p style='white-space:pre'>a\n  b   c</p>", "a\n  b   c"), ("<div style='white-space:pre-line'>a  b\n  c</div>d", "a b\nc\nd"), ("<pre style='white-space:normal'>a\n  b</pre>", "a b"), ("<textarea>\na\n b</textarea>", "a\n b"),
        ("<ul style='list-style:none'><li>a<li>b</ul>", "a\nb"), ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"), ("<ol type=I><li>x<li value=14>y</ol>", "I. x\nXIV. y"), ("<ol reversed><li>x<li>y<li>z</ol>", "3. x\n2. y\n1. z"),
        ("<ol style='list-style-type:lower-roman'><li>x<li>y<ul><li>u</ul></ol>", "i. x\nii. y\n    - u"), ("<ol><li>a<ol><li>b</ol><li>c</ol>", "1. a\n   1. b\n2. c"), ("<style>.d{list-style:square inside}</style><ol class=d><li>x</ol>", "- x"),
        ("<table><tr><td rowspan=0>r<td>1<tr><td>2<tr><td>3</table>", "r  1\n   2\n   3"), ("<table><tbody><tr><td rowspan=9>r<td>1<tr><td>2<tbody><tr><td>3<td>4</table>", "r  1\n   2\n3  4"),
        ("<table><tr><td colspan=300>a<td>b<tr>" + "<td>" * 300 + "<td>c</table>", "a  b\n   c"), ("<table><tr style=display:block><td style=display:block>x</td><td>y</table>", "x\ny"),
    ],
)
def test_page(source, text):
    assert markup.render(source) == text


def plain(tree, rules, path=()):
    """Letters of a tree that are shown, by trying every rule at every element with its own recursion."""
    tag, classes, children, letter = tree
    if any(_fits(parts, len(parts) - 1, path, tree) for parts in rules):
        return ""
    return letter + "".join(plain(c, rules, (*path, (tree, i))) for i, c in enumerate(children))


def _fits(parts, i, path, tree):
    sign, tag, name, banned = parts[i]
    if (tag and tree[0] != tag) or (name and name not in tree[1]) or (banned and banned in tree[1]):
        return False
    if i == 0:
        return True
    if not path:
        return False
    parent, at = path[-1]
    if sign == ">":
        return _fits(parts, i - 1, path[:-1], parent)
    if sign == " ":
        return any(_fits(parts, i - 1, path[:k], path[k][0]) for k in range(len(path)))
    before = parent[2][at - 1 : at] if sign == "+" and at else parent[2][:at] if sign == "~" else []
    return any(_fits(parts, i - 1, (*path[:-1], (parent, k)), e) for k, e in ((parent[2].index(e), e) for e in before))


def test_chains_against_a_plain_reading():
    r = random.Random(4)
    letters = iter(range(10**9))

    def tree(depth):
        return (r.choice("bi"), tuple(r.sample("xyz", r.randint(0, 2))), [tree(depth - 1) for _ in range(r.randint(0, 3) if depth else 0)], f"w{next(letters)} ")

    def source(t):
        return f"<{t[0]} class='{' '.join(t[1])}'>{t[3]}{''.join(map(source, t[2]))}</{t[0]}>"

    for _ in range(300):
        t = tree(4)
        rules = []
        for _ in range(r.randint(1, 3)):
            rules.append([("" if not k else r.choice(" >+~"), r.choice(["", "b", "i"]), r.choice("xyz"), r.choice(["", "", "x", "z"])) for k in range(r.randint(1, 4))])
        sheet = "".join("".join(f"{p[0]}{p[1]}.{p[2]}{f':not(.{p[3]})' if p[3] else ''}" for p in parts) + HIDE for parts in rules)
        whole = ("html", (), [t], "")
        assert re.findall(r"w\d+", markup.render(f"<style>{sheet}</style>{source(t)}")) == plain(whole, rules).split(), sheet


@pytest.mark.parametrize("source", ["<style>b b b b{display:none}</style>" + "<b>" * 20_000, "<style>p~p~p+p{display:none}</style>" + "<p>x" * 20_000, "<style>" + ":not(" * 5000 + HIDE, "<style>" + "a{&" * 3000, "<style>p:nth-child(3n) i{display:none}</style>" + "<p><i>x" * 5000, "<style>@media " + "(" * 20_000 + "{p{display:none}}</style>x"])
def test_long_pages_and_sheets_end(source):
    began = time.time()
    markup.render(source)
    assert time.time() - began < 20


def test_media_and_nth():
    assert styles.for_screen("") and styles.for_screen("only screen and (min-width: 40em)") and not styles.for_screen("(max-width: 799.5px)") and not styles.for_screen("not screen")
    assert styles._nth("-n+3") == (-1, 3) and styles._nth("even") == (2, 0) and styles._nth("5") == (0, 5) and styles._nth("x") is None
