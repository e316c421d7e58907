"""How broken markup is repaired: fixtures of what a recovering parser makes of it."""

import pytest

from lumbung.sources import dom, pages


def shape(element):
    """An element's tree as text: tag(children)."""
    return "".join(c if isinstance(c, str) else f"{c.tag}({shape(c)})" for c in element.children)


@pytest.mark.parametrize(
    ("source", "tree"),
    [
        ("<p>a<p>b", "p(a)p(b)"), ("<p><b>a<br><p>b", "p(b(abr()))p(b)"), ("<p><span>a<div>b</div></span>c", "p(span(adiv(b))c)"), ("<h1>a<p>b", "h1(a)p(b)"), ("<h2>a<h3>b", "h2(a)h3(b)"),
        ("<ul><li>a<li>b</ul>c", "ul(li(a)li(b))c"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "ul(li(aul(li(b)))li(c))"), ("<dl><dt>a<dd>b<dt>c</dl>", "dl(dt(a)dd(b)dt(c))"), ("<a>x<a>y", "a(x)a(y)"),
        ("<div><table><tr><td>x</div>y</table>z", "div(table(tr(td(xy)))z)"), ("<table><tr><td>a<td>b<tr><td>c</table>d", "table(tr(td(a)td(b))tr(td(c)))d"), ("<table><tr><td><b>a</tr>x</table>", "table(tr(td(b(a)))x)"),
        ("<div><p>a</div>b", "div(p(a))b"), ("<div><span>a</p>b</div>", "div(span(ab))"), ("<td>a</span></table>b", "td(ab)"), ("<i>a<b>b</i>c</b>", "i(ab(b))c"), ("<article>a<p>b<section>c</section></article>d", "article(ap(bsection(c)))d"),
        ("<p>x<script>var t='</p>'</script>y", "p(xscript(var t='</p>')y)"), ("<tbody><tr><td>a<tbody><tr><td>b", "tbody(tr(td(a)))tbody(tr(td(b)))"), ("<select><option>a<option>b</select>", "select(option(a)option(b))"), ("</div>a", "a"),
    ],
)
def test_repair(source, tree):
    assert shape(dom.parse(source)) == tree


def test_bodies_in_misnested_tables():
    html = "<h1>Long title</h1><div class=body><table><tr><td>one</div>two</td></tr></table>three</div>four"
    assert pages.read_page(html, pages.Site("s", title=("h1",), body=(".body",)))[1] == "onetwothree"
    assert pages.read_page("<h1>Title here<article>inside", pages.Site("s"))[:2] == ("Title hereinside", "inside")


def test_references_by_name_need_their_semicolon():
    html = '<h1>Salt &amp; pepper &ampPepper &lt;b&gt; &copy; &star; &copy &amp</h1><article>one &amp;amp two &am<script>a&b && "&lt"</script></article><time datetime="a&amp=b&amp;c&lt"></time>'
    title, body, raw, _ = pages.read_page(html, pages.Site("s", date=("time",), date_attribute="datetime"))
    assert title == "Salt & pepper &ampPepper <b> © &star; &copy &amp" and body == "one &amp two &am" and raw == ["a&amp=b&c&lt"]
    assert shape(dom.parse("<script>a&b && '&lt'</script>\ue000 &lt")) == "script(a&b && '&lt')\ue000 &lt"
