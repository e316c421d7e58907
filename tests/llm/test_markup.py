import random
import re

import pytest

from lumbung.llm import markup


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
        ("<p>One <b>two</b>\n three<p>Next<br>line", "One two three\n\nNext\nline"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>fig<td>12</table>", "Name   Qty\napple  3\nfig    12"),
        ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
        ("<pre>\n a\n   b</pre>x", " a\n   b\n\nx"),
        ("<dl><dt>t<dd>def</dl>", "t\n    def"), ("<blockquote>q1<p>q2</blockquote>", "> q1\n\n> q2"),
        ("a<script>var t='</p>'</script>b<style>p{}</style><!-- c -->d", "abd"),
        ("<details><summary>S</summary>hid</details><details open><summary>T</summary>seen</details>", "S\n\nT\nseen".replace("\n\n", "\n")),
        ("<p hidden>no<p style='display: none'>no<p style='visibility:hidden'>no<p>yes", "yes"),
        ("<style>.ad, p.x{color:red;display:none}</style><div class='b ad'>no</div><p class=x>no</p><div class=x>yes</div>", "yes"),
        ("<head><title>T</title><meta charset=x></head><body>b", "b"), ("</p>x</div></b>", "x"), ("x <img alt='pic'> y", "x pic y"),
        ("a < b and c > d", "a < b and c > d"), ("<td>cell</td>", "cell"), ("<a href='x>y'>l</a>", "l"), ("x<![CDATA[ y ]]>z", "x y z"), ("x <b", "x"),
        ("<style>@media print {.nav{display:none}} @media screen and (max-width: 600px) {.a{display:none}} @media (min-width:10px){.z{display:none}}</style><p class=nav>menu<p class=a>a<p class=z>no", "menu\n\na"),
        ("<style>.a{display:none} .a{display:block}</style><p class=a>x", "x"), ("<style>#i{display:block} .a{display:none}</style><p class=a id=i>x", "x"),
        ("<style>.a{display:none!important} #i{display:block}</style><p class=a id=i>x</p>y", "y"), ("<style>.a{display:none}</style><p class=a style='display:block'>x", "x"),
        ("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b> no</div>", "yes"), ("<style>.a .b{display:none} .c > .b{display:none}</style><i class=b>1</i><div class=a><p><i class=b>2</i></div><div class=c><i class=b>3</i><p><i class=b>4</i></div>", "1\n\n4"),
        ("<style>x,"+"y"*3000+",.q{display:none}</style><p class=q>no</p>yes", "yes"), ("<style>[data-x]{display:none} p:hover{display:none} .k+p{display:none}</style><p data-x>no</p><p>a", "a"),
        ("<svg><title>t</title><desc>d</desc><text x=1>drawn <tspan>text</tspan></text></svg> after", "drawn text after"), ("<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math>", "x=2"),
        ("<select><option>a<option selected>b<option>c</select>", "b"), ("<select><option>a<option>b</select>", "a"), ("<select multiple><option>a<option>b</select>", "a\nb"),
        ("<p hidden style='display:block'>x", "x"), ("<p title='" + "z" * 9000 + " > w'>x", "x"), ("<p title=\"a'b>c\">x<p title='d\"e>f'>y", "x\n\ny"),
        ("<div>" * 1000 + "<p style='display:none'>no</p>" + "</div>" * 1000 + "yes", "yes"), ("<i>" * 5000 + "<b hidden>no</b>" + "</i>" * 5000 + "yes", "yes"),
    ],
)
def test_layout(source, text):
    assert markup.render(source) == text


def test_all_visible_words_are_there_in_order():
    r = random.Random(3)
    for k in range(400):
        words, out = [], []
        for i in range(r.randint(1, 30)):
            tag = r.choice(("p div span b li h1 section em ul dl dd blockquote" if k % 2 else "p div li td tr table ul caption").split())
            out.append(r.choice([f"<{tag}>", f"</{tag}>", "", f"<{tag} class=a>"]))
            words.append(f"w{i}")
            out.append(f" w{i} ")
        found = re.findall(r"w\d+", markup.render("".join(out)))
        # what is in a table but in no cell is shown before the table
        assert found == words if k % 2 else sorted(found) == sorted(words), "".join(out)


@pytest.mark.parametrize("source", ["<div>" * 100_000 + "x", '<a "' * 20_000, "<ul><li>" * 1500, "<" * 100_000, "<table><tr><td>" * 500, "<!--" * 50_000, "&" * 100_000, "<p>" * 50_000, "<ul><li>x" * 20_000, "<p><table>" + "<b>" * 30_000 + "<div>" * 30_000, "<blockquote>a" * 20_000, "<a b=\"" * 30_000, "<a b='x' " * 30_000, "<style>" + "a{" * 50_000, "</b>" * 50_000 + "<b>" * 50_000 + "</i>" * 50_000])
def test_odd_pages_end(source):
    markup.render(source)


def seen(source):
    """The visible letters of a page of nested div elements, by a plain recursive reading of the same rules."""
    out = []
    rules = [((m[1], m[3]) if m[3] else (None, m[1]), 2 if m[3] else 1, m[4], m[5]) for m in re.finditer(r"\.(\w)( \.(\w))? \{(display|visibility):(\w+)\}", source.partition("</style>")[0])]
    path, shown, visible = [], [True], [True]
    for m in re.finditer(r"<div class=(\w)>|(</div>)|(w\d+)", source.partition("</style>")[2]):
        if m[1]:
            value = {}
            for (outer, own), weight, name, x in rules:
                if own == m[1] and (outer is None or outer in path) and value.get(name, (0,))[0] <= weight:
                    value[name] = (weight, x)
            path.append(m[1])
            shown.append(shown[-1] and value.get("display", (0, ""))[1] != "none")
            visible.append({"hidden": False, "visible": True}.get(value.get("visibility", (0, ""))[1], visible[-1]))
        elif m[2]:
            if path:
                path.pop(), shown.pop(), visible.pop()
        elif shown[-1] and visible[-1]:
            out.append(m[3])
    return out


def test_against_a_plain_reading():
    r = random.Random(11)
    for _ in range(300):
        rules = [f".{r.choice('abc')}{r.choice(['', ' .' + r.choice('abc')])} {{{r.choice(['display:none', 'display:block', 'visibility:hidden', 'visibility:visible'])}}}" for _ in range(r.randint(1, 6))]
        body, depth = [], 0
        for i in range(r.randint(1, 40)):
            if depth and r.random() < 0.4:
                body.append("</div>")
                depth -= 1
            elif r.random() < 0.6:
                body.append(f"<div class={r.choice('abcd')}>")
                depth += 1
            body.append(f"w{i} ")
        source = "<style>" + " ".join(rules) + "</style>" + "".join(body)
        assert re.findall(r"w\d+", markup.render(source)) == seen(source), source


def test_edges(spark):
    rows = [(1, "u", "<p>x", "a"), (1, "u", "<p>x", "a"), (2, None, None, "b"), (None, "u", "", "c"), (3, "u", "<p>" + "y " * 100_000, "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = markup.extract(df).collect()
    assert len(found) == 5 and sorted(r["n_lines"] for r in found) == [0, 0, 1, 1, 1]
    assert markup.extract(df.limit(0)).collect() == []


def test_clashing_columns(spark):
    rows = [(1, "<p>x", "t", 5, "s", "v")]
    found = markup.extract(spark.createDataFrame(rows, "page_id long, html string, text string, n_lines int, source string, visibility string"))
    assert found.columns == ["page_id", "text", "n_lines"] and tuple(found.first()) == (1, "x", 1)
