from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from foliant.functions import blocks, chunks, cues, header, html, inline, names, once, text

C = F.col


def test_word_counts(one):
    assert one(text.count_words(C("t")), t=" a\u00a0b\ufeffc  d ") == 4
    assert one(text.count_content_words(C("t")), t="**a**b [c](d) # ~~") == 4
    assert one(text.count_words(C("t")), t="") == 0


@pytest.mark.parametrize("words, minutes", [(0, 1), (90, 1), (299, 1), (300, 2), (500, 3)])
def test_read_minutes(one, words, minutes):
    assert one(text.read_minutes(F.lit(words))) == minutes


@pytest.mark.parametrize("words, tokens", [(0, 0), (1, 2), (10, 13), (538, 700), (539, 701)])
def test_tokens(one, words, tokens):
    assert one(text.estimate_tokens(F.lit(words))) == tokens


@pytest.mark.parametrize("words, budget", [(199, 700), (200, 600), (1999, 600), (2000, 700)])
def test_budget(one, words, budget):
    assert one(chunks.token_budget(F.lit(words))) == budget


def reference_chunks(title, content):
    """Chunks by the documented rules, word by word."""
    import math
    import re

    def size(t):
        return math.ceil(len(t.split()) * 1.3)

    def split(t, budget):
        words, n = t.split(), max(1, math.floor(budget / 1.3))
        return [" ".join(words[i : i + n]) for i in range(0, len(words), n)]

    n = len(content.split())
    budget = 600 if 200 <= n < 2000 else 700
    done, held = [], []
    for p in (p.strip() for p in re.split(r"\n\n+", content)):
        if not p:
            continue
        if size(p) > budget or sum(map(size, held)) + size(p) > budget:
            done += ["\n\n".join(held)] if held else []
            held = []
        if size(p) > budget:
            done += split(p, budget)
        else:
            held.append(p)
    done += ["\n\n".join(held)] if held else []
    done = done or [content.strip()]
    bounded = []
    for c in done:
        bounded += split(c, 700) if size(f"[{title}] - {c}") > 700 else [c]
    return [f"[{title}] - {c.strip()}" for c in bounded]


def test_chunks_against_rules(spark):
    import random

    rng = random.Random(3)
    texts = ["", "  \n\n ", "one"]
    for sizes in ([199], [200], [461, 462], [538, 539], [1999], [2000], [100] * 30, [5] * 400, [700, 3, 700]):
        texts.append("\n\n".join(" ".join(["w"] * n) for n in sizes))
    texts += ["\n\n\n".join(" ".join(["w"] * rng.randint(1, 900)) for _ in range(rng.randint(1, 9))) for _ in range(30)]
    rows = [(i, f"Title {i}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, title string, content string")
    for r in df.select("*", chunks.chunk(C("title"), C("content")).alias("c")).collect():
        assert r["c"] == reference_chunks(r["title"], r["content"])


def test_empty_body_is_one_chunk(one):
    assert one(chunks.chunk(F.lit("T"), C("t")), t="") == ["[T] - "]


def test_excerpt(one):
    assert one(text.excerpt(C("t"), 10), t="# Hello **big** world") == "Hello big…"
    assert one(text.excerpt(C("t"), 10), t="Helloworldwide") == "Helloworld…"
    assert one(text.excerpt(C("t"), 50), t="`code` [a](b)") == "a"


def test_title_case_like_python(one):
    for value in ("it's a test 3d", "ÉCOLE o'neil x-y", "a1b2c", ""):
        assert one(text.title_case(C("t")), t=value) == value.title()


def test_slugs(one):
    slug = names.base_slug(C("t"), F.lit(7))
    assert one(slug, t="012_Who's There?_x.MD") == "7-who-s-there-_x"
    assert one(names.base_slug(C("t"), F.lit(7), any_case_suffix=False), t="a.MD") == "7-a-md"
    assert one(names.category_id(C("t")), t="topics") == 0
    assert one(names.category_slug(C("t")), t="07_Hadith_Lit") == "hadith-lit"
    assert one(names.safe_filename(C("t")), t='  "What?" is <this>: Ünïcode/…  ') == "what_is_this_ünïcode"
    assert one(names.safe_filename(C("t")), t="???") == "untitled"
    assert one(names.safe_filename(C("t")), t="a" * 79 + "_b") == "a" * 79
    assert one(names.slugify(C("t")), t=" Hello,  World_Again! ") == "hello_world_again"
    assert one(names.display_name(C("t")), t="19_new_analysis of") == "New Analysis Of"


def test_urls(one):
    assert one(names.url_key(C("t")), t="HTTP://A/b//") == "http://a/b"
    assert one(names.is_external(C("t"), ["mine"]), t="http://other.example/") is True
    assert one(names.is_external(C("t"), ["mine"]), t="/relative") is False
    assert one(names.site_name(C("t"), {"yt": "Tube"}), t="https://www.some-site.org/x") == "Some-Site"
    assert one(names.site_name(C("t"), {"yt": "Tube"}), t="https://yt.be/x") == "Tube"
    assert one(names.resolve_url(F.lit("http://a/b/c.htm"), C("t")), t="../d.htm") == "http://a/d.htm"


RAW = "\ufeff# A title \n\n**Source:** [x](http://u/1) (more)\n\n**Category:** 01 General \n\n --- \n\nBody\n---\nend\n"


def test_header(one):
    name = F.lit("003_some_name.md")
    assert one(header.title(C("t"), name), t=RAW) == "A title"
    assert one(header.title(C("t"), name), t="no heading") == "some name"
    assert one(header.title(C("t"), name), t="#\n# later") == "some name"
    assert one(header.source_url(C("t")), t=RAW) == "http://u/1"
    assert one(header.source_url(C("t")), t="x\n**Source:** http://p \n") == "http://p"
    assert one(header.source_url(C("t")), t="**Source:**\n") is None
    assert one(header.category_name(C("t")), t=RAW) == "01 General"
    assert one(header.category_name(C("t")), t="x") == ""
    assert one(header.body(C("t")), t=RAW) == "Body\n---\nend"
    assert one(header.body(C("t")), t=" whole ") == "whole"
    assert one(header.body(C("t")), t="a\r\n---\r\nb\r\nc") == "b\nc"
    assert one(header.shown_title(C("t"), F.lit("slug")), t="## no\n# \n# yes ") == "yes"
    assert one(header.shown_source_url(C("t")), t="**Source:** http://p") is None
    assert one(header.shown_source_url(C("t")), t=RAW) == "http://u/1"


def test_cues(one):
    vtt = "WEBVTT\nKind: x\n\n1\n00:00:01.000 --> 00:00:02.000\n<c>Hello</c> there\n\n2\nHello there\n bye \n"
    assert one(cues.clean_cues(C("t")), t=vtt) == "Hello there bye"
    assert one(cues.matched_keywords(C("t"), F.lit(None)), t="Islam and the Imam: islamic, imam") == ["imam", "islam"]


def test_page_parts(one):
    page = (
        "<html><head><title> A &amp; <b>B</b> </title></head><body><main>no</main><article class='x'>"
        "<h2>Head</h2><p>One <b>two</b> <i>three</i><br>four</p><article>inner</article>"
        "<script>var a='</article>';</script><a href='/x?a=1&amp;b=2'>link</a></article><p>after</p></body></html>"
    )
    assert one(html.page_title(C("t")), t=page) == "A &B"
    assert one(html.page_title(C("t")), t="<title></title><h3>c</h3><h2>b</h2>") == "b"
    area = one(html.content_area(C("t")), t=page)
    assert area.startswith("<article") and area.endswith("</article>") and "after" not in area
    assert "link" in area
    markdown = one(html.to_markdown(html.content_area(C("t"))), t=page)
    assert markdown == (
        "## Head\n\nOne **two** _three_  \nfour\n\ninner\n\n[link](/x?a=1&b=2)"
    )
    assert one(html.content_area(C("t")), t='<div class="a content b">x<div>y</div></div>z') == (
        '<div class="a content b">x<div>y</div></div>'
    )
    links = one(html.links(C("t")), t='<a href="#a">x</a><a href="m">Home</a><a href=z.htm><b>Go</b> on</a>')
    assert [(x["title"], x["href"]) for x in links] == [("Goon", "z.htm")]


CONVERTED = {
    "<ol><li>one <li>two</li></ol>end": "1. one\n  2. two\n\nend",
    "a<blockquote><p>q</p><p>r</p></blockquote>b": "a\n\n> q\n> \n> r\n\nb",
    "x<pre class='y'>\nif a:\n    <b>b</b>\n</pre>z": "x\n\n```\nif a:\n    b\n```\n\nz",
    "use <code>f(x)</code> now": "use `f(x)` now",
    "<table><tr><th>A</th><th>B</th></tr>\n<tr><td>1</td><td><i>2</i></td></tr></table>t": (
        "| A | B |\n| --- | --- |\n| 1 | _2_ |\n\nt"
    ),
    "<ul><li>a</li><li>b</li></ul><ol><li>c</li></ol>": "* a\n\n  * b\n\n  1. c",
    "<pre>never closed": "```\nnever closed\n```",
    "<ol><li>a<ol><li>b</li></ol></li><li>c</li></ol>": "1. a\n    1. b\n\n  2. c",
    "<ol start=5><li>a<ul><li>b<ol start='0'><li>c</ol></ul><li>d</ol>": "5. a\n    * b\n      0. c\n  6. d",
    "<blockquote>a<blockquote><p>b</p> <p>c</blockquote>d</blockquote>e": "> a\n> \n> > b\n> > \n> > c\n> \n> d\n\ne",
    "<ul><li>x<blockquote>q</blockquote></li></ul><blockquote><ol><li>y</ol></blockquote>": "* x\n\n> q\n\n>   1. y",
    "<blockquote><pre>\na\n  b</pre></blockquote>": "> ```\n> a\n>   b\n> ```",
    "</ol></li></blockquote>x<li>y</pre>": "x\n  * y",
    "<a href=/y>un</a> <a class=k href=https://h/?a=1 title='t'>quoted</a>": "[un](/y) [quoted](https://h/?a=1)",
}


def test_structure_survives_conversion(spark):
    assert rendered(spark, html.to_markdown, CONVERTED) == CONVERTED


LAYOUT = {
    "<table><tr><td>article text<table><tr><td>in</td></tr></table>more</td></tr></table>end": "article text in more end",
    "<table><tr><td>one<td>two<tr><td>three<td>four</table>end": "one two three four end",
    "<table><tr><th>A</th><th>B<tr><td>1</td><td>2</td></tr></table>": "A B 1 2",
    "<table><tr><td>a</td>behind</tr><tr><td>b</td></tr>last</table>": "a behind b last",
    "<table><tr><td>before<blockquote>quoted</blockquote>after</td></tr></table>": "before quoted after",
    "<td width=9>area<table><tr><td>x</td></tr></table>rest</td></tr></table>foot": "area x rest foot",
    "<table><tr><td>a</td></tr></table>b<table><tr><td>c": "a b c",
    "<table><tr><td>a</td><td>left": "a left",
}


@pytest.mark.parametrize("page", LAYOUT)
def test_layout_tables_keep_their_text(one, page):
    found = one(html.to_markdown(C("t")), t=page)
    assert " ".join(w for w in found.split() if w.strip("|->")) == LAYOUT[page]


RENDERED = {
    "# T\n\nsome **bold** <x>y\nline\n\n- a\n- b\n\n[l](javascript:x) [m](/y)": (
        "<h1>T</h1>\n\n<p>some <strong>bold</strong> y\nline</p>\n\n<ul>\n<li>a</li>\n<li>b</li>\n</ul>"
        '\n\n<p>[l](javascript:x) <a href="/y">m</a></p>'
    ),
    "1. one\n2. two\n\nend": "<ol>\n<li>one</li>\n<li>two</li>\n</ol>\n\n<p>end</p>",
    "- a\n  - b\n- c": "<ul>\n<li>a\n<ul>\n<li>b</li>\n</ul></li>\n<li>c</li>\n</ul>",
    "1. a\n   - b\n   - c": "<ol>\n<li>a\n<ul>\n<li>b</li>\n<li>c</li>\n</ul></li>\n</ol>",
    "> q\n> r\n\ns": "<blockquote>\n<p>q\nr</p>\n</blockquote>\n\n<p>s</p>",
    "| A | B |\n| --- | :-: |\n| 1 | 2 |\n\nx": (
        "<table>\n<tr><th>A</th><th>B</th></tr>\n<tr><td>1</td><td>2</td></tr>\n</table>\n\n<p>x</p>"
    ),
    "a  \nb\\\nc": "<p>a<br>\nb<br>\nc</p>",
    "![i](https://h/i.png) ![x](javascript:a)": '<p><img src="https://h/i.png" alt="i"> x</p>',
    "p\n\n```py\nif a < b: *x*\n```\n\nq `c`": (
        "<p>p</p>\n\n<pre><code>if a &lt; b: *x*\n</code></pre><p>q <code>c</code></p>"
    ),
    "<script>x</script>a <b>b</b> 3 < 4 <https://h/c>": (
        '<p>a b 3 &lt; 4 <a href="https://h/c">https://h/c</a></p>'
    ),
    "": "",
    "- a\n  - b\n    - c\n      - d\n- e":"<ul>\n<li>a\n<ul>\n<li>b\n<ul>\n<li>c\n<ul>\n<li>d</li>\n</ul></li>\n</ul></li>\n</ul></li>\n<li>e</li>\n</ul>",
    "- a\n\n- b\n- c":"<ul>\n<li><p>a</p></li>\n<li><p>b</p></li>\n<li><p>c</p></li>\n</ul>",
    "- a\n\n  more\n- b":"<ul>\n<li><p>a</p>\n<p>more</p></li>\n<li><p>b</p></li>\n</ul>",
    "- a\n  - b\n\n- c":"<ul>\n<li><p>a</p>\n<ul>\n<li>b</li>\n</ul></li>\n<li><p>c</p></li>\n</ul>",
    "> a\n> - b\n>   - c\n>\n> d\n\ne":"<blockquote>\n<p>a</p>\n<ul>\n<li>b\n<ul>\n<li>c</li>\n</ul></li>\n</ul>\n<p>d</p>\n</blockquote>\n\n<p>e</p>",
    "> a\n> > b\n> > c\n":"<blockquote>\n<p>a</p>\n<blockquote>\n<p>b\nc</p>\n</blockquote>\n</blockquote>",
    "Title\n=====\n\nSub\n---\ntext":"<h1>Title</h1>\n\n<h2>Sub</h2>\n\n<p>text</p>",
    "3. a\n4. b\n\n- x\n* y":'<ol start="3">\n<li>a</li>\n<li>b</li>\n</ol>\n\n<ul>\n<li>x</li>\n</ul>\n\n<ul>\n<li>y</li>\n</ul>',
    "- a\nlazy\n\nend":"<ul>\n<li>a\nlazy</li>\n</ul>\n\n<p>end</p>",
    "text\n- a\n\n    code\n    more\n\nend":"<p>text</p>\n\n<ul>\n<li><p>a</p>\n<p>code\nmore</p></li>\n</ul>\n\n<p>end</p>",
    "p\n\n    a *b*\n\n    c < d\n\ne":"<p>p</p>\n\n<pre><code>a *b*\n\nc &lt; d\n</code></pre><p>e</p>",
    "1. a\n   ```\n   x *y*\n\n   z\n   ```\n2. b":"<ol>\n<li>a\n<pre><code>x *y*\n\nz\n</code></pre></li>\n<li>b</li>\n</ol>",
    "a\n\n***\n\n- - x\n":"<p>a</p>\n\n<hr>\n\n<ul>\n<li>\n<ul>\n<li>x</li>\n</ul></li>\n</ul>",
    "# A `b` #\n## *c*\ntext **x\ny**":"<h1>A <code>b</code></h1>\n\n<h2><em>c</em></h2>\n\n<p>text <strong>x\ny</strong></p>",
    "a | b\n- | -\n*c* | d \\| e\n":"<table>\n<tr><th>a</th><th>b</th></tr>\n<tr><td><em>c</em></td><td>d | e</td></tr>\n</table>",
    "see https://h.example/a_b_c and 1986. x\n14. y":'<p>see <a href="https://h.example/a_b_c">https://h.example/a_b_c</a> and 1986. x\n14. y</p>',
    "~~~\n# no\n~~~\nyes":"<pre><code># no\n</code></pre><p>yes</p>",
}

MARKS = {
    "plain & <b>x</b> 3 < 4":"plain &amp; x 3 &lt; 4",
    "`a*b*c`":"<code>a*b*c</code>",
    "``a`b`` and `<b>`":"<code>a`b</code> and <code>&lt;b&gt;</code>",
    "**bold *in* it**":"<strong>bold <em>in</em> it</strong>",
    "*a **b** c*":"<em>a <strong>b</strong> c</em>",
    "***a***":"<em><strong>a</strong></em>",
    "***a** b*":"<em><strong>a</strong> b</em>",
    "**a *b***":"<strong>a <em>b</em></strong>",
    "snake_case_name _em_ __st__ a_b_":"snake_case_name <em>em</em> <strong>st</strong> a_b_",
    "2 * 3 * 4 and *a":"2 * 3 * 4 and *a",
    "*a `*` b*":"<em>a <code>*</code> b</em>",
    "[x](https://h.example/_b_/)":'<a href="https://h.example/_b_/">x</a>',
    "[p](https://h.example/a_(b))":'<a href="https://h.example/a_(b)">p</a>',
    "[*e* and `c](d)`](/t \"title\")":'<a href="/t"><em>e</em> and <code>c](d)</code></a>',
    "*a [b*](/c) d*":'<em>a <a href="/c">b*</a> d</em>',
    "[l](javascript:x) [m](/y)":'[l](javascript:x) <a href="/y">m</a>',
    "![i](https://h/i.png) ![x](javascript:a)":'<img src="https://h/i.png" alt="i"> x',
    "[![i](/i.png)](https://h/)":'<a href="https://h/"><img src="/i.png" alt="i"></a>',
    "a  \nb\\\nc":"a<br>\nb<br>\nc",
    r"\*not\* \[x\](y)":"*not* [x](y)",
    "~~gone~~ ~x~ ~~~no~~~":"<del>gone</del> <del>x</del> ~~~no~~~",
    "<https://h/c> see https://h.example/x_y_z. ok":'<a href="https://h/c">https://h/c</a> see <a href="https://h.example/x_y_z">https://h.example/x_y_z</a>. ok',
    "*a [b* c":"<em>a [b</em> c",
    "[*a] b*":"[<em>a] b</em>",
    "*foo**bar**baz*":"<em>foo<strong>bar</strong>baz</em>",
    "**foo*":"*<em>foo</em>",
    "a**b**c 5*6*7":"a<strong>b</strong>c 5<em>6</em>7",
    "*(**a**)*":"<em>(<strong>a</strong>)</em>",
    "**a\nb**":"<strong>a\nb</strong>",
    "[a [b](/c)](/d)":'[a <a href="/c">b</a>](/d)',
}


def rendered(spark, function, wanted):
    rows = spark.createDataFrame(list(wanted.items()), "text string, wanted string")
    return {r.text: r.html for r in rows.select("text", function(C("text")).alias("html")).collect()}


def test_render(spark):
    assert rendered(spark, blocks.render, RENDERED) == RENDERED


def test_marks(spark):
    assert rendered(spark, inline.render, MARKS) == MARKS


def test_an_expression_is_made_once_per_name(spark):
    assert once.of_name(blocks.render, "text") is once.of_name(blocks.render, "text")


def test_deep_texts_do_not_overflow(one):
    many = "- item\n" * 4000 + "\n" + "line of text\n" * 20000 + "`" + "x *y " * 200_000 + "`"
    assert one(F.length(blocks.render(C("t"))), t=many) > len(many)
    assert one(F.length(header.body(C("t"))), t=many) > 0


def test_similarity_shortcuts_are_exact():
    import random

    rng = random.Random(1)
    for _ in range(200):
        a = "".join(rng.choice("abc de") for _ in range(300))
        b = "".join(c if rng.random() < 0.8 else "z" for c in a)
        m = SequenceMatcher(None, a, b)
        assert m.ratio() <= m.quick_ratio() <= m.real_quick_ratio()


def test_references_are_those_of_the_standard(spark):
    from html import unescape

    some = ["&amp;lt; &lt;b&gt; &quot;x&#39;&nbsp;", "&copy &copyright &notin; &notit; &amp &ampx; & &; &#; &#x;", "&Aacute;&aacute&zzz;",
            "&#0; &#65 &#x41;&#X1F600; &#128; &#x9d; &#xD800; &#1114112; &#11;&#8;&#xFFFE;&#xFDD0; &#99999999999999999999;",
            "&#x00000000041; &#xFFFFFFFFFFFFF;", "&NotEqualTilde;&fjlig; &lt&gt", "plain", "", "&#13;&#10;&&amp;", "a&b=c&d"]
    some += [f"&{n}x" for n in ("AElig", "hellip;", "not", "sup1", "CounterClockwiseContourIntegral;")]
    assert rendered(spark, html.unescape, {t: unescape(t) for t in some}) == {t: unescape(t) for t in some}


def test_rules_left_out_for_want_of_tags_change_nothing(one):
    from foliant.functions import html
    from foliant.functions.text import rewrite

    pages = [
        "a <<BR/>hr> <p<br>b</P > <h2_x> </li  > <li-x>", "<a href='x'>y<b>z</a></ b> <", "<H1 a=1> t </h1><td>c</Td>",
        "<code>é</code> <bré> <hr>< br><ahref=x></a>", "none > \n\n\n\n", "<a href=x>q</a><em>i</em><TABLE>",
    ]
    for page in pages:
        assert one(html._tags(F.col("x")), x=page) == one(rewrite(F.col("x"), html.TAG_RULES), x=page)


def test_plain_tokens_are_folded_as_one(one):
    """A fold copies its state at every token; signs that are escaped make none."""
    made = inline._joined(inline._tokens(F.col("x")))
    marks = F.filter(made, lambda t: t["mark"] != "")
    text = "**" + " ".join(["a \\* b"] * 500) + "** c"
    assert one(F.size(made), x=text) <= 5 and one(F.size(marks), x=text) == 2
    assert one(inline.render(F.col("x")), x=text) == "<strong>" + " ".join(["a * b"] * 500) + "</strong> c"
    assert one(F.size(made), x="") == 1


@pytest.mark.parametrize(
    "text, html",
    [
        ("a\nb\n\n- c", "<p>a\nb</p>\n\n<ul>\n<li>c</li>\n</ul>"),
        ("***\n\n- c", "<hr>\n\n<ul>\n<li>c</li>\n</ul>"),
        ("a\n\n- c\n\n  d", "<p>a</p>\n\n<ul>\n<li><p>c</p>\n<p>d</p></li>\n</ul>"),
        ("a ``b ` c`` d", "<p>a <code>b ` c</code> d</p>"),
        ("a  \n b\\\n c", "<p>a<br>\nb<br>\nc</p>"),
    ],
)
def test_shortcuts_of_blocks_change_nothing(one, text, html):
    assert one(blocks.render(F.col("x")), x=text) == html
