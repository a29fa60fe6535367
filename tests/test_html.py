"""The page reader by hand, and against the standard library's parser on random pages."""

import random
from html.parser import HTMLParser

import pytest

from runtrail import fixed_values as fixed
from runtrail.functions import html


@pytest.mark.parametrize("page, found", [
    ("<pre title='a>b'>z</pre>", "z"),
    ('<pre title="</pre>">z</pre>', "z"),
    ("<pre a=b'c>x</pre>y'", "x"),
    ("<pre>&#65;&#x42;&#X43;&lt;&amp;lt;&copy;&copy x&unknown;&</pre>", "ABC<&lt;©© x&unknown;&"),
    ("<pre>&#128;&#0;&#xD800;&#1114112;&#99999999999999999999;&#128512;</pre>", "€����😀"),
    ("<pre>out <pre>in</pre> rest</pre> after", "in"),
    ("<pre>a</pre><PRE class=x>b<b>c</b> 1 < 2 > 0<br>d</PRE >", "bc 1 < 2 > 0d"),
    ("<div><pre>kept</div> after</pre>", "kept"),
    ("<div><pre>kept</p> more</pre>", "kept more"),
    ("<div><pre>a<i>b</i></i>c</div>", "abc"),
    ("<pre>a<div>b</pre>c</div>", "ab"),
    ("<pre>a<!-- </pre> <pre>x -->b</pre>", "ab"),
    ("<pre>a<script>if (a<b) '</pre>'</script>b", "ab"),
    ("<script><pre>x</pre></script>", None),
    ("<a title='<pre>'>x</a>", None),
    ("<prefix>x</prefix>", None),
    ("<pre/>x", ""),
    ("<pre>a</pre><pre/>x", ""),
    ("<pre>open to the end", "open to the end"),
    ("<pre>a<br/>b<img src='>'>c<!DOCTYPE x>d<?php y?>e</pre>", "abcde"),
    ("<pre></pre>", ""),
    ("<pre>a</pre><PRE class='o'>b &lt;1&gt; &amp;lt; &#39;</PRE >", "b <1> &lt; '"),
    ("<preface>q</preface>", None),
    ("<html>wait</html>", None),
    ("<pre>first</pre> <!-- <pre>no</pre> -->", "first"),
    ("<!-- <pre>no</pre> -->", None),
    ("<script>x = '<pre>no</pre>'</script><pre>yes</pre>", "yes"),
    ("<pre>first</pre><style>/*<pre>no</pre>*/</style>", "first"),
    ("<pre>open\nto the end", "open\nto the end"),
    ("<pre>outer<pre>inner</pre></pre>", "inner"),
    ("<pre>a<b>c</b>&lt;d&gt;</pre>", "ac<d>"),
    ("<pre></pre>", ""),
    ("<pre>x < 5\nERROR lost line\ny > 3\nend</pre>", "x < 5\nERROR lost line\ny > 3\nend"),
    ("<pre>a<!DOCTYPE b>c<?php d?>e</ f>&nbsp;&apos;</pre>", "ace</ f>\xa0'"),
    ("no page", None),
    ("", None),
    (None, None),
])
def test_last_pre(apply, page, found):
    assert apply(html.last_pre, [page]) == [found]
    assert apply(html.has_pre, [page]) == [None if page is None else found is not None]


class Reader(HTMLParser):
    """Text of the last block to open, by a stack of elements."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.stack, self.depth, self.text = [], 0, None

    def handle_starttag(self, name, attrs):
        if name in fixed.VOID_ELEMENTS:
            return
        self.stack.append(name)
        if name == "pre":
            self.depth, self.text = len(self.stack), []

    def handle_startendtag(self, name, attrs):
        if name == "pre":
            self.depth, self.text = 0, []

    def handle_endtag(self, name):
        if name in self.stack:
            while self.stack.pop() != name:
                pass
            if self.depth > len(self.stack):
                self.depth = 0

    def handle_data(self, data):
        if self.depth and self.stack[-1] not in fixed.RAW_ELEMENTS:
            self.text.append(data)

    def handle_entityref(self, name):
        self.handle_data({"lt": "<", "amp": "&", "eacute": "é"}[name])

    def handle_charref(self, name):
        self.handle_data(chr(int(name[1:], 16) if name[0] in "xX" else int(name)))


def test_random_pages(apply):
    parts = [
        "<pre>", "<pre class='a>b'>", '<PRE id="<pre>" >', "</pre>", "</PRE\n>", "<div>", "</div>", "<p>", "</p>", "<b>", "</b>", "<br>",
        "<br/>", "<pre/>", "<i/>", "<!-- <pre> -->", "<script>x<pre></script>", "<style>p{}</style>", "text ", "1 < 2", " > ", "&lt;", "&#65;",
        "&#x42;", "&amp;", "&eacute;", "\n", "<hr>", "</i>", "<a href=x'y>",
    ]
    rng = random.Random(9)
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) + " " for _ in range(1500)]
    expected = []
    for page in pages:
        reader = Reader()
        reader.feed(page)
        reader.close()
        expected.append(None if reader.text is None else "".join(reader.text))
    assert apply(html.last_pre, pages) == expected
    assert apply(html.has_pre, pages) == [e is not None for e in expected]


def test_long_pages_take_time_in_proportion(apply):
    tag = "<a " + " ".join(f"k{i}='v>{i}'" for i in range(3000)) + ">"
    page = f"<pre>{tag}x</a>" + "<i>line</i> &#65; 1 < 2\n" * 20000 + "</pre>"
    assert apply(html.last_pre, [page]) == ["x" + "line A 1 < 2\n" * 20000]
