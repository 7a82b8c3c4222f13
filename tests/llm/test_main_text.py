from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest

from rowtide.llm.main_text import extract_text, main_text

LONG = "A paragraph that is long enough, with commas, to be taken for the text of an article."
MORE = "Another one, which is about as long as the first one, and which has some commas, too."

CASES = {
    "": "",
    "   ": "",
    "just text": "just text",
    f"<article><h1>T</h1><p>{LONG}<p>{MORE}</article><footer>&copy; x</footer>": f"T {LONG} {MORE}",
    f"<nav><a href=x>menu</a></nav><div class='ad'>buy</div><div><p>{LONG}</p><p>ok.</p></div>": f"{LONG} ok.",
    f"<main><p>{LONG}</p><form><input>name</form><div id='cookie-notice'><p>{MORE}</p></div></main>": LONG,
    f"<article><p>{LONG}</p><section class='comments'><p>{MORE}</p><p>{MORE}</p><p>{MORE}</p></section></article>": LONG,
    f"<article><p>{LONG}</p><div class='postComments'><article class='comment'><p>{MORE}</p></article></div></article>": LONG,
    f"<body class='has-sidebar'><div class='sidebar'>{MORE}</div><div class='entry'><p>{LONG}</p><p>{MORE}</p></div></body>": f"{LONG} {MORE}",
    f"<p>{LONG} a &amp; b&nbsp;c &#65; &unknown; &lt;p&gt;</p>": f"{LONG} a & b c A &unknown; <p>",
    f"<script>var a='</p><p>{MORE}';</script><style>p{{}}</style><!-- {MORE} --><p>{LONG}</p>": LONG,
    f"<p>{LONG} bo<b>l</b>d <i>x</i><br>next</p>": f"{LONG} bold x next",
    f"<p title='a > b'>{LONG}</p><p>1 < 2</p>": f"{LONG} 1 < 2",
    f"<p>{LONG}</p><p>cut <a href='x": f"{LONG} cut",
    f"<p hidden>{MORE}</p><p style='display: none'>{MORE}</p><p>{LONG}</p>": LONG,
    f"<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul><div><p>{LONG}</p><ul><li>first item<li>second item</ul></div>": f"{LONG} first item second item",
    f"<table><tr><td>{LONG}<td>cell<tr><td>below</table>": f"{LONG} cell below",
    f"<ARTICLE><P>{LONG}</P></ARTICLE><ASIDE><P>{MORE}</P></ASIDE>": LONG,
    f"<article><p>{LONG}</p><section><p>{MORE}</p></section><p>end</p></article>": f"{LONG} {MORE} end",
    f"<body><h1>T</h1><p>Short lead.</p><div>{f'<p>{LONG}</p>' * 5}</div></body>": f"T Short lead. {' '.join([LONG] * 5)}",
    f"<body><nav><a href=1>x</a></nav><section><h2>One</h2><p>{LONG}</p><p>{MORE}</p></section><section><h2>Two</h2><p>short.</p></section><footer>f</footer></body>": f"One {LONG} {MORE} Two short.",
    f"<div><section><p>{LONG}</p><p>{LONG}</p></section><section><p>{MORE}</p><p>{MORE}</p></section></div>": f"{LONG} {LONG} {MORE} {MORE}",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert main_text(page) == CASES[page]


def test_broken_and_deep():
    for page in ("<", "</", "<a", "<!--", "<!-->x", "<p" * 5000, "</p>" * 5000, "<div>" * 20_000 + LONG, "<b>" * 3000 + LONG + "</i>" * 3000, "<p a=\"" * 3000):
        assert isinstance(main_text(page), str)
    assert main_text("<div>" * 20_000 + LONG) == LONG


def test_over_a_table(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (2, None, None), (None, "u", ""), (1, "u", f"<article><p>{LONG}</p></article>"), (3, "u", f"<p>{'word, ' * 60_000}</p>"), (4, "u", "<p>ünï 🙂 and a few more words</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = extract_text(pages).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert sorted(r.text for r in got)[:2] == ["", ""]
    assert extract_text(pages.limit(0)).collect() == []


def test_time_is_linear_in_quotes():
    import time

    page = lambda n: "<article>" + f"<p class='a' title=\"b\">{LONG}</p>" * n + "</article>"
    begin = time.process_time()
    assert len(main_text(page(20_000))) > 1_500_000
    assert time.process_time() - begin < 8


class _Slow(HTMLParser):
    """An extractor of another kind for well-formed pages: the text of `article` without what HTML says is none of it."""

    OUT = {"nav", "header", "footer", "aside", "form", "script", "style", "noscript", "button", "template"}
    INLINE = {"a", "b", "i", "em", "strong", "span", "code", "small", "sub", "sup", "u", "q", "mark", "abbr", "time", "cite"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.article, self.out, self.parts = 0, 0, []

    def handle_starttag(self, tag, attrs):
        self.article += tag == "article"
        self.out += tag in self.OUT
        self.parts.append("" if tag in self.INLINE else " ")

    def handle_endtag(self, tag):
        self.article -= tag == "article"
        self.out -= tag in self.OUT
        self.parts.append("" if tag in self.INLINE else " ")

    def handle_data(self, data):
        if self.article and not self.out:
            self.parts.append(data)


def test_against_another_extractor():
    """Random well-formed articles, with chrome around and inside them."""
    draw = random.Random(3)
    sentence = lambda: " ".join(draw.choice(["word", "and", "more, then", "<b>bo</b>ld", "<a href='x'>link</a>", "a &amp; b", "caf&eacute;", "\n next"]) for _ in range(draw.randrange(8, 30))) + "."
    block = lambda: draw.choice(["<p>{}</p>", "<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li><li>x</li></ul>", "<section><p>{}</p></section>", "<pre>{}</pre>"]).format(sentence())
    chrome = ["<nav><a href='/'>home</a></nav>", "<aside><p>buy, now, this, thing, here, it is good</p></aside>", "<script>var x = '<p>';</script>", "<form><p>name, please, here</p></form>", ""]
    for _ in range(200):
        inside = "".join(block() + draw.choice(chrome) for _ in range(draw.randrange(2, 12)))
        page = f"<html><head><title>t</title></head><body><header><p>{sentence()}</p></header>{draw.choice(chrome)}<article>{inside}</article><footer><p>{sentence()}</p></footer></body></html>"
        slow = _Slow()
        slow.feed(page)
        assert main_text(page) == " ".join("".join(slow.parts).split())
