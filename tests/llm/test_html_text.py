import pytest

from insight.llm.html_text import Page, densities, extract, main_text

ARTICLE = "<article><h1>Title</h1><p>First &amp; best<br>line.</p><p>Second <b>bold</b> one.</p></article>"


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("<p", ""), ("<", ""), ("text only", "text only"), ("<article></article>", ""), ("&am", "&am"),
    (f"<body><nav><a>Home</a></nav><div class=ad>Buy this very long and wordy thing, it is good for you, really</div>{ARTICLE}"
     "<footer>&copy; x</footer></body>", "Title\n\nFirst & best line.\n\nSecond bold one."),
    ("<article><p>a &lt;b&gt; c&nbsp;d<p>e<script>x", "a <b> c d\n\ne"),
    ("<p>a<div>b</div>c", "a\n\nb\n\nc"),
    ("<article><p><b>T<br><p>next</article>", "T\n\nnext"),
    ("<main><article><header><h1>T</h1></header><p>x<table><tr><td>1<td>2</table></article><article class=comment>bad</article></main>",
     "T\n\nx\n\n1\n\n2"),
    ("<article><p>one</p><form>q<input></form><aside>side</aside><div class='comments'><p>nice</p></div>"
     "<div id='cookie-notice'>ok?</div><!-- c --><style>p{}</style><script>var t='</p>'</script><p>two</p><p>cut o", "one\n\ntwo\n\ncut o"),
    ("<article><ul><li>a<li>b <a href=x>c</a></ul></article>", "a\n\nb c"),
    ("<article>" + "<div>" * 5000 + "deep", "deep"),
    ("<article><b>x<p>y</b> z</p></article>", "x\n\ny z"),
    ("<article><p>a\n\t b&#32;&#x41;&eacute;</p></article>", "a b Aé"),
])
def test_main_text(html, want):
    assert main_text(html) == want


def test_density_finds_the_text_without_article():
    page = ("<html><body><div id=header><a href=/>Home</a></div><div class=menu><a>a</a><a>b</a></div><div id=c>"
            "<p>This is a long paragraph of main text with many words in it, certainly.</p>"
            "<p>Another para, with <a href=x>link</a> inside and text.</p><div class='cookie-notice'>We use cookies</div>"
            "<div class=comments><p>Nice read, thanks a lot for this</p></div></div>"
            "<div class=foot><a>imprint</a> <a>about</a></div></body></html>")
    assert main_text(page) == ("This is a long paragraph of main text with many words in it, certainly.\n\n"
                               "Another para, with link inside and text.")
    p = Page(page)
    density, total, _ = densities(p)
    best = max(range(len(total)), key=lambda i: total[i])
    assert p.tag[best] == "div" and density[best] > 0


def _paragraphs(name, n, size):
    return [(f"{name} paragraph {k} " + "of the long main text " * size)[:size].strip() + "." for k in range(n)]


@pytest.mark.parametrize("tag", ["section", "div"])
@pytest.mark.parametrize("sizes", [(400, 400), (400, 400, 400), (400, 250, 90)])
def test_text_split_over_siblings(tag, sizes):
    """All parts and the title, nothing of the lists of links around and between."""
    split = [_paragraphs(name, 5, size) for name, size in zip("ABC", sizes)]
    links = "<ul><li><a href=x>Some other page</a><li><a href=y>One more page</a></ul>"
    inner = links.join(f"<{tag}>" + "".join(f"<p>{p}</p>" for p in part) + f"</{tag}>" for part in split)
    for around in ("<div id=c><h1>Title</h1>{}</div>", "<div><div id=c><h1>Title</h1>{}</div></div><div>Imprint, 2020</div>"):
        page = f"<html><body>{links}{around.format(inner)}{links}</body></html>"
        assert main_text(page).split("\n\n") == ["Title", *(p for part in split for p in part)]


TEASER = "<article class=card><h3>Teaser</h3><p>Read this other story, it is good.</p></article>"


@pytest.mark.parametrize("around", [
    "<div id=content>{}</div>" + TEASER * 3, TEASER + "<div id=content>{}</div>", "<div><div id=content>{}</div><div>" + TEASER * 4 + "</div></div>",
    "{}" + TEASER, "<div id=c><section>{}</section></div><main></main>" + TEASER,
    "<article>{}</article>" + TEASER, "<div><main>{}</main></div>" + TEASER * 2])
def test_text_beside_teaser_articles(around):
    """The sums of the whole page choose; an article only widens what they chose."""
    text = _paragraphs("A", 4, 300)
    page = "<html><body>" + around.format("".join(f"<p>{p}</p>" for p in text)) + "</body></html>"
    assert main_text(page).split("\n\n") == text


def test_split_text_beside_teaser_articles():
    split = [_paragraphs(name, 5, 300) for name in "ABC"]
    inner = "".join("<section>" + "".join(f"<p>{p}</p>" for p in part) + "</section>" for part in split)
    assert main_text(f"<body>{inner}{TEASER * 2}</body>").split("\n\n") == [p for part in split for p in part]


@pytest.mark.parametrize("around", [
    "<div class='page has-sidebar'>{}</div>", "<div class=no-sidebar><article>{}</article></div>", "<form action=x>{}</form>",
    "<form><div class=sidebar><a href=x>Home</a></div><article>{}</article><div class=comments><p>Nice</div></form>",
    "<div class=widget>{}</div><footer>Imprint 2020</footer>", "<div class='comments-open'><div>{}</div></div>",
    "<section role=search class=modal><main>{}</main></section>"])
def test_names_do_not_empty_a_page(around):
    text = _paragraphs("A", 4, 200)
    assert main_text("<html><body>" + around.format("".join(f"<p>{p}</p>" for p in text)) + "</body></html>").split("\n\n") == text


def test_little_text_beside_a_long_footer():
    rest = "<div class=ad>Buy this, it is long and good for you, really</div><footer>All rights reserved, imprint, contact, and much more</footer>"
    assert main_text(f"<body><article><h1>T</h1></article>{rest}</body>") == "T"
    assert main_text(f"<body>{rest}</body>") == ""


def test_names_of_parts_are_matched_whole():
    page = ("<article><p>One.</p><section id='social-impact'><h2 id='related-work'>Work</h2><p>Two.</p></section><div class='comments-open'>Three."
            "</div><div class='share-buttons x'>no</div><div id=main-nav>no</div><div class='related-posts'>no</div><div class=ad-300x250>no</div>"
            "<form>no</form><div class='comment-list'>" + "<p>much longer talk than the text</p>" * 20 + "</div></article>")
    assert main_text(page).split("\n\n") == ["One.", "Work", "Two.", "Three."]


@pytest.mark.parametrize("name", [
    "reader-comments", "disqus_thread", "comment-thread", "commentlist", "comment-respond", "user-comments", "discussion", "replies",
    "gdpr-banner", "adsbygoogle", "newsletter-form", "related-articles"])
@pytest.mark.parametrize("key", ["class", "id"])
def test_boxes_inside_an_article_go(name, key):
    text = _paragraphs("A", 2, 300)
    box = f"<div {key}='{name}'><p>What a read, thank you so much for it.</p><ul><li>More of it</ul></div>"
    page = "<body><article><h1>T</h1>" + box.join(f"<p>{p}</p>" for p in text) + box + "</article></body>"
    assert main_text(page).split("\n\n") == ["T", *text]


@pytest.mark.parametrize("around", ["<div class=has-sidebar>{}</div>", "<section id=social-impact>{}</section>", "<section id=discussion>{}</section>",
                                    "<form>{}</form>", "<div class='elementor-widget'>{}</div>", "<div class=page-with-comments>{}</div>"])
def test_names_that_only_sound_alike_stay(around):
    text = _paragraphs("A", 3, 300)
    page = "<body><article><p>" + text[0] + "</p>" + around.format("".join(f"<p>{p}</p>" for p in text[1:])) + "</article></body>"
    assert main_text(page).split("\n\n") == text


@pytest.mark.parametrize("unit", ["<i>x", "<b><div>x</b>", "<p><i>x", "<a>x<p>", "<table><td>x", "<div>x", "</i><i>x<div></div>", "<li>x<b>", "<x><p>a</x>"])
def test_100_000_open_tags_take_linear_time(unit):
    import time
    took = []
    for n in (25_000, 100_000):
        t0 = time.time()
        main_text("<body>" + unit * n)
        took.append(time.time() - t0)
    assert took[1] < 9 * max(took[0], .2), took


def test_pages_of_the_table(spark):
    """Every block between the article's tags, nothing of what stands around."""
    import html as entities
    import re
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        inner = re.sub(r"<[a-zA-Z/!][^>]*$", "", inner).replace("<br>", " ")
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|article)>", inner)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_odd_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>a", "y"), (1, None, None, "x")], "page_id int, url string, html string, text string")
    assert sorted((str(r.page_id), r.text) for r in extract(df).collect()) == [("1", ""), ("1", ""), ("None", "a")]
    assert extract(df.limit(0)).collect() == []
