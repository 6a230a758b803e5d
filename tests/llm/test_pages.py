from barlab.llm import pages

ARTICLE = (
    "<h1>A heading</h1><p>The first paragraph, which is long enough to be read as prose.\n  It goes "
    "on, and on; and ends here.</p><p>Short.<p>Tom &amp; Jerry&#39;s <b>bold<br></b>text, with some "
    "more words in it, and a <a href='/x'>link in the text</a>, too.</p>"
)
EXPECTED = (
    "A heading\nThe first paragraph, which is long enough to be read as prose. It goes on, and on; "
    "and ends here.\nShort.\nTom & Jerry's bold text, with some more words in it, and a link in the "
    "text, too."
)
AROUND = (
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News, sports, and more</a></li></ul></nav>"
    "<div class='ad'>Buy this now, it is cheap, and good. Really, really good.</div>"
)
AFTER = (
    "<aside>Other stories, many of them. Read them all, now.</aside>"
    "<div id='comments'><p>I do not agree, at all, with any of this. It is wrong.</p></div>"
    "<form><label>Name, please.</label><input></form><footer>&copy; Somebody, somewhere.</footer>"
)


def test_article_between_everything_else():
    head = "<head><title>A title</title><style>p{}</style><script>var a='<p>no</p>';</script></head>"
    for body in (
        f"<article>{ARTICLE}</article>",
        f"<div class='content'>{ARTICLE}</div>",
        f"<main><div><section>{ARTICLE}</section></div></main>",
    ):
        page = f"<!DOCTYPE html><html>{head}<body><header>Site, name.</header>{AROUND}{body}{AFTER}"
        assert pages.main_text(page) == EXPECTED
        assert pages.main_text(page + "</body></html>") == EXPECTED


def test_parts_inside_the_article_go():
    inner = ARTICLE.replace("<p>Short.", "<!-- no --><div class='share-buttons social'>Share it.</div>"
                            "<script>x</script><p>Short.")
    assert pages.main_text(f"<body><article>{inner}{AFTER}</article></body>") == EXPECTED


def test_odd_pages():
    for page in (None, "", " ", "<", "<p", "<html></html>", "<!-- open", "<script>never closed",
                 "<nav>only a menu</nav>", "<<<>>>", "</p></p>", "<a href='", "<p class=\"x>y"):
        assert isinstance(pages.main_text(page), str)
    assert pages.main_text("just text, no tags at all.") == "just text, no tags at all."
    assert pages.main_text("<p>a &lt;b&gt; 1 < 2, and so on.</p>") == "a <b> 1 < 2, and so on."
    long = "<article>" + "<p>Some words, and some more.</p>" * 20_000 + "</article>"
    assert pages.main_text(long).count("\n") == 19_999
    deep = "<div>" * 3_000 + "<p>Some words, and some more.</p>"
    assert pages.main_text(deep) == "Some words, and some more."


def test_table_of_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = pages.extract(table).collect()
    assert len(found) == table.count()
    html = {r.page_id: r.html for r in table.collect()}
    for r in found:
        assert r.n_chars == len(r.text) and "\n\n" not in r.text
        article = html[r.page_id].split("<article>")[1].split("</article>")[0]
        assert r.text == plain(article)


def plain(article):
    """The text of the test pages' articles, whose only tags are h1, p, b and br."""
    import re
    from html import unescape

    blocks = re.split(r"</?(?:h1|p)>", article)
    lines = (" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>Some words, here.</p>", "y"), (1, "u", "", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(((r.page_id, r.text, r.n_chars) for r in pages.extract(df).collect()), key=str)
    assert found == sorted([(1, "", 0), (None, "Some words, here.", 17), (1, "", 0)], key=str)
    assert pages.extract(df.limit(0)).collect() == []


def prose(n, name):
    return " ".join(f"This is sentence {i} of the {name}, and it goes on." for i in range(n))


def test_split_articles_are_whole():
    lead, body = prose(2, "lead"), prose(20, "body")
    for page, expected in (
        (f"<article><h1>Title</h1><div class=lead>{lead}</div><div class=body>{body}</div></article>",
         ["Title", lead, body]),
        (f"<article><h1>Title</h1><div class=body><p>{body}</p></div></article>", ["Title", body]),
        (f"<div class=text><h1>Title</h1><div><p>{lead}</p></div><p>Short.</p><div><p>{body}</p></div></div>",
         ["Title", lead, "Short.", body]),
        *((f"<div><p>Intro, short.</p><{o}>{body}</{c}></div>", ["Intro, short.", body]) for o, c in (
            ("ul><li", "li></ul"), ("blockquote", "blockquote"), ("pre", "pre"),
            ("table><tr><td", "td></tr></table"))),
    ):
        assert pages.main_text(f"<body>{AROUND}{page}{AFTER}</body>") == "\n".join(expected)


def test_menus_without_a_name_around_split_articles_go():
    menu = "<div><a href='/a'>Home</a></div><div><a href='/b'>News of today</a></div>"
    lead, body = prose(2, "lead"), prose(20, "body")
    page = f"<body>{menu}<div><p>{lead}</p></div><div><p>{body}</p></div>{menu}</body>"
    assert pages.main_text(page) == f"{lead}\n{body}"


def test_wrappers_named_after_their_layout_are_kept():
    for name in ("content has-sidebar", "no-sidebar", "with-comments", "nav-fixed", "hasWidgets",
                 "page comments-open", "sidebar-right"):
        for page in (f"<div class='{name}'>{AROUND}<article>{ARTICLE}</article>{AFTER}</div>",
                     f"<main><div id='{name}'>{AROUND}<div>{ARTICLE}</div></div></main>{AFTER}",
                     f"<div class='{name}'>{AROUND}<main><div>{ARTICLE}</div></main>{AFTER}</div>"):
            if name == "page comments-open" and page.startswith("<main>"):
                continue
            assert pages.main_text(f"<body>{page}</body>") == EXPECTED, (name, page)


def test_long_comments_and_adverts_go():
    said = f"<div id='comments'><article><p>{prose(40, 'reply')}</p></article></div>"
    for page in (f"<article>{ARTICLE}</article>{said}", f"<article>{ARTICLE}{said}</article>",
                 f"<div class=text>{ARTICLE}</div><div id='comments'><p>{prose(40, 'reply')}</p></div>",
                 f"<main>{ARTICLE}</main><div class='promo'><p>{prose(40, 'advert')}</p></div>"):
        assert pages.main_text(f"<body>{page}</body>") == EXPECTED, page


def test_long_attribute_values_are_no_text():
    value = '{"a":">>","hidden":true,"t":"class=nav"}' * 5_000
    for page in (f"<div data-props='{value}'><article>{ARTICLE}</article></div>",
                 f"<article data-props='{value}'>{ARTICLE}</article>",
                 f"<article>{ARTICLE}<img alt='{value}'></article>"):
        assert pages.main_text(f"<body>{page}</body>") == EXPECTED
    for start in ("<a ", "<a x=\"", "<a x='", "<a x=\"<a y='", "<a x=y ", "<a x=\"'\" "):
        pages.main_text(start * 200_000)


def test_open_head_and_wrapping_elements():
    for page in (
        f"<html><head><title>x</title><body><article>{ARTICLE}</article>",
        f"<html><head><title>x</title><meta charset=utf-8><article>{ARTICLE}</article>",
        f"<html><head><title>x</title><div><p>{ARTICLE}</div></html>",
        f"<html><head><style>p{{}}</style></head><body><article>{ARTICLE}</article></body></html>",
        f"<body><form id=aspnetForm>{AROUND}<div>{ARTICLE}</div>{AFTER}</form></body>",
        f"<body><form>{AROUND}<article>{ARTICLE}</article>{AFTER}</form></body>",
        *(f"<body>{AROUND}<{tag}>x<article>{ARTICLE}</article></body>"
          for tag in ("button", "select", "menu", "dialog", "nav", "aside", "footer", "svg", "map")),
        *(f"<body><div><{tag}></div><div>{ARTICLE}</div></body>" for tag in ("button", "object", "form")),
        f"<body><aside><main>{ARTICLE}</main></aside></body>",
    ):
        found = pages.main_text(page)
        assert found == EXPECTED or found == "x\n" + EXPECTED, page
    bare = "<head><title>x</title>Just a text, and no body at all. It goes on."
    assert pages.main_text(bare) == "Just a text, and no body at all. It goes on."
    for page in ("<body><nav>only, a menu.</nav></body>", "<body><footer>By us, to you.</footer></body>"):
        assert pages.main_text(page) == ""


def test_ratios_tell_notices_without_a_name():
    """No element has a telling name or tag: only the ratios of the paths decide."""
    body = "".join(f"<p>{prose(3, f'part {i}')}</p>" for i in range(6))
    expected = "\n".join(prose(3, f"part {i}") for i in range(6))
    notice = "<div>We use cookies, to improve. Accept them, please.</div>"
    rights = "<div>&copy; 2020 Somebody, somewhere.</div>"
    for text, shown in (
        (f"<div>{body}</div>", expected),
        (f"<div><div>{body}</div></div>", expected),
        (f"<h1>Title</h1><div>{body}</div>", "Title\n" + expected),
        (body, expected),
        (body + "<ul><li>One.<li>Two.</ul>", expected + "\nOne.\nTwo."),
        (f"<div>{body}</div><div>{body}</div>", expected + "\n" + expected),
    ):
        assert pages.main_text(f"<body>{notice}{text}{rights}</body>") == shown, text


def test_memory_of_deep_pages():
    """Paths are numbers, so a page's memory grows with its length, not with its square."""
    import tracemalloc

    sizes = []
    for depth in (2_000, 20_000):
        page = "<div class=some-long-name>" * depth + "<p>Some words, and some more.</p>"
        tracemalloc.start()
        assert pages.main_text(page) == "Some words, and some more."
        sizes.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert sizes[1] < 15 * sizes[0] and sizes[1] < 40e6
