"""Main text extraction: planted pages and odd markup."""

from __future__ import annotations

import random
import re
import time

from tidewater.llm.html_text import INLINE, SCOPE, Page, extract, main_text

LONG = "This is a paragraph with commas, and with enough words, to count as running text in any page."


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style></head><body>{body}</body></html>"


def test_furniture_goes_and_the_article_stays():
    got = main_text(page(
        "<header>Site name</header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>"
        "<div class='cookie-notice'><p>We use cookies, lots of them, to follow you around the whole site.</p></div>"
        "<div id=main-wrap><div class=post><h1>Head</h1>"
        f"<p>{LONG}<p>Second: {LONG}<script>var x = '<p>no</p>';</script><form><p>Subscribe, please, to our very long letter of news.</p></form></div>"
        f"<div id='comments'><div class=comment><p>{LONG} A reader.</p></div></div></div>"
        f"<aside><p>{LONG} Aside.</p></aside><div class='ad banner'><p>{LONG} Buy.</p></div><footer>&copy; 2020</footer>"
    ))
    assert got == f"Head {LONG} Second: {LONG}"


def test_references_white_space_blocks_and_inline_markup():
    assert main_text(page(f"<article><p>{LONG} a&amp;b&nbsp;c\n\n d<br>e <b>f</b>g&#233;</p>\t<p>End.</article>")) == f"{LONG} a&b c d e fgé End."


def test_broken_markup():
    assert main_text(f"<article><p><b>{LONG}<br><p>Two.</p></article>") == f"{LONG} Two."
    assert main_text(f"<div><p>{LONG}</span></b></p><p>Two <i>more</p><p>Three<!-- never ends <p>x") == f"{LONG} Two more Three"
    assert main_text(f"<p>{LONG}<script>if (a < b) document.write('<p>')") == LONG
    assert main_text("a < b and c > d") == "a < b and c > d"


def test_sections_beside_the_best_are_kept():
    body = "".join(f"<section><h2>S{i}</h2><p>{LONG}</p><p>{LONG}</p></section>" for i in range(3))
    got = main_text(page(f"<div>{body}</div><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>"))
    assert got == " ".join(f"S{i} {LONG} {LONG}" for i in range(3))


def test_short_empty_and_very_deep_pages():
    assert main_text(None) == "" and main_text("") == "" and main_text(page("")) == ""
    assert main_text(page("<article><h1>Hi</h1><p>Short.</p></article>")) == "Hi Short."
    deep = "<div>" * 20_000 + f"<p>{LONG}</p>" + "</div>" * 20_000
    assert main_text(deep) == LONG
    assert main_text("<p>" + "word, " * 200_000 + "</p>") == ("word, " * 200_000).strip()


def test_extract_keeps_rows_and_replaces_clashing_columns(spark):
    rows = [(1, "u", page(f"<article><p>{LONG}</article>"), "old"), (1, "u", page(f"<article><p>{LONG}</article>"), "old"), (None, None, None, None)]
    got = extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), (LONG, len(LONG)), (LONG, len(LONG))]
    empty = extract(spark.createDataFrame([], "page_id bigint, html string"), keep=["page_id"])
    assert empty.columns == ["page_id", "text", "n_chars"] and empty.count() == 0


def test_text_beside_the_best_container_is_kept():
    six = "".join(f"<p>{i} {LONG}</p>" for i in range(6))
    whole = " ".join(f"{i} {LONG}" for i in range(6))
    links = "<h3>More</h3><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>"
    got = main_text(page(f"<div><h1>Head</h1><p>Lead: {LONG}</p><div>{six}</div><p>End.</p>{links}</div>"))
    assert got == f"Head Lead: {LONG} {whole} End."
    # A short section beside a long one, and text above a wrapper.
    got = main_text(page(f"<div><section><h2>S1</h2>{six}</section><section><h2>S2</h2><p>{LONG}</p></section></div>"))
    assert got == f"S1 {whole} S2 {LONG}"
    got = main_text(page(f"<h1>Head</h1><p>Lead: {LONG}</p><div><div>{six}</div></div><div><a href=1>{LONG}</a></div>"))
    assert got == f"Head Lead: {LONG} {whole}"
    got = main_text(page(f"<div>Loose <b>lead</b>, without any element of its own.<div>{six}</div></div>"))
    assert got == f"Loose lead, without any element of its own. {whole}"


def test_a_furniture_word_wins_over_a_content_word():
    for name in ("page-header", "main-menu", "post-share", "content-sidebar", "article-footer", "page-nav"):
        for where in (f"class={name}", f"id='{name}'"):
            assert main_text(page(f"<div class=post><p>{LONG}</p><div {where}><p>{LONG} Not this.</p></div><p>{LONG}</p></div>")) == f"{LONG} {LONG}"
    for name in ("with-sidebar", "has-menu", "no-sidebar post", "layout-sidebar", "post category-social"):
        assert main_text(page(f"<div class='{name}'><p>{LONG}</p></div>")) == LONG


def test_link_lists_of_an_article_go_only_if_marked():
    links = "".join(f"<li><a href={i}>Source {i}</a>" for i in range(4))
    rows = "".join(f"<tr><td><a href={i}>Row {i}</a>" for i in range(4))
    got = main_text(page(f"<article><p>{LONG}</p><ul>{links}</ul><table>{rows}</table><ul class=page-nav>{links}</ul><nav>{links}</nav></article>"))
    assert got == " ".join([LONG, *(f"Source {i}" for i in range(4)), *(f"Row {i}" for i in range(4))])
    assert main_text(page(f"<main><p>{LONG}</p><div><ol>{links}</ol></div></main>")).endswith("Source 3")


BLOCK = "<p>" + "This is a long sentence of the article, with commas, and more words. " * 4 + "</p>"


def test_running_text_beside_an_article_in_main_stays():
    lead, end = "A lead paragraph that tells what it is about.", "A closing paragraph that sums it up in a few words."
    text = main_text(f"<main><p>{lead}</p><article>{BLOCK * 4}</article><p>{end}</p></main><footer>imprint</footer>")
    assert text.startswith(lead) and text.endswith(end)
    second = "A second short article in the main element here."
    assert main_text(f"<main><article>{BLOCK * 6}</article><article><p>{second}</p></article></main>").endswith(second)
    notice = "We use cookies on this site, please accept all of them now."
    assert "cookies" not in main_text(f"<body><div>{notice}</div><article>{BLOCK * 3}</article><p>{notice}</p></body>")


def test_furniture_words_in_names_of_subjects():
    subjects = "".join(f"<section class='{c}'><p>The part on {c} is one of the article and stays in it.</p></section>" for c in ("market-share", "social-history", "related-work"))
    parts = "".join(f"<div class='{c}'><p>The block of {c} is no part of the article and goes away.</p></div>" for c in ("social-share", "related-posts", "share-buttons", "copyright", "post-share"))
    text = main_text(f"<article>{BLOCK}{subjects}{parts}</article>")
    assert text.count("stays in it") == 3 and "goes away" not in text


def test_work_is_linear_in_stray_and_nested_tags():
    def seconds(source):
        start = time.process_time()
        main_text(source)
        return time.process_time() - start

    for make in (lambda n: "<div>" * n + "</section>" * n, lambda n: "<i><div>" + "<b>" * n + "</i>" * n, lambda n: "<p>" + "<b>" * n + "<li>" * n):
        small, large = seconds(make(4000)), seconds(make(32000))
        assert large < 0.5 or large < 24 * small


def test_a_plain_parser_sees_the_same_elements():
    """Against a stack searched from its top: ends that are there, stray ends,
    inline ends that a block keeps apart."""
    draw = random.Random(4)
    for _ in range(300):
        tags = [draw.choice(["div", "p", "b", "i", "section", "span", "em"]) for _ in range(40)]
        source = "".join(f"</{t}>" if draw.random() < 0.45 else f"<{t}>" for t in tags) + "x"
        page, stack, parents = Page(source), [(0, "#page")], [0]
        for name in re.findall(r"</?\w+>", source):
            tag = name.strip("</>")
            if name[1] != "/":
                if tag not in INLINE:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][1] == "p":
                            del stack[depth:]
                            break
                        if stack[depth][1] in SCOPE:
                            break
                parents.append(stack[-1][0])
                stack.append((len(parents) - 1, tag))
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][1] == tag:
                    del stack[depth:]
                    break
                if tag in INLINE and stack[depth][1] not in INLINE:
                    break
        assert page.parent == parents and page.runs[-1] == (stack[-1][0], "x")


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>Hello there, reader of this page.</p>", "a", "b", {"k": 1})], "page_id int, html string, source string, _html string, extra map<string,int>")
    got = extract(pages)
    assert got.columns == ["page_id", "html", "source", "_html", "extra", "text", "n_chars"]
    assert got.first()["text"] == "Hello there, reader of this page." and got.first()["_html"] == "b"
