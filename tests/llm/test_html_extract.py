from __future__ import annotations

import re
from html import unescape

from lodgepole.llm import html_extract as hx

SF = "/root/testdata/sf0.01"


def page(title, body, nav="Home|News", footer="© host", ad="Buy this", wrap=("<article>", "</article>"), extra=""):
    links = "".join(f"<li><a href='/{x}'>{x}</a></li>" for x in nav.split("|"))
    return (
        f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{title}</title><style>p{{x:'</p>'}}</style><script>var t='</p><p>no';</script></head>"
        f"<body><nav><ul>{links}</ul></nav><!-- <p>ad</p> --><div class=\"ad\">{ad}</div>{wrap[0]}<h1>{title}</h1>{body}{wrap[1]}{extra}<footer>{footer}</footer></body></html>"
    )


def test_blocks_and_white_space():
    got = hx.extract(page("A &amp; B", "<p><b>One\n  two.<br>three<p>Fo&uuml;r&nbsp;&#x1F600; <i>f</i>ive</p><ul><li>x<li>y</ul><pre>a  b</pre>tail"))
    assert got == "A & B\n\nOne two. three\n\nFoür 😀 five\n\nx\n\ny\n\na b\n\ntail"


def test_named_parts_go():
    parts = "".join(f"<div {a}>gone</div>" for a in ("class='comments'", "id=sidebar", "role=search", "class='cookie-notice x'", "hidden", "class='related-posts'"))
    body = f"<p>text</p>{parts}<aside>gone</aside><form>gone<input value=gone></form><noscript>gone</noscript><div class='address'>stays</div><header><h2>stays too</h2></header>"
    assert hx.extract(page("T", body)) == "T\n\ntext\n\nstays\n\nstays too"


def test_wrapper_finds_slots_without_article():
    wrap = ("<div class='main-col'>", "</div>")
    extra = "<div class='col2'><p>About this host</p><p>Always the same</p></div>"
    make = lambda t, b: page(t, b, wrap=wrap, extra=extra)
    one = make("First", "<p>Alpha beta gamma delta epsilon zeta.</p><p>Second paragraph of the first page.</p><p>All rights reserved</p>")
    two = make("Other", "<p>Wholly different words stand in here now.</p><p>All rights reserved</p>")
    wrapper = hx.induce(one, two)
    three = make("Third", "<p>New text.</p><p>All rights reserved</p><p>More new text.</p>")
    assert hx.extract(three, wrapper) == "Third\n\nNew text.\n\nMore new text."
    assert "Always the same" in hx.extract(three)  # names alone cannot know


def test_wrapper_keeps_passages_that_articles_share():
    quote = "<p>A passage that both articles quote.</p>"
    one, two = page("First", quote + "<p>" + "one " * 40), page("Second", quote + "<p>" + "two " * 40)
    wrapper = hx.induce(one, two)
    assert hx.extract(one, wrapper) == hx.extract(one)
    assert "both articles quote" in hx.extract(two, wrapper)


def test_copies_make_no_wrapper():
    assert hx.induce(page("T", "<p>same text"), page("T", "<p>same text", footer="other")) is None


def test_simple_tree_matching_keeps_order():
    a = hx.fold([hx.parse("<a1></a1><b1><c1></c1></b1><d1></d1>")])
    b = hx.fold([hx.parse("<d1></d1><a1></a1><b1><c1></c1></b1>")])
    assert [x.label for x, _ in hx.match(a, b)] == ["#page", "a1", "b1", "c1"]


def test_heaviest_chain_equals_plain_dynamic_programme():
    import random

    rng = random.Random(1)
    for _ in range(200):
        tags = [f"t{i}" for i in range(rng.randrange(1, 9))]
        weights = {t: rng.randrange(3) for t in tags}
        make = lambda order: "".join(f"<{t}>{f'<x{t}>' * weights[t]}{f'</x{t}>' * weights[t]}</{t}>" for t in order)
        one, other = rng.sample(tags, len(tags)), rng.sample(tags, rng.randrange(0, len(tags) + 1))
        best = [[0] * (len(other) + 1) for _ in range(len(one) + 1)]
        for i, x in enumerate(one, 1):
            for j, y in enumerate(other, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + (1 + weights[x] if x == y else 0))
        got = hx.match(hx.fold([hx.parse(make(one))]), hx.fold([hx.parse(make(other))]))
        assert len(got) == best[-1][-1] + 1


def test_broken_markup():
    assert hx.extract(None) == hx.extract("") == ""
    assert hx.extract("plain &lt;text&gt; < 5") == "plain <text> < 5"
    assert hx.extract("<div>" * 20_000 + "deep" + "</span>" * 9) == "deep"
    assert hx.extract("<p>open <a href=\"x>never closed") == "open"
    assert hx.extract("<script>never closed <p>x") == ""
    assert hx.extract("<p>a<!-- open") == "a"
    assert hx.extract("<table><tr><td>a<td>b<tr><td>c</table>") == "a\n\nb\n\nc"
    assert hx.induce("<div>" * 20_000 + "deep", "<div>" * 20_000 + "other") is not None
    assert hx.extract("<div>" * 20_000 + "third", hx.induce("<div>" * 20_000 + "deep", "<div>" * 20_000 + "other")) == "third"


def simple(html):
    """The article of a generated page, read by patterns made for these pages."""
    body = re.search(r"<article>(.*)</article>", html, re.S)[1]
    parts = (" ".join(unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"<(?:/?p|/?h1)>", body))
    return "\n\n".join(p for p in parts if p)


def frame(spark, pages, host="h.example"):
    return spark.createDataFrame([(i, f"http://{host}/{i}", h) for i, h in enumerate(pages)], "page_id long, url string, html string")


def texts_of(spark, pages):
    return [r.text for r in sorted(hx.extract_pages(frame(spark, pages)).collect(), key=lambda r: r.page_id)]


def test_capitals_that_grow_do_not_move_the_end_of_scripts():
    body = "<p>" + "İ" * 20 + "</p><script>var x = '<p>no</p>';</SCRIPT><p>the next paragraph</p><style>p{}</Style><p>and the last</p>"
    assert hx.extract(page("T", body)) == "T\n\n" + "İ" * 20 + "\n\nthe next paragraph\n\nand the last"


def test_parts_of_an_article_named_by_words_of_prose_stay():
    body = '<section id="discussion"><h2 id="related-work">Related work</h2><p>We discuss.</p></section><h3 class="share">Share of votes</h3>'
    assert hx.extract(page("T", body)) == "T\n\nRelated work\n\nWe discuss.\n\nShare of votes"


def test_ids_of_prose_go_where_the_host_has_them_as_a_rule(spark):
    one = [page(f"T{i}", f"<p>own text {i} of it</p><div id='discussion'><p>reader {i} says so</p></div>") for i in range(6)]
    assert texts_of(spark, one) == [f"T{i}\n\nown text {i} of it" for i in range(6)]
    rare = [page(f"T{i}", f"<p>own text {i} of it</p>" + ("<section id='discussion'><p>We discuss.</p></section>" if i == 2 else "")) for i in range(6)]
    assert texts_of(spark, rare) == [f"T{i}\n\nown text {i} of it" + ("\n\nWe discuss." if i == 2 else "") for i in range(6)]


def test_constant_notice_inside_articles_goes(spark):
    pages = [page(f"T{i}", f"<p class='x1'>Read our terms before you go on.</p><p>own text {i} of the page</p>") for i in range(10)]
    assert texts_of(spark, pages) == [f"T{i}\n\nown text {i} of the page" for i in range(10)]
    # on a few pages only it is a shared passage
    some = [page(f"T{i}", ("<p class='x1'>A passage that is quoted.</p>" if i < 5 else "") + f"<p>own text {i} of the page</p>") for i in range(10)]
    assert [("quoted" in t) for t in texts_of(spark, some)] == [i < 5 for i in range(10)]


def test_passages_shared_by_pages_without_article_stay(spark):
    wrap = ("<div class='main-col'>", "</div>")
    extra = "<div class='col2'><p>Always the same here</p></div>"
    shared = "<p>A passage that two of the pages share, word by word.</p>"
    make = lambda i, b: page(f"Title {i}", f"{b}<p>Own words {i * 7919} and {i * 104729} of page {i} stand here.</p>", wrap=wrap, extra=extra)
    for n in (2, 3, 8):
        got = texts_of(spark, [make(i, shared if i < 2 else "") for i in range(n)])
        assert got == [f"Title {i}\n\n" + ("A passage that two of the pages share, word by word.\n\n" if i < 2 else "") + f"Own words {i * 7919} and {i * 104729} of page {i} stand here." for i in range(n)]


def test_an_odd_page_does_not_decide(spark):
    wrap = ("<div class='main-col'>", "</div>")
    make = lambda i: page(f"Title {i}", f"<p>Own words {i * 7919} and {i * 104729} of page {i} stand here.</p>", wrap=wrap, extra="<div class='col2'><p>Always the same here</p></div>")
    stub = [f"<html><body><p>Error {i}: not found</p></body></html>" for i in range(2)]
    got = texts_of(spark, [make(i) for i in range(8)] + stub)
    assert got[:8] == [f"Title {i}\n\nOwn words {i * 7919} and {i * 104729} of page {i} stand here." for i in range(8)]
    assert got[8:] == ["Error 0: not found", "Error 1: not found"]


def test_copies_that_fill_a_host_keep_their_text(spark):
    pages = [page("T", "<p>The one article, copied.</p>", ad=f"ad {i}") for i in range(30)] + [page("Other", "<p>Another one.</p>")]
    assert texts_of(spark, pages) == ["T\n\nThe one article, copied."] * 30 + ["Other\n\nAnother one."]


def test_exact_copies_count_once(spark):
    copy = page("T", "<p>copied text</p><p class='n'>Shared line.</p>")
    own = [page(f"T{i}", f"<p>text {i} of its own</p>") for i in range(6)]
    assert texts_of(spark, [copy] * 200 + own)[0] == "T\n\ncopied text\n\nShared line."


def test_time_grows_with_the_page():
    import time

    def seconds(p):
        began = time.perf_counter()
        hx.parse(p)
        return time.perf_counter() - began

    assert seconds("<b>" * 5000 + "<p>x" * 3000) < 0.5
    assert seconds("<div>" * 20_000 + "</span>" * 20_000 + "<li>" * 20_000) < 1


def test_tables_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in hx.extract_pages(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == simple(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_nulls_repeats_empty(spark):
    schema = "page_id long, url string, html string, host string, wrapper string"
    rows = [(1, None, None, "x", "y"), (2, "not a url", "<p>a", "x", "y"), (None, "http://h/", "<p>b", "x", "y"), (None, "http://h/", "<p>b", "x", "y"), (5, "http://U:p@H:80/", "<p>c d", "x", "y")]
    got = hx.extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "", 0), ("2", "a", 1), ("5", "c d", 3), ("None", "b", 1), ("None", "b", 1)]
    assert hx.extract_pages(spark.createDataFrame([], schema)).collect() == []
    assert spark.sql("select 'http://U:p@H.x:80/' u").select(hx.host_of("u")).first()[0] == "h.x"
