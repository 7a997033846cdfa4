"""Main text of pages, page by page and by the vote of a host."""

import html
import random
import re
import time

import pytest

from tarmac.llm import host_paths as hp
from tarmac.llm.tables import table


def article(page):
    """The text of the one article of a generated page."""
    found = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    return " ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1|br)[^>]*>", " ", found))).split())


def test_given_pages(spark, small):
    pages = table(spark, small, "pages")
    got = {r.page_id: r for r in hp.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for row in rows:
        assert got[row.page_id].text == article(row.html)
        assert got[row.page_id].n_chars == len(article(row.html)) and got[row.page_id].url == row.url


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div id=wrap><header><h1>Site</h1></header><div class=post><h2>T</h2>a &lt;b&gt;<p>x<br>y<p>z <a href=1>l</a></div>"
         "<div id='comments'><p>no</p></div></div><footer>f</footer>", "T a <b> x y z l"),
        ("plain <i>te</i>xt &amp; &am &#x41;", "plain text & &am A"),
        ("<p>a<script>if (1<2) '</p>'</script>b</p><!-- c --><style>p{}</style>", "ab"),
        ("<body><nav>menu</nav><aside>x</aside><form>f</form></body>", ""),
        ("<main><header><h1>Title</h1></header><p>body</p><div class='ad-box'>buy</div></main>", "Title body"),
        ("<article><p>one  \n two\xa0three</p><div hidden>h</div><p title='a>b'>four", "one two three four"),
        ("<div style='display: none'>x</div><p>seen", "seen"),
        ("<![CDATA[raw <b>]]> end", "raw <b> end"),
        (None, ""),
        ("", ""),
        # quotes count where a value begins, and only if they are closed
        ("<p>a<img alt=\"5\" tall\">b</p>", "ab"),
        ("<p>one <a href=\"x>two</a> three", "one two three"),
        ("<p>1 <2 and 3> 2, a<b", "1 <2 and 3> 2, a<b"),
        ("<p>x</p  ><script>1</SCRIPT x>y<!-->z--><p>w<!-- never", "x yz--> w"),
        # a headline in a container of its own, before a text without one
        ("<div class='menu'>" + "many links " * 9 + "</div><div class='title'>The News</div><div class='content'><p>" + "body " * 9
         + "</p></div><div class='footer'>" + "foot " * 9 + "</div>", "The News " + ("body " * 9).strip()),
        ("<div><h1>Name</h1></div><div><div class=a><p>" + "long " * 9 + "</p></div></div>", "Name " + ("long " * 9).strip()),
        ("<div class=site-title>Site</div><div class=c><h1>Own</h1><p>" + "text " * 9 + "</p></div>", "Own " + ("text " * 9).strip()),
        # names of topics are no chrome inside an article, names of chrome are
        ("<article><p>" + "body " * 9 + "</p><div class='notice-of-award'>won</div><div class='search-results-analysis'>found</div>"
         "<div class='related-posts'>more</div><div class='cookie-notice'>ok?</div><div id=ad-300x250>buy</div></article>",
         "body " * 9 + "won found"),
        ("<p>" + "long " * 200_000 + "</p>", ("long " * 200_000).strip()),
    ],
)
def test_pages(spark, page, text):
    frame = spark.createDataFrame([(1, "https://h.example/x", page, "t")], "page_id long, url string, html string, text string")
    (row,) = hp.extract(frame).collect()
    assert (row.text, row.n_chars) == (text, len(text))


def test_a_host_elects_its_path(spark):
    """One page has more text beside the article; the host's other pages settle where the article is."""
    usual = "<div class='c{n}'><p>{body}</p></div><div class='x'><p>see also</p></div>"
    odd = "<div class='c9'><p>short</p></div><div class='x'><p>" + "beside " * 30 + "</p></div>"
    pages = [(k, f"http://Host.example:80/{k}", usual.format(n=k, body=f"text {k} " * 9)) for k in range(9)]
    pages += [(9, "http://host.example/9", odd), (10, "http://other.example/1", odd), (11, None, odd), (11, None, odd)]
    pages += [(None, "http://host.example/0", None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = sorted(((str(r.page_id), r.text) for r in hp.extract(frame).collect()), key=str)
    texts = dict(got)
    assert texts["3"] == ("text 3 " * 9).strip() and texts["9"] == "short"
    assert texts["10"] == texts["11"] == ("beside " * 30).strip() and texts["None"] == ""
    assert len(got) == len(pages)
    assert hp.extract(frame.where("page_id < 0")).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<body class='single no-sidebar'><nav>menu</nav>{}</body>",
        "<div class='content with-sidebar'>{}</div><div class='sidebar'>see also</div>",
        "<article class='post has-comments'>{}<div class='comments'>no</div></article>",
        "<main id='page-widgets'>{}</main>",
        "<div class='elementor-widget-container'>{}</div><div class='elementor-widget-container'>more</div>",
        "<form id='aspnetForm'><div class='menu'>x</div>{}<div class='footer'>y</div></form>",
    ],
)
def test_a_name_on_the_whole_page_is_no_chrome(page):
    text = "the text of the page " * 5
    cutter = hp.Cutter()
    blocks = cutter.cut(page.format(f"<p>{text}</p>"))
    assert [b.text for b in blocks if not b.chrome] == [text.strip()]
    assert cutter.vote() is not None


def test_many_comments_stay_chrome():
    page = "<div class='post'><p>a short post</p></div><div id='comments'><p>" + "long talk " * 9 + "</p></div>"
    assert [b.text for b in hp.Cutter().cut(page) if not b.chrome] == ["a short post"]


ODD = ['"', "'", '<a "', "<a <a ", "<a b='", "<div>", "<div class=x>y", "<!--", "<![CDATA[", "<script>", "</script ", "<h1>", "</div>", "&amp", "<a=\"", "<x y ", "< ", "<p title='a>b' "]


@pytest.mark.parametrize("part", ODD)
def test_odd_pages_of_a_megabyte_take_linear_time(part):
    started = time.process_time()
    page, vote = hp._cut_page("<p>start " + part * (1_000_000 // len(part)))
    hp.text_under(page, [vote] if vote else [])
    assert time.process_time() - started < 8


def test_the_vote_equals_that_over_all_path_prefixes():
    """Running sums over the tree against sums over every prefix of every path."""
    draw = random.Random(9)
    for _ in range(300):
        parts = []
        for _ in range(draw.randint(1, 40)):
            parts.append(draw.choice(["<div>", "<div class=a>", "<article>", "<nav>", "</div>", "</article>", "</nav>", "<p>", "w w w", "some words", "<a>x y</a>"]))
        cutter = hp.Cutter()
        blocks = cutter.cut("".join(parts))
        clean, junk = {}, {}
        for block in blocks:
            spoiled = len(block.text) if block.chrome else block.linked
            steps = cutter.path(block.node).split("/")[:-1]
            for k in range(1, len(steps) + 1):
                prefix = "".join(f"{step}/" for step in steps[:k])
                clean[prefix] = clean.get(prefix, 0) + len(block.text) - spoiled
                junk[prefix] = junk.get(prefix, 0) + spoiled
        values = [
            ((1.25 if any(step.split(".")[0] in hp.MAIN_TAGS for step in path.split("/")) else 1.0) * size - 0.5 * junk[path], path.count("/"), path)
            for path, size in clean.items() if size > 0
        ]
        assert cutter.vote() == max(values, default=(0, 0, None))[2]
