import re
from html import unescape

from textlode.llm.queries import QUERIES
from textlode.llm.site_style import extract_main_text, node_importance, page_text, parse_page, style_nodes


def plain(html):
    """Blocks of the article of the table's pages, whose markup is simple."""
    inside = re.search(r"<article>(.*?)(</article>|$)", html or "", re.S)
    blocks = re.split(r"</?(?:p|h1|br)>", inside[1]) if inside else []
    return "\n".join(t for b in blocks if (t := " ".join(unescape(re.sub(r"</?b>", "", b)).split())))


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = QUERIES["op6_site_style"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted((p.page_id, p.url, plain(p.html), len(plain(p.html))) for p in pages)


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in extract_main_text(pages).collect()}


def test_repeated_branches_are_cut_without_any_hint(spark):
    rows = []
    for i in range(40):
        promo = f"<div class='x9'>Buy now {i % 3}</div>"
        rows.append((i, "http://h.org/a", f"<body>{promo}<div class=story><p>Story {i} tells of {i * i}</p></div><div class=z>End</div>"))
    found = texts(spark, rows)
    assert all(found[i] == f"Story {i} tells of {i * i}" for i in range(40))


def test_copies_of_a_page_do_not_make_its_article_common(spark):
    same = "<body><div class=story><p>The same article again</p></div></body>"
    rows = [(i, "http://h.org/a", same) for i in range(50)]
    rows += [(100 + i, "http://h.org/b", same.replace("again", f"number {i}")) for i in range(5)]
    found = texts(spark, rows)
    assert all(found[i] == "The same article again" for i in range(50)) and found[103].endswith("number 3")


def test_importance(spark):
    html = "<body><div class=a>same</div><div class=b>text {0}</div></body>"
    rows = [(f"h{h}", html.format(f"{h}-{i}")) for h in range(2) for i in range(30)]
    nodes = style_nodes(spark.createDataFrame(rows, "host string, html string"))
    by = {n.tag: n.path for n in parse_page(html).nodes.values()}
    assert len(by) == 2
    values = sorted(r.importance for r in node_importance(nodes).filter("host = 'h0'").collect())
    assert len(values) == 2 and values[0] < 0.1 and values[1] > 0.8


def test_roles_and_markup(spark):
    html = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
      <header>Site</header><nav><ul><li>Home<li>News</ul><div class="cookie-notice">We use</div>
      <main><h1>Head &amp; line</h1><p>One&nbsp;two <i>three</i>four<br>five &lt;six&gt; &#233;&copy
      <p>Second <!-- no --> part<script>var x = "</p><p>no";</script> ends
      <form><input>Your mail</form><aside>See also</aside>
      <section class="user-comments"><p>First!</p></section>
      <table><tr><td>a<td>b</table></main><footer>Foot</footer><div id=sidebar>Side</div>"""
    want = "Head & line\nOne two threefour five <six> é©\nSecond part\nends\na\nb"
    assert texts(spark, [(1, "http://one.org/", html)])[1] == want


def test_an_article_keeps_what_all_pages_have(spark):
    page = """<body><div class="page header-fixed"><nav>Menu</nav><article class="post comments-open"><header><h1>Title {0}</h1></header>
      <h2>Summary</h2><p>{1}</p><div class="share">Share</div><section id=comments>Mine</section></article><p>Loose</p></div>"""
    rows = [(i, "http://h.org/", page.format(i, f"Words {i}" if i % 2 else "")) for i in range(30)]
    found = texts(spark, rows)
    assert all(found[i] == f"Title {i}\nSummary" + (f"\nWords {i}" if i % 2 else "") for i in range(30))


def test_entropy_decides_inside_an_article(spark):
    page = """<body><nav>Menu {1}</nav><article><h1>Title {0}</h1><div class=x9>Buy now</div><p>Story {0} tells of {0}</p>
      <h2>Summary</h2><div class="{2}">Told on page {0}</div><div class=share>Share this</div></article></body>"""
    names = ("social history", "nav")
    rows = [(h * 100 + i, f"http://h{h}.org/", page.format(i, i * i, names[h])) for h in range(2) for i in range(100)]
    # Copies of one article beside other menus are one page.
    rows += [(1000 + i, "http://h0.org/", page.format(7, -i, names[0])) for i in range(300)]
    found = texts(spark, rows)
    for i in range(100):
        assert found[i] == f"Title {i}\nStory {i} tells of {i}\nSummary\nTold on page {i}"
        assert found[100 + i] == f"Title {i}\nStory {i} tells of {i}\nSummary"
    assert {found[1000 + i] for i in range(300)} == {found[7]}


def test_names_of_wrappers_empty_no_page(spark):
    rows, want = [], {}
    wrappers = ["<body class='has-sidebar'>{}</body>", "<div class='page header-fixed'>{}</div>", "<form>{}</form>",
                "<div class='content-with-sidebar'>{}</div>", "<div id=header>{}</div>", "<body class=sidebar>{}</body>"]
    for w, wrapper in enumerate(wrappers):
        for i in range(12):
            own = f"<div class=entry-header>Title {i}</div><div class=related-work>Work {i} tells of {i * i} and more</div>"
            rows.append((w * 100 + i, f"http://h{w}.org/", wrapper.format(f"{own}<div class='site-nav'>Menu {i}</div><nav>Go</nav>")))
            want[w * 100 + i] = f"Title {i}\nWork {i} tells of {i * i} and more"
    assert texts(spark, rows) == want
    inside = "<article><h1>T</h1><div class=entry-header>By me</div><p class=social-history>None known</p><p id=ad-1>Buy</p></article>"
    assert texts(spark, [(1, "http://one.org/", inside)])[1] == "T\nBy me\nNone known"


def test_articles_beside_the_text_are_not_main(spark):
    text = "<div class=content><p>The real text {0} that goes on</p></div>"
    post = "<article class=post><h1>Post {0}</h1><p>Tells of {0}</p></article>"
    comment = "<article class=comment><p>Reader {0}: a long remark on all of it, longer than the post</p></article>"
    pages = [
        ("<aside><article>Teaser</article></aside>" + text, "The real text {0} that goes on"),
        ("<nav><article>Teaser</article></nav>" + text, "The real text {0} that goes on"),
        (text + "<article>Short</article>" + text, None),
        (post + f"<div id=comments>{comment}</div>", "Post {0}\nTells of {0}"),
        (post.replace("</article>", f"<section>{comment}</section></article>"), "Post {0}\nTells of {0}"),
        ("<nav>Menu<ul><li>Go</ul>" + post, "Post {0}\nTells of {0}"),
        (f"<form>{post}</form><footer>Foot</footer>", "Post {0}\nTells of {0}"),
    ]
    rows = [(w * 100 + i, f"http://h{w}.org/", p.format(i)) for w, (p, _) in enumerate(pages) for i in range(12)]
    found = texts(spark, rows)
    for w, (_, want) in enumerate(pages):
        for i in range(12):
            if want:
                assert found[w * 100 + i] == want.format(i)
            else:
                assert found[w * 100 + i].count(f"The real text {i} that") == 2


def test_edges(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [
        (1, "http://a.org/", None),
        (2, None, ""),
        (3, "http://a.org/", "just text"),
        (4, "http://a.org/", "<p>cut of <b>here &am"),
        (5, "http://a.org/", "<script>never closed <p>x"),
        (6, "http://a.org/", deep),
        (7, "http://a.org/", "<article>" + "<p>word</p>" * 20_000),
        (8, "http://a.org/", "a < b <p title='>'>c</p></p></x><"),
        (9, "http://a.org/", "<!-- open"),
    ]
    found = texts(spark, rows)
    assert found[1] == found[2] == found[5] == found[9] == "" and found[3] == "just text"
    assert found[4] == "cut of here &am" and found[6] == "deep" and found[7].count("word") == 20_000
    assert found[8] == "a < b\nc\n<"
    extra = spark.createDataFrame([(None, "u", "<p>x</p>", "t", 3)], "page_id long, url string, html string, text string, host int")
    assert [tuple(r) for r in extract_main_text(extra).collect()] == [(None, "u", "x", 1)]
    assert extract_main_text(extra.limit(0)).count() == 0


def test_cut_nodes_leave_the_rest():
    html = "<body><div class=a>one<p>two</p></div><div class=b>three</div></body>"
    path = next(p for p, n in parse_page(html).nodes.items() if n.tag == "div")
    assert page_text(html, frozenset({path})) == "three"
