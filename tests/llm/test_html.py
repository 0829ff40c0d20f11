import random
import time

import pytest

from lookback.llm.html import Page, main_text

FULL = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><div class="cookie-notice">We use</div><nav><ul><li>A<li>B</ul></nav>
<main><article><h1>T &amp; U</h1><p><b>One&nbsp; two<br><p>three <i>four</i>, <a href='x>y'>five</a></p>
<ul><li>i1<li>i2</ul><div class="comments"><p>nice</p></div><form><input><button>ok</button></form>
<!-- <p>no</p> --><script>var x="</p>";</script><table><tr><td>c1<td>c2</table></article>
<aside>side</aside></main><footer>f</footer></body></html>"""


def kept(html):
    return [text for text, main, furniture in Page(html).blocks if main and not furniture]


def test_article_without_its_surroundings():
    assert kept(FULL) == ["T & U", "One two", "three four, five", "i1", "i2", "c1", "c2"]


@pytest.mark.parametrize(
    "html, texts",
    [
        ("", []),
        ("plain", ["plain"]),
        ("a < b", ["a < b"]),
        ("<p>a<p>b", ["a", "b"]),
        ("</p></div>x", ["x"]),
        ('<p title="a>b">q</p>', ["q"]),
        ("<script>x", []),
        ("<!-- x", []),
        ("<div><b>x</div>y", ["x", "y"]),
        ("<p>&lt;b&gt; &#233; &eacute;</p>", ["<b> é é"]),
        ("<p class='ad'>x</p><p id=main>y</p>", ["y"]),
        ("<div class='headline'>x</div>", ["x"]),
        ("<article>a</article><p>b</p>", ["a"]),
        ("<main><p>a</main><p>b", ["a"]),
        ("<p>a <span>b</span>c</p>", ["a bc"]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
        ("<div hidden>x</div>y", ["y"]),
    ],
)
def test_blocks(html, texts):
    assert kept(html) == texts


def test_deep_and_long_pages_are_linear():
    assert kept("<div>" * 20_000 + "x" + "</div>" * 20_000) == ["x"]
    assert len(kept("<p>word</p>" * 20_000)) == 20_000
    assert kept('<p title="' * 3000) is not None


@pytest.fixture(scope="module")
def site(spark):
    def page(i, host, extra=""):
        return (
            i,
            f"https://{host}/p/{i}",
            f"<body><div><p>Menu of the site</p></div><div><p>Text {i} is its own</p><p>Shared line</p>"
            f"{extra}</div><div><em>Bottom</em></div></body>",
        )

    rows = [page(i, "a.test") for i in range(12)] + [page(100 + i, "b.test") for i in range(3)]
    rows += [(200, None, None), (201, "", ""), (None, "https://a.test/x", "<p>lone</p>"), page(0, "a.test")]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, host string, row int")


def test_templates_go_only_where_they_recur(site):
    got = {r.page_id: r for r in main_text(site).collect()}
    # No article element: what 12 pages of a host share goes, three pages are too few.
    assert got[3].text == "Text 3 is its own"
    assert got[101].text == "Menu of the site\n\nText 101 is its own\n\nShared line\n\nBottom"
    assert got[200].text == "" == got[201].text and got[200].n_chars == 0
    assert got[None].text == "lone"
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_every_row_gives_one_and_none_gives_none(site):
    assert main_text(site).count() == site.count()
    assert main_text(site.limit(0)).count() == 0


def test_copies_of_an_article_are_no_template(spark):
    html = "<article><h1>Copied</h1><p>The same everywhere</p></article>"
    rows = [(i, f"https://a.test/{i}", html) for i in range(30)]
    rows += [(i, f"https://a.test/{i}", html.replace("Copied", f"Other {i}")) for i in range(30, 60)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text.endswith("\n\nThe same everywhere") for r in got)


def test_a_template_needs_no_more_pages_on_a_large_host(spark):
    rows = [
        (i, "https://a.test/", f"<body><div>Text {i}</div>{'<div>Campaign</div>' if i % 25 == 0 else ''}</body>")
        for i in range(1500)
    ]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"Text {r.page_id}" for r in got)


BODY = "<h1>Title</h1><p>First part of the text</p><p>Second part of the text</p>"


@pytest.mark.parametrize(
    "html",
    [
        f'<div class="content has-sidebar">{BODY}</div><div class="sidebar">side</div>',
        f'<div id="page" class="no-sidebar">{BODY}</div>',
        f'<article class="post has-comments">{BODY}</article><p>x</p>',
        f'<article class="post tag-advertising">{BODY}</article><p>x</p>',
        f'<article class="comments search">{BODY}</article>',
        f'<form action="x"><div class="menu">a</div>{BODY}<input><button>go</button></form>',
        f'<div class="widget-area"><nav>n</nav><article>{BODY}</article></div><div class="related">'
        "<article>Card</article></div>",
        f'<div class="side"><div class="overlay">{BODY}</div></div>',
        f'<article>{BODY}<div class="comments"><p>{"long " * 50}</p><p>more</p></div></article>',
        f'<article>{BODY}<form><p>Mail</p></form></article><div class="related"><article>Card</article></div>',
    ],
)
def test_names_do_not_condemn_what_holds_the_text(html):
    assert kept(f"<html><body>{html}</body></html>") == ["Title", "First part of the text", "Second part of the text"]


@pytest.mark.parametrize("name", ["side-effects", "related-work", "notice-period", "social-impact", "searching-methods"])
def test_names_of_an_articles_subject_are_no_furniture(name):
    page = f'<article><p>First part of it.</p><section class="{name}"><p>Second part.</p></section></article>'
    assert kept(page) == ["First part of it.", "Second part."]


@pytest.mark.parametrize("name", ["related-posts", "sidebar", "ad-slot", "ad-slot-2", "social-share", "newsletter-box", "share", "advert"])
def test_furniture_in_an_article_goes_by_its_name(name):
    page = f'<article><p>First part of the whole text.</p><div class="{name}"><p>Not this.</p></div></article>'
    assert kept(page) == ["First part of the whole text."]


def kept(page):
    return [text for text, main, furniture in Page(page).blocks if main and not furniture]


def test_inline_furniture_leaves_the_text_around_it_whole():
    page = (
        "<article><p>Press <button>OK</button> now</p><p>a <svg><title>x</title></svg>b <span hidden>zz</span>c</p>"
        "<p>before <button><div>in it</div></button> after</p></article>"
    )
    assert kept(page) == ["Press now", "a b c", "before after"]


@pytest.mark.parametrize("opened, ends", [("<div>", "</section>"), ("<b>", "</i>"), ("<b>", "<p>"), ("<i><div>", "</i>"), ("<li>", "</ul>")])
def test_stray_ends_take_linear_time(opened, ends):
    began = time.monotonic()
    Page(opened * 40_000 + "x" + ends * 40_000)
    assert time.monotonic() - began < 10


def test_short_content_of_articles_on_a_large_host_stays(spark):
    tag, notice = "<ul><li>News</li></ul>", "<div>This notice stands in sixty of the articles of the host.</div>"
    rows = [
        (i, "https://a.test/", f"<article><p>Text {i} of it.</p>{tag if i % 25 == 0 else ''}{notice if i % 25 == 1 else ''}</article>")
        for i in range(1500)
    ]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[25] == "Text 25 of it.\n\nNews" and got[26] == "Text 26 of it."


def brute_main(rows, least=5):
    """Counting and removal by plain loops, over pages without names or furniture."""
    pages = {i: (url, Page(html)) for i, url, html in rows}
    seen = {}
    for url, page in pages.values():
        for value, *_ in page.elements:
            seen.setdefault((url, value), set()).add(page.core)
    cores = {}
    for url, page in pages.values():
        cores.setdefault(url, set()).add(page.core)
    out = {}
    for i, (url, page) in pages.items():
        gone = set()
        for value, first, stop, words in page.elements:
            n = len(seen[url, value])
            if n >= least and (n >= 0.05 * len(cores[url]) or (n >= 50 and words >= 8)):
                gone |= set(range(first, stop))
        out[i] = "\n\n".join(t for n, (t, m, f) in enumerate(page.blocks) if n not in gone and m and not f)
    return out


def test_counting_and_removal_equal_plain_loops(spark):
    rng = random.Random(6)
    parts = [f"<div><p>Part {i} of a site</p><ul><li>x{i}</li></ul></div>" for i in range(12)]
    rows = []
    for i in range(400):
        body = "".join(rng.choice(parts[: 3 + i % 10]) for _ in range(rng.randint(0, 3)))
        own = f"<p>Own text {rng.randrange(300)}</p>"
        shape = rng.choice(["<body>{}{}</body>", "<body><main>{1}</main>{0}</body>", "<article>{}{}</article>"])
        rows.append((i, f"host{i % 3}", shape.format(body, own)))
    want = brute_main(rows)
    urls = [(i, f"https://{host}.test/{i}", html) for i, host, html in rows]
    got = main_text(spark.createDataFrame(urls, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want
