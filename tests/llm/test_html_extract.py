import html as html_module
import re

import pytest
from pyspark.sql import functions as F

from strataframe.llm import html_extract as H
from strataframe.llm.queries import op6


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_whole_table(spark, tiny):
    """The given pages hold their text in one article element."""
    pages = spark.read.parquet(f"{tiny}/pages.parquet").collect()
    got = {r.page_id: r for r in op6(spark, tiny).collect()}
    assert len(got) == len(pages)
    for p in pages:
        article = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [html_module.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


def shop(k, body):
    return (
        f"<html><head><title>t{k}</title></head><body><div id=top class='navbar'><a href=/>Home</a> <a href=/x>Item {k}</a></div>"
        f"<div class=wrap><div class=story>{body}</div><div class='sidebar box-{k}'><p>Side {k}</p></div><p>All rights reserved.</p></div>"
        f"<div class=comments><p>reader {k}: nonsense</p></div><form><p>Mail</p></form></body></html>"
    )


def test_template_without_article_elements(spark):
    rows = [(k, "http://shop.example/p", shop(k, f"<h2>Story {k}</h2><p>Long body of story {k}, told at some length here.<p>And &amp; more <b>of</b> it, {k}.")) for k in range(8)]
    got = texts(H.main_text(pages_of(spark, rows)))
    for k in range(8):
        assert got[k] == f"Story {k}\nLong body of story {k}, told at some length here.\nAnd & more of it, {k}."


def test_repeated_articles_are_kept(spark):
    same = "<body><nav>Menu</nav><article><p>The very same words.</p><aside>Ad</aside></article><footer>f</footer></body>"
    rows = [(k, "http://copies.example/", same) for k in range(10)]
    assert set(texts(H.main_text(pages_of(spark, rows))).values()) == {"The very same words."}


def test_equal_vectors_make_classes():
    parsed = [H.parse(shop(k, "<p>x</p>" * k)) for k in range(3)]
    counts = [H.token_counts(*p) for p in parsed]
    assert all(c["/html/body/div.wrap/div.story"][0] == 1 for c in counts)
    assert any(t.startswith("=") for t in counts[0])
    assert H._vector_parts(5, 1) != H._vector_parts(5, 2) != H._vector_parts(6, 2)


@pytest.mark.parametrize(
    "source,want",
    [
        (None, ""),
        ("", ""),
        ("plain words only", "plain words only"),
        ("<p>a&amp;b &lt;i&gt; &#233;&nbsp;x<p>second\n line<br>same", "a&b <i> é x\nsecond line same"),
        ("<script>var t='</p>';</script><style>p{}</style><p>kept</p><!-- <p>no</p> -->", "kept"),
        ("<article><header><h1>H</h1></header><p>x</p><div class='ad-slot'>buy</div></article><p>out", "x"),
        ("<main><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></main>", "one\ntwo\nc1\nc2"),
        ("<p>1 < 2 and <b>bold</p></div></p><p>end <a href='>'>link</a>", "1 < 2 and bold\nend link"),
        ("<article><p>open <i>end", "open end"),
        ("<nav>menu</nav><aside>x</aside><form>f</form><footer>y</footer>", ""),
        ("<div class=Cookie-Notice>we</div><p>text</p><section id='comments'><p>first!</p></section>", "text"),
        ("<script>never closed <p>x", ""),
        ("<article>a <math>x</math> b<noscript><p>n</p></noscript><xmp>code <b>&amp;</xmp></article>", "a x b\nn\ncode <b>&amp;"),
        ("<article><p>x</p><div class='related'><p>Related work is discussed.</p></div><section class='search-results'>two found</section></article>", "x\nRelated work is discussed.\ntwo found"),
    ],
)
def test_single_pages(spark, source, want):
    (r,) = H.main_text(pages_of(spark, [(1, None, source)])).collect()
    assert (r.text, r.n_chars) == (want, len(want))


def test_ties_long_pages_names_and_empty_table(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000 + "</article>"
    rows = [(1, "http://a/", long), (1, "http://a/", long), (None, None, None), (2, "no host", "<p>x")]
    clash = pages_of(spark, rows).select("*", *[F.lit("z").alias(n) for n in ("host", "body", "template", "text", "token", "pages")])
    got = H.main_text(clash).collect()
    assert sorted(r.n_chars for r in got) == [0, 1, 12 * 30_000 - 1, 12 * 30_000 - 1]
    assert [r.text for r in got if r.page_id == 1] == ["\n".join(["word & word"] * 30_000)] * 2
    assert H.main_text(pages_of(spark, [])).count() == 0


def test_a_class_out_of_order_is_left_out():
    t = H.Template([["/body", "/body/div.a", "/body/div.b"]], frozenset(), ("/body/div.a",))
    assert t.standing(["/body", "/body/div.a", "/body/div.b"])
    assert not t.standing(["/body", "/body/div.b", "/body/div.a"])


def test_template_text_inside_the_root_goes_and_copies_stay(spark):
    def page(k, story):
        return f"<body><nav>n{k % 3}</nav><article><p>Subscribe for updates.</p><p>{story}</p><p>All rights reserved.</p></article></body>"

    rows = [(k, "http://news.example/", page(k, f"What happened on day {k} is told here.")) for k in range(8)]
    # one page many times counts once, and so does one that two hosts share
    rows += [(100 + k, f"http://{'news' if k else 'a'}.example/", page(0, "Copied words.")) for k in range(30)]
    rows += [(200 + k, "http://same.example/", f"<body><nav>n{k}</nav><article><p>The same words.<p>Twice.</article>") for k in range(9)]
    got = texts(H.main_text(pages_of(spark, rows)))
    assert [got[k] for k in range(8)] == [f"What happened on day {k} is told here." for k in range(8)]
    assert got[101] == "Copied words."
    assert {got[200 + k] for k in range(9)} == {"The same words.\nTwice."}


@pytest.mark.parametrize(
    "before,after",
    [
        ("<body class='has-sidebar'><article>", "</article>"),
        ("<body class='no-sidebar'><main class='content with-sidebar'>", "</main>"),
        ("<body><article class='post promo'>", "</article>"),
        ("<body><div id='comments-open'><article>", "</article></div>"),
        ("<body><div class='page-with-nav'>", "</div>"),
        ("<body><article><div class='page-with-nav'>", "</div></article>"),
    ],
)
def test_theme_names_do_not_drop_the_page(spark, before, after):
    side = "<div class='sidebar'><p>Side words of number {0}</p></div><section id=comments><p>reader {0} says so</p></section>"
    rows = [(k, "http://theme.example/", f"{before}<p>Story {k} is told here at length, so that it is most of the page.</p>{after}" + side.format(k)) for k in range(8)]
    rows.append((50, "http://alone.example/", rows[3][2].replace("Story 3", "Story 50")))
    assert texts(H.main_text(pages_of(spark, rows))) == {k: f"Story {k} is told here at length, so that it is most of the page." for k in [*range(8), 50]}


def test_two_content_containers_without_article_elements(spark):
    def page(k):
        links = "".join(f"<li><a href=/{k}/{j}>Other story {k} {j}</a></li>" for j in range(3))
        return (
            f"<body><div class=top><a href=/>Home</a><p>Daily paper</p></div><div class=lead><p>Lead of story {k}, a few words.</p></div>"
            f"<ul class=more>{links}</ul><div class=text><p>The body of story {k} is longer: {'it goes on and on, ' * 6}to its end.</p>"
            f"<ul><li><a href=/s{k}>Source {k}</a></li></ul></div><div class=last><p>Printed in town.</p></div></body>"
        )

    got = texts(H.main_text(pages_of(spark, [(k, "http://two.example/", page(k)) for k in range(8)])))
    for k in range(8):
        assert got[k] == f"Lead of story {k}, a few words.\nThe body of story {k} is longer: {'it goes on and on, ' * 6}to its end.\nSource {k}"


def neutral(k, story, extra=""):
    """No article, and no name that says anything."""
    return (
        f"<body><div class=a1><p>Morning Courier</p><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></div>"
        f"<div class=row><div class=col-1><p>Home of the Courier</p><p>Weather: see below.</p></div>"
        f"<div class=col-2><p>{story}</p>{extra}<p>Subscribe for updates.</p></div></div>"
        f"<div class=a9><p>All rights reserved.</p><p>Printed in town.</p></div></body>"
    )


def test_the_method_decides_where_names_say_nothing(spark):
    rows = [(k, "http://neutral.example/", neutral(k, f"Story {k} is told here at some length, for all to read.", f"<p>It ends so {k}.</p>" * (k % 2))) for k in range(8)]
    got = texts(H.main_text(pages_of(spark, rows)))
    for k, _, html in rows:
        want = [f"Story {k} is told here at some length, for all to read."] + [f"It ends so {k}."] * (k % 2)
        assert got[k] == "\n".join(want)
        assert H.extract(html, H.Template.of(None)) != want  # no template, no answer


def test_numbered_names_are_columns_and_numbered_pages_are_not():
    assert H._names(" class='col-1' id=post-12") == "col-1.post-#"
    assert H._names(" class='col-2 entry-10345'") == "col-2.entry-#"
    blocks, _ = H.parse("<body><div class=col-1>a</div><div class=col-2>b</div></body>")
    assert len({b.path for b in blocks}) == 2


def brute_host(pages):
    """Pages as lists of (container, [(text, linked)]): what the method keeps by
    plain counting.  Containers stand on all pages, once each."""
    n = len(pages)
    stands = {}
    for page in pages:
        for name, blocks in page:
            for t in {t for t, _ in blocks}:
                stands[name, t] = stands.get((name, t), 0) + 1
    own = {}
    for page in pages:
        for name, blocks in page:
            for t, linked in blocks:
                if stands[name, t] < n:
                    own.setdefault(name, [0, 0])[linked] += len(t)
    out = []
    for page in pages:
        kept = []
        for name, blocks in page:
            unlinked, linked = own.get(name, (0, 0))
            kept += [t for t, _ in blocks if unlinked > linked and stands[name, t] < n]
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_small_hosts_against_plain_counting(spark, seed):
    import random

    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghijklmno", k=7))
    names = [f"x{i}" for i in range(6)]
    fixed = {name: [" ".join(word() for _ in range(4)) for _ in range(r.randrange(1, 3))] for name in names}
    kinds = {name: ("fixed", "links", "text")[i % 3] for i, name in enumerate(names)}
    pages = []
    for _ in range(9):
        page = []
        for name in names:
            blocks = [(t, 0) for t in fixed[name]]
            if kinds[name] == "links":
                blocks += [(" ".join([word(), word()]), 1) for _ in range(r.randrange(1, 5))]
            if kinds[name] == "text":
                blocks += [(" ".join(word() for _ in range(30)), 0) for _ in range(r.randrange(1, 4))] + [(word(), 1)]
            page.append((name, blocks))
        pages.append(page)
    html = [
        "<body>" + "".join(f"<div class={name}>" + "".join(f"<p><a href=/>{t}</a></p>" if linked else f"<p>{t}</p>" for t, linked in blocks) + "</div>" for name, blocks in page) + "</body>"
        for page in pages
    ]
    got = texts(H.main_text(pages_of(spark, [(k, "http://h.example/", h) for k, h in enumerate(html)])))
    assert [got[k] for k in range(9)] == brute_host(pages)
