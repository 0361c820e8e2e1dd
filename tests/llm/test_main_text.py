import re

from helpers import same_rows

from specloom.llm import main_text

PAGES = "page_id long, url string, html string, text int, path string, score int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x", 1) for i, (u, h) in enumerate(rows)], PAGES)


def texts(spark, rows):
    found = main_text.main_text(pages(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    out = {r.page_id: r for r in found.collect()}
    assert all(r.n_chars == len(r.text) for r in out.values()) and len(out) == len(rows)
    return [out[i].text for i in range(len(rows))]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><!-- <p>no</p> --><div class="ad">Buy this</div>
<div class="cookie-notice">Cookies!</div><article><h1>Head &amp; line</h1><p>First   para
graph<br>goes <b>on</b>.<p>Second&nbsp;one &lt;x&gt; &am<ul><li>a<li>b</ul><form>Name <input></form><aside>Side</aside>
<table><tr><td>c1<td>c2</table></article><section class="comments"><p>Reader says a lot, a lot, a lot, a lot, a lot,
a lot, a lot, a lot</p></section><div class="sidebar">More</div><footer>&copy; X</footer></body></html>"""
TEXT = "Head & line\nFirst para graph goes on.\nSecond one <x> &am\na\nb\nc1\nc2"


def test_article_without_what_surrounds_it(spark):
    assert texts(spark, [("http://a.com/1", PAGE)]) == [TEXT]


def test_cut_off_and_unbalanced_markup(spark):
    article = "<html><body><nav>x</nav><article><p>One two three<p>Four <b>five"
    rows = [article, article + "</i></div></article><footer>f", article + "</b></article></body>", article + "<scr", "plain &eacute;"]
    assert texts(spark, [("http://a.com", h) for h in rows]) == [
        "One two three\nFour five", "One two three\nFour five", "One two three\nFour five", "One two three\nFour five", "plain é",
    ]


def test_the_host_decides_which_containers_are_lists_of_links(spark):
    """On the odd page, the list has no link and the post has many; the host's votes still win."""
    def page(post, others):
        return f"<body><div class='post-1'><div><p>{post}</p></div></div><div class='more'><p>{others}</p></div></body>"

    links = "".join(f"<a href='{i}'>Read about {i}</a> " for i in range(4))
    body = "the body of this post, with some words in it. " * 9
    rows = [(f"http://H.com/{i}", page(body, links)) for i in range(5)]
    rows += [("http://h.com/x", page(links + "small body", "plain words")), ("http://other.com/x", page(body, "plain words"))]
    found = texts(spark, rows)
    assert found[:5] == [body.strip()] * 5
    assert found[5] == "Read about 0 Read about 1 Read about 2 Read about 3 small body"
    assert found[6] == f"{body.strip()}\nplain words"


def test_a_host_without_article_or_main_keeps_what_stands_beside_its_body(spark):
    long = ("a sentence of the article, with some words in it. " * 9).strip()
    menu = "<div class=top><a href=a>Home page</a> <a href=b>Contact</a></div>"
    rows = [
        ("http://a.com", f"<body>{menu}<div class=page><h1>Title</h1><p>Lead</p><div class=body><p>{long}</div></div>"),
        ("http://b.com", f"<body>{menu}<div id=content><p>{long}</div><p>After it"),
        ("http://c.com", f"<body>{menu}<section class=one><p>{long}</section><section class=two><p>Second</section>"),
        ("http://d.com", f"<body>{menu}<div class=body><p>{long}</div><div class=sidebar><p>Side</div><div class=ad>Buy</div>"),
        ("http://e.com", f"<body>{menu}<div class=body><p>{long}<div class=refs><a href=c>Source one</a></div></div><p>End"),
    ]
    want = [f"Title\nLead\n{long}", f"{long}\nAfter it", f"{long}\nSecond", long, f"{long}\nSource one\nEnd"]
    assert texts(spark, rows) == want


def test_deep_markup_takes_memory_in_proportion_to_its_length(spark):
    import tracemalloc

    many = {
        "div": "<div class='a b'>" * 100_000 + "deep", "span": "<span>" * 50_000 + "</b><div>x</div></i>" * 50_000 + "deep",
        "ad": "<div class=some-ad>" * 100_000 + "deep", "article": "<article>" * 100_000 + "deep",
    }
    for name, page in many.items():
        tracemalloc.start()
        parsed = main_text.parse(page)
        found = main_text.votes(parsed)
        text = main_text.extract(parsed, None, None, frozenset())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert text.endswith("deep") and len(found) <= 100_001, name
        assert peak < 100 << 20, (name, peak)
    assert texts(spark, [("http://a.com", many["div"]), ("http://a.com", many["div"])]) == ["deep", "deep"]


def test_odd_rows(spark):
    rows = [(None, PAGE), ("http://a.com", None), ("http://a.com", ""), ("", "<p>x</p>"), ("http://a.com", PAGE), ("http://a.com", PAGE),
            ("http://b.com", "<p>" + "long text " * 200_000 + "</p>"), ("http://b.com", "<div>" * 2000 + "deep"), ("nohost", "<nav>x</nav>")]
    assert texts(spark, rows) == [TEXT, "", "", "x", TEXT, TEXT, ("long text " * 200_000).strip(), "deep", ""]
    assert main_text.main_text(pages(spark, [])).collect() == []


def test_votes_do_not_depend_on_partitions(spark):
    rows = [(f"http://h{i % 3}.com/{i}", PAGE.replace("ad", f"x{i}")) for i in range(30)]
    one = main_text.main_text(pages(spark, rows).coalesce(1)).collect()
    many = main_text.main_text(pages(spark, rows).repartition(7)).collect()
    assert same_rows(one) == same_rows(many)


def test_test_pages_against_the_markup_they_are_made_of(spark):
    import html

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = {r.page_id: r.text for r in main_text.main_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()}
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", x))).strip() for x in re.split("</?(?:p|h1)>", article)]
        assert found[r.page_id] == "\n".join(x for x in parts if x)


def test_the_article_is_whole_in_other_layouts(spark):
    long = "a sentence of the article, with some words in it. " * 6
    want = long.strip()
    rows = [
        ("http://section.com", f"<body><nav>n</nav><article><h1>Title</h1><p>Lead</p><section><p>{long}</section></article>"),
        ("http://body.com", f"<body><main><h1>Title</h1><p>Lead</p><div class=body><p>{long}<p>{long}</div></main>"),
        ("http://siblings.com", f"<body><div class=page><div class=intro><p>{long}</div><div class=body><p>{long}<p>{long}</div></div>"),
        ("http://table.com", f"<body><article><p>Lead</p><table><tr><td>{long}<td>{long}</table><p>End</article>"),
        ("http://w.com", f"<body><article><h1>Title</h1><div class='w-1/2'><div><p>{long}</div></div></article>"),
        ("http://links.com", "<body><div><a href=x>one</a></div><div><a href=y>two</a></div>"),
    ]
    assert texts(spark, rows) == [
        f"Title\nLead\n{want}", f"Title\nLead\n{want}\n{want}", f"{want}\n{want}\n{want}", f"Lead\n{want}\n{want}\nEnd",
        f"Title\n{want}", "one\ntwo",
    ]


def test_names_that_only_contain_a_marker_hide_nothing(spark):
    long = ("a sentence of the article, with some words in it. " * 6).strip()
    names = ["layout-sidebar-right", "post-with-comments", "single-ad-free", "page has-x post-sidebar", "related-work"]
    rows = [(f"http://a{i}.com", f"<body><div class='{n}'><article><p>{long}</article></div>") for i, n in enumerate(names)]
    rows += [(f"http://b{i}.com", f"<body><div class='{n}'><div><p>{long}</div></div><p>End") for i, n in enumerate(names)]
    rows += [
        ("http://c.com", f"<body><article><p>One<section id=search-algorithms><p>{long}</section><div class=related-work><p>Two</div></article>"),
        ("http://d.com", f"<body><div class=post-with-comments><article><p>{long}</article><div class=comments><article><p>Talk</article></div></div>"),
        ("http://e.com", f"<body><div class=banner><p>{long}</div>"),
        ("http://f.com", f"<body><div class=post><p>{long}</div><div class=site-sidebar><p>Side</div><div class=comments><p>{long}{long}</div>"),
    ]
    found = texts(spark, rows)
    assert found[:5] == [long] * 5 and all(long in x for x in found[5:10])
    assert found[10:] == [f"One\n{long}\nTwo", long, long, long]
