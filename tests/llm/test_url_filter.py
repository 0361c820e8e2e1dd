import re

from helpers import same_rows

from specloom.llm import url_filter

PAGES = "page_id long, url string, html string, score int, host int, path int"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", 1, 2, 3) for i, u in enumerate(urls)], PAGES)


def plain(url):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h + p), h + p, v) for v, h, p in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [
    "https://A.Example.ORG/es/1", "http://example.org/en/12?x=1", "http://example.org/en/2", "http://x.com/fr/a#b/c",
    "http://x.com/de/", "http://y.com/de", "com/de/", "http://com/de/9", "http://badcom/de/1", "http://org", "http://org?/x",
    "x://a.net/p?u=http://b.com/fr/", "", None, "http://", "http://É.com/de/ü", "ftp://n.net/a-b-c/9.html?a=1&b=2#f",
    "http://example.org\n/es/", "http://x.com/de/", "http://ORG/",
]


def test_rules_against_a_plain_version(spark):
    found = url_filter.filter_urls(pages(spark, URLS)).collect()
    assert same_rows((r.page_id, r.host, r.path, r.rule) for r in found) == same_rows(
        (i, *plain(u)[:3]) for i, u in enumerate(URLS)
    )
    for r in found:
        ruling = plain(URLS[r.page_id])[3]
        assert r.verdict in ("allow", "block") and (ruling is None or r.verdict == ruling)
        assert (r.block_score is None) == (ruling is not None)


def test_trees_learn_what_the_labels_show(spark):
    long, short = "/de/" + "a1-" * 20, "/fr/b"
    urls = [f"http://h{i % 9}.com{long}{i}" for i in range(80)] + [f"http://h{i % 9}.com{short}{i}" for i in range(80)]
    asked = [f"http://h{i % 9}.net/en/{'a1-' * 20}{i}" for i in range(5)] + [f"http://h{i}.net/xx/b{i}" for i in range(5)]
    found = {r.page_id: r.verdict for r in url_filter.filter_urls(pages(spark, urls + asked)).collect()}
    assert [found[160 + i] for i in range(10)] == ["block"] * 5 + ["allow"] * 5


def test_features_of_one_url(spark):
    url = "http://a-b.example.com/x/yy/1?p=1&q=2"
    row = url_filter.lexical(url_filter.ruled(pages(spark, [url]))).first()
    assert (row.url_length, row.host_length, row.depth, row.labels, row.n_parameters, row.n_hyphens) == (37, 15, 3, 3, 2, 1)
    assert row.longest_segment == 2 and row.suffix == "com" and abs(row.digit_ratio - 3 / 37) < 1e-12
    import math
    from collections import Counter

    expected = -sum(n / 37 * math.log2(n / 37) for n in Counter(url).values())
    assert abs(row.entropy - expected) < 1e-9


def test_a_frequent_url_is_learned_from_once(spark, monkeypatch):
    """One url has a third of the rows, another one is very long; quality on urls of another host is kept."""
    monkeypatch.setattr(url_filter, "LEARN_URLS", 300)
    urls = [f"http://h{i % 9}.com/{'de' if i % 2 else 'fr'}/{'a1-' * 20 if i % 2 else 'b'}{i}" for i in range(2000)]
    urls += ["http://hot.com/fr/b"] * 1000 + ["http://long.com/fr/" + "b" * 300_000]
    asked = [f"http://h{i % 9}.net/en/{'a1-' * 20}{i}" for i in range(5)] + [f"http://h{i}.net/xx/b{i}" for i in range(5)]
    rows = pages(spark, urls + asked)
    judged = url_filter.lexical(url_filter.ruled(rows)).filter("ruling is not null")
    learn = url_filter.learned(judged, 2002).collect()
    assert 200 <= len(learn) <= 400 and len({r.url for r in learn}) == len(learn)
    assert all(r._rows == (1000 if r.host == "hot.com" else 1) for r in learn)
    found = {r.page_id: r.verdict for r in url_filter.filter_urls(rows).collect()}
    assert [found[len(urls) + i] for i in range(10)] == ["block"] * 5 + ["allow"] * 5


def test_null_columns_of_clashing_names(spark):
    rows = spark.createDataFrame([(None, None, None, None, None, None), (1, "http://x.com/de/", None, None, None, None)], PAGES)
    assert same_rows((r.page_id, r.rule) for r in url_filter.filter_urls(rows).collect()) == same_rows([(None, None), (1, "com/de/")])


def test_one_verdict_none_and_no_rows(spark):
    only = url_filter.filter_urls(pages(spark, ["http://x.com/de/1", "http://q.net/"])).collect()
    assert {r.verdict for r in only} == {"block"}
    none = url_filter.filter_urls(pages(spark, ["http://q.net/", None])).collect()
    assert {r.verdict for r in none} == {"allow"}
    assert url_filter.filter_urls(pages(spark, [])).collect() == []
