from tidemark.llm import urlfilter
from tidemark.llm.queries import URL_RULES

URLS = [
    (1, "http://Example.ORG/es/page?x=1"), (2, "https://www.example.org/en/12#top"), (3, "http://org/"), (4, "http://a.com/fr/x"),
    (5, "http://a.com/de/x"), (6, "http://a.net/de/x"), (7, None), (8, "no scheme/org/"), (9, "http://a.org"), (10, "http://a.org?x=/en/1"),
    (11, ""), (12, "http://notexample.org/es/"), (13, "http://x.com/FR/"), (14, "http://example.org/en/2"), (15, "ftp://b://c.com/fr/"),
    (16, "http://" + "a." * 50 + "com/de/" + "é" * 500), (17, "http:///es/"), (4, "http://a.com/fr/x"), (None, "http://a.org/\n/x"),
]


def expected(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = (None, "allow")
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best[0] is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, *best


def test_both_ways_against_plain_rules(spark):
    pages = spark.createDataFrame([(*u, "x") for u in URLS], "page_id long, url string, host string")
    want = sorted(((k, *expected(u, URL_RULES)) for k, u in URLS), key=repr)
    small = urlfilter.judge(pages, URL_RULES)
    assert sorted((tuple(r) for r in small.collect()), key=repr) == want
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    large = urlfilter.judge_by_blocks(pages, listed, blocks=3)
    assert sorted((tuple(r) for r in large.select(small.columns).collect()), key=repr) == want


def test_empty_list_and_table(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    assert {r["verdict"] for r in urlfilter.judge(pages, []).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0), URL_RULES).count() == 0


def test_collisions_are_told_apart(monkeypatch):
    class Same:
        @staticmethod
        def xxh64_intdigest(raw):
            return 7

    monkeypatch.setattr(urlfilter, "xxhash", Same)
    array = urlfilter.DigestArray.mapped(urlfilter.DigestArray.image([("a.org", "/", "block"), ("b.org", "/", "allow")]))
    found = array.find([b"b.org/", b"c.org/", b"a.org/"])
    assert [array.name(k) if k >= 0 else None for k in found] == [b"b.org/", None, b"a.org/"]


def test_beyond_the_bounds_the_answer_is_the_same(spark, monkeypatch):
    pages = spark.createDataFrame([(*u, "x", 1) for u in URLS], "page_id long, url string, rule string, row int")
    rules = [*URL_RULES, ("example.org", "/es/pa", "allow"), ("A.com", "/", "block")]
    want = sorted(((k, *expected(u, [(h.lower(), p, v) for h, p, v in rules])) for k, u in URLS), key=repr)
    assert sorted((tuple(r) for r in urlfilter.judge(pages, rules).collect()), key=repr) == want
    monkeypatch.setattr(urlfilter, "BROADCAST_BYTES", 100)
    monkeypatch.setattr(urlfilter, "MOST_LENGTHS", 1)
    out = urlfilter.judge(pages, rules)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
