import random

from stewardry.llm import url_filter as u
from stewardry.llm.queries import URL_RULES


def brute(host, path, rules):
    best = None
    for h, p, v in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or (len(h), len(p)) >= best[0]:
                best = ((len(h), len(p)), h + p, v)
    return best


def test_trie_against_all_rules():
    rnd = random.Random(3)
    labels, segments = ["a", "b", "com", "net", "xa"], ["en", "e", "fr", "", "en-x"]
    name = lambda: ".".join(rnd.choices(labels, k=rnd.randint(1, 4)))
    road = lambda: "/" + "/".join(rnd.choices(segments, k=rnd.randint(0, 3)))
    rules = list({(h, p): (h, p, rnd.choice(["allow", "block"])) for h, p in ((name(), road()) for _ in range(60))}.values())
    trie = u.build_trie(rules)
    for _ in range(3000):
        host, path = name(), rnd.choice(["", road()])
        assert u.longest_match(trie, host, path) == brute(host, path, rules)


URLS = [
    (1, "https://www.Example.com/en/x?y=/fr/"), (2, "http://blog.example.com/en/"), (3, "http://example.com/en"),
    (4, "ftp://a.net/es/1#z"), (5, "http://net"), (6, None), (7, ""), (8, "no scheme/com/"), (9, "http://"),
    (10, "http://a://b.com/x"), (11, "http://ÄB.COM/"), (1, "https://www.Example.com/en/x?y=/fr/"),
]


def test_rules_and_odd_urls(spark):
    pages = spark.createDataFrame([(i, x, "clash", "clash") for i, x in URLS], "page_id long, url string, rule string, host string")
    one = u.filter_urls(pages, URL_RULES)
    many = u.filter_urls(pages, URL_RULES, trie_rules=2)
    got = sorted(map(tuple, one.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    assert got == sorted(map(tuple, many.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    rows = {r[0]: r[1:] for r in got}
    assert len(got) == len(URLS)
    assert rows[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert rows[2] == ("blog.example.com", "/en/", "example.com/en/", "block")
    assert rows[3] == ("example.com", "/en", "com/", "allow")
    assert rows[4] == ("a.net", "/es/1", "net/es/", "block")
    assert rows[6] == rows[8] == ("", "", None, "allow")
    assert rows[11][0] == "Äb.com"
    assert u.filter_urls(pages.where("false"), URL_RULES).collect() == []
