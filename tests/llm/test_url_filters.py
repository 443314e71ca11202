import random

from tillroll.llm.url_filters import ALLOW, BLOCK, RULES, judge, rule_frame

SCHEMA = "page_id long, url string, key string, stack string, rule string, line string"


def brute(url, rules, default=ALLOW):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:]
    cut = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    path = path[:cut]
    fits = [
        (len(h + p), len(h), h + p, v)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def judged(spark, urls, rules, partitions=4):
    pages = spark.createDataFrame([(i, u, "k", "s", "r", "l") for i, u in enumerate(urls)], SCHEMA)
    found = judge(pages, rule_frame(spark, rules), partitions=partitions).collect()
    return {r.page_id: tuple(r)[1:] for r in found}


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y=/z", "a://b://c/d",
        "https://example.com", "https://example.com/", "https://example.com/en", "x://com/",
        "https://example.com/en/", "https://notexample.com/en/", "https://a.b.example.com/en/q#f",
        "https://net/es/", "https://x.net/fr/a", "https://x.net/de/a", "https://x.net?es/",
        "https://www.example.com/en/1", "https://m.www.example.com/en/1", "http://.com/", "a://..",
    ]
    got = judged(spark, urls * 2, RULES)
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls * 2)}


def test_the_last_code_point_may_go_on(spark):
    """What follows a prefix may begin with any character, the last of all included."""
    end = "\U0010ffff"
    urls = [f"http://a.com/{end}x", f"http://{end}z.com/a", f"http://{end}{end}.com/{end}{end}", f"http://com{end}/a"]
    urls += [f"http://a.com/é{end}", "http://a.net/fr/\ufffd\U00010000", f"http://{end}.net/es/{end}"]
    got = judged(spark, urls, RULES)
    assert [got[i][2] for i in range(7)] == ["com/", "com/", "com/", None, "com/", "net/fr/", "net/es/"]
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_nested_rules_over_partitions(spark):
    random.seed(5)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "ab.com", "org"]
    paths = ["/", "/a", "/a/", "/a/b", "/b"]
    rules = [(random.choice([ALLOW, BLOCK]), h, p) for h in hosts for p in paths if random.random() < 0.6]
    urls = [
        f"http://{random.choice(['', 'x.', 'b.'])}{random.choice(hosts)}{random.choice(paths)}"
        f"{random.choice(['', 'b', '/b', '?q'])}"
        for _ in range(150)
    ]
    urls += ["http://b.a.com/a/b"] * 100  # a hot one, over several partitions
    for partitions in (1, 7):
        assert judged(spark, urls, rules, partitions) == {
            i: brute(u, rules) for i, u in enumerate(urls)
        }


def test_repeated_and_empty_rules(spark):
    rules = [(ALLOW, "com", "/"), (BLOCK, "COM", None), (BLOCK, None, "/"), (BLOCK, "", "/")]
    assert judged(spark, ["http://a.com/"], rules)[0] == ("a.com", "/", "com/", BLOCK)
    assert judged(spark, ["http://a.com/"], [])[0] == ("a.com", "/", None, ALLOW)
    assert judged(spark, [], RULES) == {}
