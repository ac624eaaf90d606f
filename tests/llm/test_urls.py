import random

from lakemart.llm import urls
from lakemart.llm.queries import URL_RULES
from lakemart.llm.urls import Rule


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[: min(ends)] if ends else rest
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules, default="allow"):
    host, path = parse(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.name), r.host.count("."), r.verdict == "block"), default=None)
    return (host, path, best.name if best else None, best.verdict if best else default)


def check(spark, given, rules, **more):
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, rules, **more).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(given)}


GIVEN = [
    None, "", "no scheme", "http://", "http://A.COM", "http://a.com/", "http://com/x", "http://xcom/", "https://www.example.com/en/1?q",
    "https://example.com/en", "https://example.com/en/", "https://EXAMPLE.com/en/a#b", "http://x.net/es/", "http://net/fr/1", "http://x.net/de/",
    "http://h?x=://b/c", "http://h#f/e", "://a.net/es/9", "http://a.net/es//x/" + "y" * 50_000, "http://É.com/é/", "http://..com/", "http://a.com:80/en/",
    "line\nbreak://b.com/\n/x",
]


def test_contract_rules(spark):
    check(spark, GIVEN, URL_RULES)


def test_random_rules_by_trie_and_join(spark):
    rng = random.Random(5)
    hosts = ["com", "b.com", "a.b.com", "net", "x.net"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab/", "/a/b/c"]
    rules = [Rule(h, p, v) for h in hosts for p in paths for v in ("allow", "block") if rng.random() < 0.4]
    given = GIVEN + ["http://" + rng.choice(["", "q."]) + rng.choice(hosts) + rng.choice(["", "/", "/a", "/abc", "/a/b/cd", "/ab/c", "/a//b"]) for _ in range(200)]
    check(spark, given, rules)
    check(spark, given, rules, max_trie=0)


def test_empty_and_clashing(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
    df = spark.createDataFrame([(1, "http://a.com/", "h", "v"), (1, "http://a.com/", "h", "v"), (None, None, "h", "v")], "page_id long, url string, host string, verdict string")
    assert sorted(tuple(r) for r in urls.judge(df, URL_RULES).where("page_id = 1").collect()) == [(1, "a.com", "/", "com/", "allow")] * 2
    assert urls.judge(df, []).where("rule is null and verdict = 'allow'").count() == 3
