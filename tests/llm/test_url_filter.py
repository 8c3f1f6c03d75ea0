import random

from ledgerline.llm import url_filter as uf
from ledgerline.llm.queries import RULES


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), r.verdict == "block"), default=None)
    return host, path, best.text if best else None, best.verdict if best else default


URLS = ["http://example.org/es/1", "https://WWW.Example.ORG/en/12?x=/es/", "http://notexample.org/es/", "http://a.com/fr/x#y",
        "http://a.com/de", "http://a.com/de/", "ftp://com/fr/", "example.org/es/", None, "", "://", "http://", "http://x.org",
        "http://x.org?q=/", "http://x.org#/", "http://x.org:80/", "http://x.org/a\nb/?c", "http://É.ORG/", "a://b://c.org/",
        "http://example.org/en/1", "http://example.org/en/", "http://example.org//es/", "http://org/", "http://.org/"]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    hosts = ["a.b", "b", "c.a.b", "x.y", "y", "Q\\E.b", "+.b"]
    rules = RULES + [uf.Rule(h.lower(), p, rng.choice(["allow", "block"])) for h in hosts for p in ("/", "/u/", "/u/v", "/(w")]
    urls = URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['', 'u', 'u/', 'u/v', 'u/vw/x', '(w/', 'z'])}" for _ in range(200)]
    pages = spark.createDataFrame([(i, u, "t", "r") for i, u in enumerate(urls)] + [(3, URLS[3], "t", "r"), (None, URLS[0], "t", "r")],
                                  "page_id long, url string, token string, rule string")
    got = sorted(((-1 if r.page_id is None else r.page_id), r.host, r.path, r.rule, r.verdict)
                 for r in uf.judge(pages, rules).collect())
    want = sorted([(i, *brute(u, rules)) for i, u in enumerate(urls)]
                  + [(3, *brute(URLS[3], rules)), (-1, *brute(URLS[0], rules))])
    assert [tuple(map(str, x)) for x in got] == [tuple(map(str, x)) for x in want]


def test_empty_tables_and_native_plan(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(pages, RULES).count() == 0
    some = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    assert [r.verdict for r in uf.judge(some, []).collect()] == ["allow"]
    plan = uf.judge(some, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
