import random

from churnloom.llm import url_filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/a/", "allow"), ("example.org", "/es/a/b", "block"), ("com", "/d", "block"), ("com", "", "allow"), ("a.b", "/x", "block"), ("a.b", "/x", "allow")]


def brute(url):
    at = url.find("://") if url is not None else -1
    if at < 0:
        host = path = ""
    else:
        rest = url[at + 3 :]
        cut = min([rest.find(x) for x in "/?#" if x in rest] or [len(rest)])
        host = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(x) for x in "?#" if x in tail] or [len(tail)])]
    best = None
    for h, p, v in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1, -1, "", ""), (len(h + p), len(h), h + p, v))
    return (host, path, best[2] if best else None, best[3] if best else "allow")


def urls():
    rng = random.Random(2)
    out = [None, "", "nothing", "http://", "://x", "http://a.org", "HTTP://A.EXAMPLE.ORG/es/a/b?x#y", "http://org/", "http://xorg/", "http://example.org.", "http://u@example.org/es/", "http://a.b/x?://c.com/d", "http://É.com/dü/é", "http://x.com#/d", "http://" + "a." * 3000 + "com/d", "http://a.com/" + "é" * 40000, "http://a.b/x"]
    for _ in range(200):
        host = ".".join(rng.choice(["a", "example", "b", "org", "com", "B"]) for _ in range(rng.randrange(1, 5)))
        out.append(f"http://{host}/" + "/".join(rng.choice(["es", "a", "b", "d", "de"]) for _ in range(rng.randrange(4))) + rng.choice(["", "?q=/es/", "#x"]))
    return out


def judged(spark, pages, rules=RULES, **more):
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    return url_filter.judge_urls(pages, r, **more)


def test_against_brute_force(spark):
    data = [(i, u, "h") for i, u in enumerate(urls())] + [(None, "http://a.org/x", "h"), (0, None, "h"), (6, urls()[6], "h"), (6, urls()[6], "h")]
    pages = spark.createDataFrame(data, "page_id long, url string, host string")
    want = sorted(((i, *brute(u)) for i, u, _ in data), key=str)
    for rows in (200_000, 3):
        got = sorted((tuple(r) for r in judged(spark, pages, slice_rows=rows).collect()), key=str)
        assert got == want


def test_no_pages_and_no_rules(spark):
    schema = "page_id long, url string"
    assert judged(spark, spark.createDataFrame([], schema)).collect() == []
    page = spark.createDataFrame([(1, "http://a.org/x")], schema)
    assert [tuple(r) for r in judged(spark, page, [], default="block").collect()] == [(1, "a.org", "/x", None, "block")]


def test_plan_has_no_python(spark):
    plan = judged(spark, spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
