import re

from sievemark.llm import url_filter as U

URLS = [None, "", "no scheme", "http://", "http://net", "http://net/", "https://A.B.NET/x?y#z", "http://example.net/en/1", "http://www.Example.NET/en/", "http://example.net/en", "http://example.com/de/a/b", "http://sub.example.com/DE/", "ftp://x.org/fr/", "http://xorg/fr/", "http://org/fr/?q=a://b", "a://b://net/", "http://net:80/", "http://example.net?x/en/", "http://.net/", "http://net./"]


def expected(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(raw) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[1] if best else None, best[2] if best else "allow"


def test_against_brute_force(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS + URLS[5:8])]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge(df).collect()}
    assert got == {i: expected(u, U.RULES) for i, u, _ in rows}


def test_other_rules_and_empty_tables(spark):
    rules = [("block", "com", ""), ("allow", "a.b.c.com", "/x"), ("block", "c.com", "/xy")]
    df = spark.createDataFrame([(1, "http://z.a.b.c.com/xyz"), (2, "http://c.com/xyz"), (3, "http://com")], "page_id long, url string")
    assert {r[0]: r["rule"] for r in U.judge(df, rules).collect()} == {1: "a.b.c.com/x", 2: "c.com/xy", 3: "com"}
    assert U.judge(df, []).filter("verdict = 'allow'").count() == 3
    assert U.judge(df.limit(0)).count() == 0
