import random

from tidescore.llm import url_rules

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/x")]


def by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        after = url.split("://", 1)[1]
        cut = min((after.find(c) for c in "/?#" if c in after), default=len(after))
        host = "".join(c.lower() if c.isascii() else c for c in after[:cut])
        rest = after[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def frame(spark, urls, extra=False):
    rows = [(i, u, "x") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string")


def test_against_every_rule(spark):
    rng = random.Random(3)
    parts = ["com", "example", "www", "net", "EXAMPLE", "a", "", "é", "co m"]
    urls = [None, "", "no scheme", "http://", "x://com", "x://com/", "x://com?a=/en/", "http://WWW.Example.com/en/?q#f",
            "http://example.com:80/en/", "http://net/es/xyz", "http://net/es/y", "a://b://c.com/", "h://com//", "h://x.com\n/en/"]
    for _ in range(300):
        host = ".".join(rng.choices(parts, k=rng.randint(1, 5)))
        urls.append("http" * rng.randint(0, 1) + "://" + host + "/" * rng.randint(0, 1)
                    + "/".join(rng.choices(["en", "es", "x", "xy", ""], k=rng.randint(0, 4))) + rng.choice(["", "?a/en/", "#b"]))
    urls += urls[:5]  # repeated texts
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    got = url_rules.judge(frame(spark, urls), rules)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    for row in got.collect():
        assert tuple(row)[1:] == by_hand(urls[row.page_id], RULES), urls[row.page_id]


def test_repeated_rows_and_empty_tables(spark):
    rules = spark.createDataFrame([("block", "net", None), ("block", None, "/")], "verdict string, host string, path string")
    pages = frame(spark, ["http://a.net/b"])
    got = url_rules.judge(pages.union(pages), rules).collect()
    assert [(r.rule, r.verdict) for r in got] == [("net", "block")] * 2
    assert url_rules.judge(pages, rules.limit(0)).first().verdict == "allow"
    assert url_rules.judge(pages.limit(0), rules).count() == 0
    null_id = spark.createDataFrame([(None, "http://a.net/b")], "page_id long, url string")
    assert url_rules.judge(null_id, rules).first().verdict == "block"


def test_main_path_has_no_python(spark):
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    plan = url_rules.judge(frame(spark, ["http://com/"]), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
