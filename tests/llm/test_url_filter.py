import random

from pyspark.sql import functions as F

from cartlark.llm import url_filter

LABELS, PATHS = ["a", "b", "co", "uk"], ["", "/", "/x", "/x/", "/x/y", "/xy/z/", "//"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for mark in "?#":
        rest = rest.split(mark, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def judged(url, rules):
    host, path = split(url)
    fits = [
        (len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    *_, rule, verdict = max(fits)
    return host, path, rule, verdict


def test_verdicts_equal_trying_every_rule(spark, monkeypatch):
    rng = random.Random(5)
    rules = list({
        (".".join(rng.choices(LABELS, k=rng.randint(1, 3))), rng.choice(PATHS)):
        rng.choice(["allow", "block"]) for _ in range(60)
    }.items())
    rules = [(h, p, v) for (h, p), v in rules] + [("a", "/x", "allow"), ("a", "/x", "block")]
    urls = [
        "http://" + ".".join(rng.choices([*LABELS, "A", "É"], k=rng.randint(1, 5)))
        + rng.choice(PATHS) + rng.choice(["", "z", "/q?u=/x", "#/x/", "?://b/"])
        for _ in range(300)
    ]
    urls += [None, "", "a.b/x", "://", "x://", "x:///x", "ftp://co.uk\n/x/", "http://a/x\ny"] + urls[:50]
    urls += ["http://" + "a." * 3000 + "b/" + "x/" * 3000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn(
        "host", F.lit("clash")
    ).union(spark.createDataFrame([(None, urls[0], "x")], "page_id bigint, url string, host string"))
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    expected = sorted(
        ((i, *judged(u, rules)) for i, u in [*enumerate(urls), (-1, urls[0])]), key=str
    )
    for limit in (64 << 20, 0):  # sent to executors, or shuffled
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
        found = url_filter.judge(pages.select("page_id", "url", "host"), frame).collect()
        assert sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in found), key=str) == expected


def test_no_pages_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a/")], "page_id bigint, url string")
    rules = url_filter.parse_rules(spark, url_filter.RULES)
    assert url_filter.judge(pages.filter("false"), rules).isEmpty()
    assert [r["verdict"] for r in url_filter.judge(pages, rules.filter("false")).collect()] == ["allow"]
