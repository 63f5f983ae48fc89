import pytest

from wattlake.llm import url_filter

RULES = dict(url_filter.RULES)


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    fits = []
    for rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


URLS = [
    None, "", "no scheme", "http://", "http://X.Example.COM/en/1", "https://www.example.com/en/", "https://www.example.com/en",
    "https://a.www.example.com/en/x?y", "http://example.com", "http://example.com/en/a://b", "http://Ünï.com/É?q", "ftp://b.net/es/1#t",
    "x://net/fr/", "http://notexample.com/en/", "http://q.org/en/1", "http://q.org?x=/en/", "http://h.com:80/", "://com/",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS + URLS)], "page_id long, url string, html string")
    got = url_filter.judge(df).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule) == brute(r.url), r.url
        assert r.verdict == (RULES[r.rule] if r.rule else r.verdict) and r.verdict in ("allow", "block")
        assert r.html == "mine"


def test_model_separates_what_rules_teach(spark):
    good = [f"https://www.shop{i}.com/garden/tools{i}" for i in range(60)]
    bad = [f"http://spam{i}.net/es/win-cash-{i}" for i in range(60)]
    new = ["https://blog.shop3.org/garden/tools", "http://spam9.org/es/win-cash-4"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad + new)], "page_id long, url string")
    got = {r.url: r.verdict for r in url_filter.judge(df).collect()}
    assert [got[u] for u in new] == ["allow", "block"]


def test_without_examples_or_rows(spark):
    df = spark.createDataFrame([(1, "http://q.org/x"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(df).orderBy("page_id").collect()] == ["allow", "allow"]
    assert url_filter.judge(df.limit(0)).collect() == []


def test_log_probabilities_sum_to_one():
    import numpy as np

    grams = np.unique(np.concatenate([url_filter._contexts("http://a.com/b1"), url_filter._contexts("x://zz?é")]))
    p = np.exp(url_filter.log_probabilities(grams, np.arange(1, len(grams) + 1))).reshape(-1, url_filter.SYMBOLS)
    assert p.sum(1) == pytest.approx(np.ones(len(p)))


def brute_ratio(urls, url):
    """llr of ``url``: Witten-Bell over the last 3 symbols, straight from counts of substrings."""
    import math

    start, other, size = "^", "!", url_filter.SYMBOLS

    def symbols(u):
        u = u.split("://", 1)[-1].encode().decode("latin-1")
        fold = ("0" if c in "0123456789" else c.lower() if c.isascii() and c.lower() in url_filter.ALPHABET else other for c in u)
        return start * 3 + "".join(fold)

    def probability(lines, context, c):
        below = probability(lines, context[1:], c) if context else 1 / size
        n = {}
        for line in lines:
            for i in range(3, len(line)):
                if line[i - len(context) : i] == context:
                    n[line[i]] = n.get(line[i], 0) + 1
        return (n.get(c, 0) + len(n) * below) / (sum(n.values()) + len(n)) if n else below

    parts = {v: [symbols(u) for u in urls if RULES.get(brute(u)[2]) == v] for v in ("allow", "block")}
    line = symbols(url)
    logs = [
        math.log(probability(parts["allow"], line[i - 3 : i], line[i])) - math.log(probability(parts["block"], line[i - 3 : i], line[i]))
        for i in range(3, len(line))
    ]
    return sum(logs) / len(logs)


def test_ratios_and_verdicts_equal_brute_force(spark):
    good = [f"https://www.shop{i}.com/garden/tools{i}" for i in range(8)]
    bad = [f"http://spam{i}.net/es/win-cash-{i}" for i in range(8)]
    new = ["http://blog.org/garden", "http://spam.org/es/win-cash", "ftp://q.org/ÉX?a=1", "http://shop.org:80/tools#3"]
    urls = good + bad + new
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.url: r for r in url_filter.judge(df).collect()}
    ratios = {u: brute_ratio(urls, u) for u in urls}
    for u in urls:
        assert got[u].llr == pytest.approx(ratios[u], abs=1e-5)
    # no accepted url may fall under the threshold here, as 1 of 8 would be more than 1%
    threshold = min(0.0, min(ratios[u] for u in good) // url_filter.STEP * url_filter.STEP)
    for u in new:
        assert got[u].verdict == ("block" if ratios[u] < threshold else "allow")
    assert {got[u].verdict for u in new} == {"allow", "block"}


def test_urls_without_scheme_are_judged_by_the_models(spark):
    good = [f"https://www.shop{i}.com/garden/tools{i}" for i in range(60)]
    bad = [f"http://spam{i}.net/es/win-cash-{i}" for i in range(60)]
    new = ["www.shop3.org/garden/tools", "spam9.org/es/win-cash-4"]
    df = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    got = {r.url: r for r in url_filter.judge(df).collect()}
    assert [(got[u].host, got[u].verdict) for u in new] == [("", "allow"), ("", "block")]
    assert got[new[0]].llr == pytest.approx(brute_ratio(good + bad, new[0]), abs=1e-5)
