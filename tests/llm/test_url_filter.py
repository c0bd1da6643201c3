import pytest

from vacanta.llm import url_filter

CASES = [
    (1, "http://a.net/x"), (2, "http://example.net/en/1"), (3, "http://blog.EXAMPLE.net/en/1?x"), (4, "http://net"),
    (5, "http://notexample.net/en/"), (6, "https://example.com/de/9"), (7, "https://sub.org/fr/1#t"), (8, None),
    (9, "no scheme"), (10, ""), (11, "x://"), (12, "a://b://c.net/z"), (13, "http://casino-win.example.com/en/1"),
    (14, "http://täst.example.com/日本"), (15, "http://h.org/fr"), (16, "http://x.net?/q"), (17, "HTTP://ÄÖ.Net/p"),
    (None, "http://a.net/"), (1, "http://a.net/x"), (18, "http://e.com/" + "long/" * 3000),
]


def pages(spark, rows=CASES):
    return spark.createDataFrame([(i, u, "mine") for i, u in rows], "page_id long, url string, host string")


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    weights, bias = url_filter.train()
    grams = [b for n, part in enumerate((f"^{host}$", f"{path}$")) for b in url_filter._buckets(part, n + 1)]
    logit = sum(weights[b] for b in grams) * 10 / max(1, len(grams)) // 1 + bias
    learned = "block" if logit > url_filter.BLOCK_ABOVE else "allow"
    return host, path, best[1] + best[2] if best else None, best[0] if best else learned, int(logit)


def test_every_case_against_brute_force(spark):
    got = url_filter.judge(pages(spark)).collect()
    assert len(got) == len(CASES)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["logit"]) == brute(r["url"]), r["url"]


def test_no_rows_and_no_python(spark):
    judged = url_filter.judge(pages(spark, []))
    assert judged.count() == 0
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_the_regression_tells_its_examples_apart():
    model = url_filter.train()
    for label, url in url_filter.LABELLED:
        host, path, *_ = brute(url)
        grams = [b for n, part in enumerate((f"^{host}$", f"{path}$")) for b in url_filter._buckets(part, n + 1)]
        assert (sum(model[0][b] for b in grams) * 10 / len(grams) + model[1] > 0) == bool(label)


def test_the_labelled_table_is_bounded():
    with pytest.raises(ValueError):
        url_filter.train([(1, "http://x.y/")] * (url_filter.MOST_LABELLED + 1))
