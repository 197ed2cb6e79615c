"""The url filter: held-out precision and recall, rules against a plain restatement, all kinds of rows."""

import pytest

from tempora.llm import url_filter


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(url_filter.labelled(spark))


def judged(spark, urls, model):
    rows = [(k, u, 1, "x") for k, u in enumerate(urls)]
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, rule int, grams string"), model).orderBy("page_id").collect()
    return out


def test_held_out_precision_and_recall(spark, model):
    held = url_filter.labelled(spark, seed=7, rows=3000)
    urls = held.selectExpr("monotonically_increasing_id() as page_id", "concat('http://', host, path) as url", "label")
    got = url_filter.judge(urls, model, rules=[]).join(urls, "page_id").select("verdict", "label").collect()
    hit = sum(r.verdict == "block" and r.label == 1 for r in got)
    assert hit / sum(r.verdict == "block" for r in got) > 0.97 and hit / sum(r.label for r in got) > 0.95


def test_paths_alone_and_hosts_alone(spark, model):
    bad = ["http://quiet.example.org/porn/xxx-video/free", "http://quiet.example.org/casino/poker/slots-bonus", "https://gambling-house.example.org/", "http://casino-win.example.org/en/1", "http://www.viagra.example.org/de/7.html"]
    good = ["http://quiet.example.org/en/1", "https://sussex.example.org/history", "http://library.example.org/betty/letters", "http://thandereron.example.org/en/91", "http://museum.example.org/better-guide/4"]
    assert [r.verdict for r in judged(spark, bad, model)] == ["block"] * len(bad)
    assert [r.verdict for r in judged(spark, good, model)] == ["allow"] * len(good)


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(r), r) for r, _ in url_filter.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fits)[1] if fits else None


def test_rules_equal_a_plain_restatement(spark, model):
    hosts = ["a.com", "example.com", "www.example.com", "x.www.example.com", "EXAMPLE.com", "notexample.com", "b.net", "net", "com", "com.org", "user@a.com", "a.com:80", "Ärzte.com", ""]
    paths = ["", "/", "/en", "/en/", "/en/1?x=/es/", "/es/a#b", "/fr/", "/EN/", "?q", "#f", "//en/"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "nourl", "://", "a://b://c.com/en/", "http://example.com/en/"] * 2
    out = judged(spark, urls, model)
    assert [(r.host, r.path, r.rule) for r in out] == [plain(u) for u in urls]
    verdicts = dict(url_filter.RULES)
    assert all(r.verdict == verdicts[r.rule] if r.rule else r.verdict in ("allow", "block") for r in out)
    assert all(r.verdict == "allow" for r, u in zip(out, urls) if not r.host and not r.path and not r.rule)
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), model).count() == 0
