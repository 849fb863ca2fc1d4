import re

from terrace.llm import url_rules
from terrace.llm.queries import QUERIES, URL_RULES
from terrace.sources.tables import table


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :]).group()


def plain_rule(host, path):
    fits = []
    for rule in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


def test_query(spark, sf):
    rows = QUERIES["op1_url_rules"](spark, sf).collect()
    urls = {r["page_id"]: r["url"] for r in table(spark, sf, "pages").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        host, path = split(urls[r["page_id"]])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and (rule is None or r["verdict"] == URL_RULES[rule])


def pages_of(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "://", "http://A.NET", "http://a.net/x", "x://y://b.net/", "http://ÄB.org/fr/1#x?y", "HTTP://net/?a/b", "http://example.net/en/", "http://badexample.net/en/"]
    pages = pages_of(spark, urls).unionAll(pages_of(spark, urls).limit(2))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = url_rules.judge_urls(pages, labels, URL_RULES).collect()
    assert len(rows) == len(urls) + 2
    for r in rows:
        host, path = split(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, plain_rule(host, path))
    assert url_rules.judge_urls(pages.limit(0), labels, URL_RULES).count() == 0


def test_mined_rules_block_what_labels_block(spark):
    bad = [f"http://spam{i % 3}.example.com/casino/{i}" for i in range(40)]
    good = [f"http://site{i % 5}.example.com/news/{i}" for i in range(80)] + [f"http://site.example.com/casino-royale-review/{i}" for i in range(3)]
    pages = pages_of(spark, bad + good)
    labels = spark.createDataFrame([(i, 0 if i < 40 else 1, None) for i in range(0, 120)] + [(0, 0, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = {r["page_id"]: r for r in url_rules.judge_urls(pages, labels, {}, min_support=0.2).collect()}
    assert all(rows[i]["verdict"] == "block" for i in range(40))
    assert all(rows[i]["verdict"] == "allow" for i in range(40, 120))
    assert rows[0]["mined_rule"] == "p:casino" and rows[0]["confidence"] > 0.9


def test_mined_rules_are_exact(spark):
    """Confidence and pages of every rule against a count over all rows."""
    rows = [(i, [t for k, t in enumerate("abcde") if (i >> k) & 1], i % 3 == 0 and bool(i & 3)) for i in range(64)]
    got = url_rules.mine_rules(spark.createDataFrame(rows, "id long, items array<string>, blocked boolean"), 0.05, 2, 0.3).collect()
    assert got
    for r in got:
        fit = [b for _, items, b in rows if set(r["items"]) <= set(items)]
        assert (r["pages"], r["confidence"]) == (len(fit), sum(fit) / len(fit))


def test_labels_and_small_hosts_are_mined(spark):
    """A label on many domains, a top-level domain, and a host of ten pages among thousands of blocked ones."""
    bad = [f"https://casino.site{i}.com/" for i in range(20)] + [f"https://shop{i}.bad/" for i in range(20)] + ["https://x.small.org/" for i in range(10)]
    bulk = [f"http://www.bulk.net/u/{i}" for i in range(3000)]
    good = [f"https://site{i}.com/" for i in range(60)] + ["https://y.small.org/" for i in range(60)]
    urls = bad + bulk + good + ["https://casino.unseen.org/", "https://new.bad/", "https://x.small.org/"]
    labels = spark.createDataFrame([(i, int(i >= len(bad) + len(bulk)), None) for i in range(len(urls) - 3)], "doc_id long, quality int, toxic int")
    rows = {r["page_id"]: r for r in url_rules.judge_urls(pages_of(spark, urls), labels, {}).collect()}
    assert [rows[len(urls) - k]["verdict"] for k in (3, 2, 1)] == ["block"] * 3
    assert rows[len(urls) - 3]["mined_rule"] == "w:casino" and rows[len(urls) - 2]["mined_rule"] == "w:bad"
    assert all(rows[i]["verdict"] == "allow" for i in range(len(bad) + len(bulk), len(urls) - 3))


def test_rules_of_four_tokens(spark):
    rows = [(i, [t for k, t in enumerate("abcd") if (i >> k) & 1], i % 16 == 15) for i in range(320)]
    got = url_rules.mine_rules(spark.createDataFrame(rows, "id long, items array<string>, blocked boolean")).collect()
    assert [(sorted(r["items"]), r["pages"], r["confidence"]) for r in got] == [(["a", "b", "c", "d"], 20, 1.0)]


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    """Labels, token sets and rules stand in small files, whose size says little of them; equal token sets are counted together."""
    plans, alike = [], []
    real = url_rules.write_through

    def written(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = real(df, label)
        if label == "url-alike":
            alike.append(out.count())
        return out

    monkeypatch.setattr(url_rules, "write_through", written)
    urls = [f"http://site{i % 4}.org/casino/{i}" for i in range(60)] + [f"http://site{i % 4}.org/news/{i}" for i in range(60)]
    labels = spark.createDataFrame([(i, int(i >= 60), None) for i in range(120)], "doc_id long, quality int, toxic int")
    out = url_rules.judge_urls(pages_of(spark, urls), labels, {})
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert not [p for p in plans if "Broadcast" in p] and sum(p.count("SortMergeJoin") for p in plans) >= 9
    assert alike == [8]
    rows = {(r["page_id"] < 60, r["verdict"], r["mined_rule"], r["confidence"]) for r in out.collect()}
    assert rows == {(True, "block", "p:casino", 1.0), (False, "allow", None, None)}
