"""URL filters against a brute-force version."""

import random
import re

import pytest

import plumbline.llm.urls as m

PAGES = "page_id long, url string, host string, verdict int, key string, open string"


def brute(url, rules, default="allow"):
    found = re.search(r"^.*?://([^/?#]*)([^?#]*)", url or "", re.S)
    host = re.sub("[A-Z]", lambda c: c[0].lower(), found[1]) if found else ""
    path = found[2] if found else ""
    fits = []
    for h, p, v in rules:
        h, p = (h or "").lower(), p or ""
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h) + len(p), len(h), v == "block", h + p, v))
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, default)


def made(seed=1, n_rules=60, n=400):
    rng = random.Random(seed)
    label = lambda: rng.choice(["a", "b", "a-b", "ab", "com", "org", "x1", "ü"])
    host = lambda k: ".".join(label() for _ in range(rng.randrange(1, k)))
    path = lambda: "".join("/" + rng.choice(["a", "ab", "", "x.html"]) for _ in range(rng.randrange(3)))
    rules = {(host(4), path()): rng.choice(["allow", "block"]) for _ in range(n_rules)}
    urls = [rng.choice(["http://", "HTTPS://", "://", "", "x://y://"]) + (h := host(6)) + rng.choice([path(), path().upper(), "?q=/a", "#/a", ""]) + rng.choice(["", "?x", "#y", "/é"]) for _ in range(n)]
    urls += [None, "", "://", "http://", "http:///a", "http://A.COM/a", "http://a..com/", "http://com./a", "http://a.com\n/b", "http://" + "a." * 300 + "com/" + "x" * 5000, h]
    return [(h, p, v) for (h, p), v in rules.items()], urls + urls[:5]


@pytest.mark.parametrize(("n_rules", "ranges", "extra"), [(5, 64, []), (60, 64, []), (60, 3, [("", "", "block"), (None, "/a", "allow")])])
def test_brute_force(spark, monkeypatch, n_rules, ranges, extra):
    monkeypatch.setattr(m, "RANGES", ranges)
    rules, urls = made(n_rules, n_rules)
    rules += extra
    pages = spark.createDataFrame([(i, u, "clash", 1, "k", "o") for i, u in enumerate(urls)], PAGES).repartition(3)
    got = m.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "url", "key", "open", "host", "path", "rule", "verdict"]
    want = [(i, *brute(u, rules)) for i, u in enumerate(urls)]
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == want


def test_empty_tables(spark):
    rules = spark.createDataFrame(m.RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/", "", 0, "", "")], PAGES)
    assert m.judge(pages.limit(0), rules).collect() == []
    assert [(r.rule, r.verdict) for r in m.judge(pages, rules.limit(0)).collect()] == [(None, "allow")]


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "", 0, "", "")], PAGES)
    plan = m.judge(pages, m.default_rules(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn", plan)
