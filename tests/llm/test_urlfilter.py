from urllib.parse import quote

import pytest

from registrylake.llm import urlfilter as uf

URLS = [
    (1, "https://WWW.Example.com/en/1"), (2, "http://m.example.com/en/2?a=1"), (3, "http://example.com/fr/"), (4, "http://a.net/es/x#y"), (5, "http://a.net/esx"),
    (6, "http://net/fr/"), (7, "http://bnet/fr/"), (8, "ftp://com?x/y"), (9, "com/en/"), (10, None), (11, ""), (12, "://"), (13, "http://x.org/a://com/en/"),
    (14, "http://www.spam-farm.org:80/p/?utm_source=q&b=2&a=1#z"), (15, "https://spam-farm.org/p?a=1&b=2"), (16, "https://spam-farm.org/p?b=2"), (17, "http://example.com"),
    (18, "http://my.www.example.com/en/" + "x" * 50_000), (19, "http://myexample.com/en/"), (20, "http://a.org/ÄÖ Ü"), (20, "http://a.org/ÄÖ Ü"), (None, "http://a.com/\nz"),
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def rule(host, path, rules):
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, None)


def brute(rows, listed, rules=uf.RULES):
    out = []
    for i, url in rows:
        host, path = parts(url)
        name, verdict = rule(host, path, rules)
        out.append((i, host, path, name, verdict or ("block" if i in listed else "allow"), i in listed))
    return sorted(out, key=repr)


def run(spark, rows, listed, **how):
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = uf.filter_urls(pages, spark.createDataFrame([(u,) for u in listed], "url string"), **how)
    return sorted(map(tuple, out.select("page_id", "host", "path", "rule", "verdict", "listed").collect()), key=repr)


def test_against_brute_force(spark):
    assert run(spark, URLS, ["http://www.spam-farm.org/p?b=2&a=1", "https://a.org/ÄÖ Ü/", None, "nothing", "", "http://a.org/ÄÖ Ü"]) == brute(URLS, {14, 15, 20})


def test_empty_list_and_empty_table(spark):
    assert run(spark, URLS, []) == brute(URLS, set())
    assert run(spark, [], ["http://a.org/"]) == []


@pytest.mark.parametrize("url, want", [
    ("HTTP://WWW.A.org:80/x/y//?ref=1&b&a=%41#f", "a.org/x/y?a=%41&b"), ("https://a.org", "a.org"), ("https://a.org:8080/?utm_a=1", "a.org:8080"), ("a.org/x", None), ("http://a.org?q", "a.org?q"), (None, None),
])
def test_canonical(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(uf.canonical(uf.F.col("u"))).first()[0] == want


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).selectExpr("concat('host.org/', id) url")
    filter_, blocks = uf.bloom(keys, "url", 20_000)
    asked = spark.range(40_000).selectExpr("id", "concat('host.org/', id) url")
    got = uf.possible(asked, "url", filter_, blocks).selectExpr("id < 20000 known", "__rl_maybe maybe").groupBy("known", "maybe").count()
    n = {(r[0], r[1]): r[2] for r in got.collect()}
    assert n[True, True] == 20_000 and n.get((False, True), 0) < 600 and blocks == -(-20_000 * uf.KEY_BITS // uf.BLOCK_BITS)


def test_false_positives_are_taken_out(spark, monkeypatch):
    monkeypatch.setattr(uf, "MOST_BLOCKS", 1)  # a filter of one block that is full: every page passes it
    rows = [(i, f"http://h{i}.org/{quote(str(i))}") for i in range(500)]
    assert run(spark, rows, [u for i, u in rows if i % 2]) == brute(rows, set(range(1, 500, 2)))


def test_pages_that_cannot_be_listed_do_not_move(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    listed = spark.createDataFrame([("spam-farm.org/p",)], "url string")
    filter_, blocks = uf.bloom(listed, "url", 1)
    plan = uf.possible(pages.withColumn("k", uf.canonical(uf.F.col("url"))), "k", filter_, blocks)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hot_page_and_clashing_columns(spark):
    rows = [(i, "http://spam.org/hot" if i % 3 == 0 else f"http://x.org/{i}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'mine' as other", "1 as host", "2 as listed", "3 as rule", "4 as w0", "5 as block")
    out = uf.filter_urls(pages, spark.createDataFrame([("https://www.spam.org/hot",)], "u string"))
    assert out.filter("verdict = 'block'").count() == 1000 and out.select("other", "w0", "block").distinct().collect() == [("mine", 4, 5)]
    assert sorted(out.columns) == sorted(["page_id", "url", "other", "w0", "block", "host", "path", "rule", "listed", "verdict"])


def test_ties_and_too_many_rules(spark):
    rules = [("allow", "com", "/abc"), ("block", "x.com", "/a")]
    assert run(spark, [(1, "http://x.com/abc"), (2, "http://y.com/abc")], [], rules=rules) == [(1, "x.com", "/abc", "x.com/a", "block", False), (2, "y.com", "/abc", "com/abc", "allow", False)]
    longer = [("allow", "com", "/abcd"), ("block", "x.com", "/a")]
    assert run(spark, [(1, "http://x.com/abcde")], [], rules=longer)[0][3:5] == ("com/abcd", "allow")
    with pytest.raises(ValueError):
        uf.rule_of(uf.F.lit(""), uf.F.lit(""), [("allow", "com", "/")] * 501)
