import pytest
from pyspark.sql import functions as F

from registrylake.functions import text as X
from registrylake.functions.urlhost import host_of

# Published cases of the URL standard: URL and hostname; None where parsing fails.
CASES = [
    ("http://example\t.\norg", "example.org"), ("http://user:pass@foo:21/bar;par?b#c", "foo"), ("https:foo.com", "foo.com"), ("http:\\\\x:7/a", "x"), ("  http://a.b/  ", "a.b"),
    ("http://f:/c", "f"), ("http://f:0/c", "f"), ("http://f:65536/c", None), ("http://f:b/c", None), ("http://f: /c", None), ("http://f:fifty-two/c", None), ("http:///", None), ("http://", None),
    ("http://@/x", None), ("http://u@/x", None), ("http://a:b@c@d/", "d"), ("http://::@c@d:2", "d"), ("http:/example.com/", "example.com"), ("ftp:/example.com/", "example.com"), ("ws://h", "h"), ("madeupscheme:/example.com/", ""),
    ("mailto:example.com", ""), ("data:text", ""), ("javascript:alert(1)", ""), ("file:///foo", ""), ("file://localhost/x", ""), ("file://example%2E/x", "example."), ("file:///C|/x", ""), ("file:c:\\x", ""), ("//x/y", None), ("no url", None), ("", None), ("1a://h", None),
    ("http://GOO\u200b\u2060\ufeffgoo.com", "googoo.com"), ("http://www.foo\u3002bar.com", "www.foo.bar.com"), ("http://\uff27\uff4f.com", "go.com"), ("http://\uff05\uff14\uff11.com", None), ("http://%ef%bc%85%ef%bc%94%ef%bc%91.com", None),
    ("http://\uff05\uff10\uff10.com", None), ("http://%zz%66%a.com", None), ("http://%25", None), ("http://hello%00", None), ("http://a b/", None), ("http://a%20b/", None), ("http://a<b", None), ("http://a>b", None), ("http://a^b", None), ("http://a|b", None), ("http://a\x7fb/", None), ("http://a%7fb", None), ("http://ho%7Cst/", None), ("http://ho%61st", "hoast"),
    ("http://!\"$&'()*+,-.;=_`{}~/", "!\"$&'()*+,-.;=_`{}~"), ("http://b\u00fccher.de", "xn--bcher-kva.de"), ("http://fa\u00df.example/", "xn--fa-hia.example"), ("http://\u4f60\u597d\u4f60\u597d", "xn--6qqa088eba"), ("http://xn--fa-hia.example", "xn--fa-hia.example"), ("http://xn--/", None), ("http://xn--a", None), ("http://a.b.c.xn--pokxncvks/", None), ("http://\u0300x", None), ("http://\ufdd0zyx.com", None), ("http://\ufffd.com", None),
    ("http://192.0.0.1", "192.0.0.1"), ("http://0x7f.1/", "127.0.0.1"), ("http://0300.168.0xF0", "192.168.0.240"), ("http://2130706433", "127.0.0.1"), ("http://4294967295", "255.255.255.255"), ("http://4294967296", None), ("http://1.2.3.4.5", None), ("http://256.256.256.256", None), ("http://1.2.3.256", None), ("http://1.2.65536", None), ("http://192.168.0.257", None), ("http://0xffffffff", "255.255.255.255"),
    ("http://0x100000000", None), ("http://1.2.3.08", None), ("http://1.2.3.09.", None), ("http://foo.09", None), ("http://foo.0x4", None), ("http://foo.0XFfFfFfFfFfFfFfFfFfAcE123", None), ("http://09.2.3.4", None), ("http://1..2.3", None), ("http://foo.2.3", None), ("http://1.2.3.4.", "1.2.3.4"), ("http://1.2.3.4..", "1.2.3.4.."), ("http://0x.0x.0", "0.0.0.0"), ("http://%30%78%63%30%2e%30%32%35%30.01", "192.168.0.1"), ("http://foo.0x", None), ("http://0x7f.1x", "0x7f.1x"),
    ("http://[::1]", "[::1]"), ("http://[1:2::3]:80/", "[1:2::3]"), ("http://[2001::1]", "[2001::1]"), ("http://[::127.0.0.1]", "[::7f00:1]"), ("http://[0:0:0:0:0:0:13.1.68.3]", "[::d01:4403]"), ("http://[1:0::]", "[1::]"), ("http://[0:1:2:3:4:5:6:7]", "[0:1:2:3:4:5:6:7]"), ("http://[0:1:0:1:0:1:0:1]", "[0:1:0:1:0:1:0:1]"), ("http://[1:0:0:2:0:0:0:3]", "[1:0:0:2::3]"), ("http://[A:B:C::D]", "[a:b:c::d]"),
    ("http://[::1", None), ("http://[www.google.com]/", None), ("http://[::1.2.3.4x]", None), ("http://[::1.2.3.]", None), ("http://[::.1.2]", None), ("http://[:::]", None), ("http://[0:1:2:3:4:5:6:7:8]", None), ("http://[1:2:3:4:5:6:7]", None), ("http://[::1%25]", None), ("http://[google.com]", None), ("http://[]", None), ("http://[::127.0.0.01]", None), ("http://[1::2::3]", None), ("http://[12345::]", None), ("http://a]b", None),
    ("non-special://[::1]:3/", "[::1]"), ("non-special://Ex%41mple/", "Ex%41mple"), ("non-special://\u00fc/", "%C3%BC"), ("sc://a b/", None), ("sc://a|b/", None), ("sc://x:y/", None), ("sc://@/", None), ("sc:///x", ""), ("sc://[::127.0.0.1]", "[::7f00:1]"), ("foo://x\\y", None),
]


@pytest.mark.parametrize("url, want", CASES)
def test_published_cases(url, want):
    assert host_of(url) == want


def test_column_equals_the_parser_on_both_paths(spark):
    more = ["https://Plain-Host.example.com:443/a?b#c", "http://h.com\\x", "http://a_b.c", "http://1a.b2/", "HTTP://XN--FA-HIA.EXAMPLE/", "http://a.b:8080", "http://a.b:80801/", "http://a.1", None, "http://x\n.y/", "http://q" + "a" * 70_000 + ".com/"]
    urls = [u for u, _ in CASES] + more
    got = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").select("i", X.host(F.col("u")).alias("h")).collect()
    assert {r.i: r.h for r in got} == {i: None if u is None else host_of(u) for i, u in enumerate(urls)}


def test_plain_hosts_reach_python_as_nulls(spark):
    plain = spark.createDataFrame([("https://a.b/",)], "u string").select(X.host(F.col("u")))
    assert "CASE WHEN NOT" in plain._jdf.queryExecution().executedPlan().toString()


def test_tunnels_and_targets_stand_on_it(spark):
    urls = [("http://x%2engrok.io/",), ("http://NGROK.IO.:1/",), ("http://ngrok.io%2F.x/",), ("http://\uff4eGrok.io",)]
    got = spark.createDataFrame(urls, "u string").select(X.tunnel_suffix(X.host(F.col("u"))).alias("s")).collect()
    assert [r.s for r in got] == ["ngrok.io", None, None, "ngrok.io"]
